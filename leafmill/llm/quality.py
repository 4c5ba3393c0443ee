"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Base metrics are computed for every document. Each further rule is a predicate that rejects, with an estimate of its cost: how many values it
looks at in a document, by its own expression. Mean cost and rejection rate are taken on about `sample_rows` documents, those
with the smallest hashes of doc_id, and the rules are chained by rejection per cost, so a cheap, selective rule spares the dear ones.
The chain is one CASE expression, which stops at the first rule that rejects; the order changes the work and never the verdict, and
the same table always gives the same order.

Repeated words: windows are compared by 64-bit hashes within one text; hashes are sorted only where some repeat.

Defined cases: null text is empty, fails the base rules and counts nothing; repeated rows give repeated rows; columns other than doc_id and
text are ignored, whatever their names; an empty table gives an empty table (rules stay in the given order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SAMPLE_ROWS = 500
WINDOW = 8
MIN_WORDS = 20
#: Word separators and symbols; fixed values.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"

#: What rejects a document beyond the base rules, over its metrics and words (lenient bounds for prose in any language), and how many values that looks at.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("2 * n_symbols > n_words", "1"),
    "word_length": ("word_chars < 2 * n_words or word_chars > 15 * n_words", "2"),
    "repeated_lines": ("n_lines >= 4 and 2 * n_dup_lines > n_lines", "2"),
    "few_distinct_words": ("50 * size(array_distinct(w)) < n_words", "n_words"),
    "few_letters": ("2 * size(filter(w, x -> x rlike '\\\\p{L}')) < n_words", "word_chars"),
}


def words(text: Column) -> Column:
    inner = F.trim(text, F.lit(SPACE))
    return F.when(F.length(inner) > 0, F.split(inner, SPACES, -1)).otherwise(F.array().cast("array<string>"))


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words in windows that occur twice or more."""

    def of(hashes: Column) -> Column:
        def ranked(s: Column) -> Column:
            twice = lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])
            return F.transform(F.filter(s, lambda x, k: F.coalesce(twice(x, k), (F.get(s, k + 1)["h"] == x["h"]), (F.get(s, k - 1)["h"] == x["h"]), F.lit(False))), lambda x: x["i"])

        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = F.array_sort(F.flatten(F.transform(F.array(pairs), ranked)))
        start = F.struct(F.lit(0).alias("n"), F.lit(-window).alias("last"))
        total = F.aggregate(places, start, lambda a, x: F.struct((a["n"] + F.least(F.lit(window), x - a["last"])).alias("n"), x.alias("last")), lambda a: a["n"])
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), total).otherwise(F.lit(0))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))
    return F.when(F.size(w) > window, F.element_at(F.transform(F.array(hashes), of), 1)).otherwise(F.lit(0)).cast("long")


def metrics(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """keep, words w, and the base metrics."""
    t = F.col("text__")
    base = docs.select(*keep, F.coalesce("text", F.lit("")).alias("text__")).withColumn("w", words(t))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.trim(x, F.lit(SPACE))) > 0)
    named = [c for c in base.columns if c != "text__"]
    more = base.select(*named, F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), lines.alias("lines"), repeated_words(F.col("w")).alias("n_repeat_words"))
    named += ["n_words", "word_chars", "n_symbols", "n_repeat_words"]
    return more.select(*named, F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))


FAILED = f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 30 * n_words"


def planned(docs: DataFrame, rules: dict[str, tuple[str, str]] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[tuple[str, float, float]]:
    """(rule, rejection rate, mean cost) on a sample, by rejection per cost; equals stay in the given order."""
    order = F.xxhash64("doc_id", F.lit(4))
    last = docs.select(order.alias("o")).orderBy("o").limit(sample_rows).agg(F.max("o")).first()[0]  # reads doc_id alone
    if last is None:
        return [(k, 0.0, 0.0) for k in rules]
    sample = metrics(docs.where(order <= last).limit(sample_rows), [])  # repeated ids may pass the bound, so few rows travel in any case
    told = sample.agg(*[F.avg(F.expr(f"cast(({r}) and not ({FAILED}) as int)")).alias(k) for k, (r, _) in rules.items()], *[F.avg(F.expr(f"cast({c} as double)")).alias(f"{k}_cost") for k, (_, c) in rules.items()]).first()
    found = [(k, float(told[k] or 0), max(1.0, float(told[f"{k}_cost"] or 0))) for k in rules]
    return sorted(found, key=lambda x: -x[1] / x[2])


def assess(docs: DataFrame, rules: dict[str, tuple[str, str]] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, metrics, base_failed, kept, and the rule that rejected (null if none)."""
    chain = F.when(F.expr(FAILED), F.lit("base"))
    for k, _, _ in planned(docs, rules, sample_rows):
        chain = chain.when(F.expr(rules[k][0]), F.lit(k))
    done = metrics(docs, [F.col("doc_id")]).withColumn("rejected_by", chain)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return done.select("doc_id", *counts, F.expr(FAILED).alias("base_failed"), F.col("rejected_by").isNull().alias("kept"), "rejected_by")
