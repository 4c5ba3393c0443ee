"""Dates of issue from recognised items: windows, mining, labels, rescue, elimination, expiry back-off, ranking and decision.

Items: sample_id, variant, vi (its place in the order of variants), pos, text, x1, y1, x2, y2, confidence. Context: sample_id, birth and expiry
(ISO texts) and context_source. All joins are by sample and variant, so a page's items meet on one page only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from leafmill.functions import scalars as S
from leafmill.functions.dialect import SPARK
from leafmill.functions.mining import MONTHS, issue_signals, mined, normal_date_text
from leafmill.sources.tables import written

BOX = ("x1", "y1", "x2", "y2")
CANDIDATE = ["sample_id", "iso", "raw", "score", "method", "variant", "seq"]
#: Points of the back-off from expiry.
BACKED, YEAR, DAY_YEAR, ONE_DIGIT, DAY_MONTH, EXACT_DAY, LABEL, TEN_YEARS = 72, 10, 12, 14, 5, 7, 5, 3


def stem(name: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(name, "[^/]*$", 0), r"(?<=.)\.[^.]*$", "")


def looked_up(records: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """records (with filename) and columns of a table by file name: by the name as it is, its stem, the stem with .jpg, with .png, whichever comes first. Of several rows of a name the last by pos holds."""
    last = Window.partitionBy("filename").orderBy(F.desc("pos"))
    rows = table.where(F.coalesce("filename", F.lit("")) != "").withColumn("r", F.row_number().over(last)).where("r = 1").select(F.col("filename").alias("key"), F.struct(*columns).alias("found"))
    base = stem(F.col("filename"))
    keys = F.array_distinct(F.array("filename", base, F.concat(base, F.lit(".jpg")), F.concat(base, F.lit(".png"))))
    tried = records.select("sample_id", F.posexplode(F.when(F.coalesce("filename", F.lit("")) != "", keys).otherwise(F.array())).alias("turn", "key")).join(rows, "key")
    best = tried.groupBy("sample_id").agg(F.min_by("found", "turn").alias("found"))
    return records.join(best, "sample_id", "left").select(*records.columns, *[F.col(f"found.{c}").alias(c) for c in columns])


def temporal_context(records: DataFrame, parsed: DataFrame, validated: DataFrame, viz: DataFrame) -> DataFrame:
    """sample_id, birth, expiry, context_source: of the zone first if all its checks hold and its lines are strict, else of the page first."""
    iso = lambda c: F.when(F.try_to_date(F.trim(c), "yyyy-MM-dd").isNotNull(), F.trim(c))
    r = looked_up(records.select("sample_id", "filename"), parsed, ["birth_date", "expiry_date", "parse_mode"])
    r = looked_up(looked_up(r, validated, ["all_main_checks_valid"]), viz, ["date_of_birth", "date_of_expiry"])
    r = r.select("sample_id", iso("birth_date").alias("zb"), iso("expiry_date").alias("ze"), iso("date_of_birth").alias("vb"), iso("date_of_expiry").alias("ve"), F.coalesce(F.lower(F.trim(F.col("all_main_checks_valid").cast("string"))).isin("true", "1", "yes") & (F.col("parse_mode") == "strict_44_44"), F.lit(False)).alias("sure"))
    r = r.select("sample_id", "sure", "vb", "ve", F.when(F.col("sure"), F.coalesce("zb", "vb")).otherwise(F.coalesce("vb", "zb")).alias("b"), F.when(F.col("sure"), F.coalesce("ze", "ve")).otherwise(F.coalesce("ve", "ze")).alias("expiry"))
    odd = F.coalesce(F.col("b") >= F.col("expiry"), F.lit(False))
    told = lambda c, v, name: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{name}_"), F.when(F.col(v).isNotNull(), "viz").otherwise("mrz")))
    parts = F.concat_ws("+", told("b", "vb", "birth"), told("expiry", "ve", "expiry"), F.when(odd, F.lit("birth_discarded_invalid")))
    return r.select("sample_id", F.when(~odd, F.col("b")).alias("birth"), "expiry", F.when(F.col("sure"), F.lit("validated_mrz")).otherwise(F.coalesce(F.nullif(parts, F.lit("")), F.lit("none"))).alias("context_source"))


def windows(items: DataFrame) -> DataFrame:
    """One to three neighbouring items of a variant: pos, n, their text, the box around those that have one, the least confidence."""
    order = Window.partitionBy("sample_id", "variant").orderBy("pos")
    item = F.struct("text", *BOX, F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    near = items.select("sample_id", "variant", "vi", "pos", item.alias("a"), F.lead(item, 1).over(order).alias("b"), F.lead(item, 2).over(order).alias("c"))

    def joined(*names: str) -> Column:
        text = F.trim(F.concat_ws(" ", *[F.coalesce(F.col(f"{x}.text"), F.lit("")) for x in names]))
        of = lambda f, c: f(*[F.col(f"{x}.{c}") for x in names]) if len(names) > 1 else F.col(f"a.{c}")
        box = [of(F.least if c in ("x1", "y1") else F.greatest, c).alias(c) for c in BOX]
        return F.when(F.col(names[-1]).isNotNull(), F.struct(F.lit(len(names)).alias("n"), text.alias("text"), *box, of(F.least, "confidence").alias("confidence")))

    each = F.array_compact(F.array(joined("a"), joined("a", "b"), joined("a", "b", "c")))
    return near.select("sample_id", "variant", "vi", "pos", F.explode(each).alias("w")).select("sample_id", "variant", "vi", "pos", "w.*").where(F.col("text") != "")


def dated(items: DataFrame, context: DataFrame, today: str) -> DataFrame:
    """The dates in all windows, with context: seq is their order (stage, vi, pos, n, place). A page's texts are looked at together, so its windows are made only where they hold dates."""
    item = F.struct("pos", "vi", "text", *BOX, F.coalesce("confidence", F.lit(0.0)).alias("confidence"))
    pages = items.groupBy("sample_id", "variant").agg(F.array_sort(F.collect_list(item)).alias("items")).join(context, "sample_id", "left")
    found = pages.withColumn("found", mined(today, 3)(F.col("items.text"), "birth", "expiry")).select("*", F.explode("found").alias("date")).select("*", "date.*")
    own = F.slice("items", F.col("first") + 1, F.col("n"))
    text = F.trim(F.array_join(F.transform(own, lambda x: F.coalesce(x["text"], F.lit(""))), " "))
    box = [(F.array_min if c in ("x1", "y1") else F.array_max)(F.col(f"own.{c}")).alias(c) for c in BOX]
    rows = found.withColumn("own", own).withColumn("text", text)
    rows = rows.select("sample_id", "variant", F.col("own")[0]["vi"].alias("vi"), F.col("own")[0]["pos"].alias("pos"), "n", "text", *box, F.array_min("own.confidence").alias("confidence"), *[c for c in context.columns if c != "sample_id"], "iso", "raw", "start", "end", "place")
    seq = F.struct(F.lit(0).alias("stage"), F.col("vi").cast("int").alias("vi"), F.col("pos").cast("int").alias("pos"), F.col("n").alias("n"), F.col("place").alias("place"))
    return rows.withColumn("seq", seq).drop("place")


def allowed(today: str) -> Column:
    """Not over a year ahead, after birth, before expiry."""
    known = lambda c, ok: F.coalesce(ok, F.lit(True))
    return (F.col("iso") <= F.date_format(F.date_add(F.lit(today).cast("date"), 366), "yyyy-MM-dd")) & known("birth", F.col("iso") > F.col("birth")) & known("expiry", F.col("iso") < F.col("expiry"))


def bonus() -> Column:
    """Points for a validity near five or ten years."""
    return F.expr(S.validity_bonus(SPARK, "cast(iso as date)", "cast(expiry as date)"))


def signalled(items: DataFrame) -> DataFrame:
    """Items that label a date of issue and no other date, with similarity and place; texts are looked at once."""
    texts = items.select(F.col("text").alias("label_text")).distinct().withColumn("s", issue_signals("label_text")).where("s.issue and not s.negative")
    return items.join(texts, F.col("text").eqNullSafe(F.col("label_text"))).select(*items.columns, F.col("s.similarity").alias("similarity"), F.col("s.at").alias("at"))


def labelled(dates: DataFrame, labels: DataFrame, today: str) -> DataFrame:
    """Each admissible date with its best label, beside or below it or at most three items away; without one it stays if its validity is exceptional."""
    able = dates.where(allowed(today)).withColumn("bonus", bonus())
    own = labels.select("sample_id", "variant", F.col("pos").alias("lpos"), "similarity", "at", F.struct(*BOX).alias("a"))
    pairs = able.withColumn("b", F.struct(*BOX)).join(own, ["sample_id", "variant"], "left")
    before = (F.col("lpos") == F.col("pos")) & (F.col("at") >= 0) & (F.col("start") + F.length("raw") <= F.col("at"))
    place = F.when(F.col("a.x1").isNotNull() & F.col("b.x1").isNotNull(), F.expr(S.issue_score(SPARK, "a", "b")))
    off = F.abs(F.col("lpos") - F.col("pos"))
    near = F.coalesce(place, F.when(off <= 3, F.greatest(F.lit(0.0), 18.0 - 5.0 * off)))
    score = F.when(~before, 45.0 * F.col("similarity") + near + F.col("bonus") + 5.0 * F.col("confidence"))
    told = pairs.withColumn("place", place).withColumn("score", score).groupBy("sample_id", "variant", "seq", "iso", "raw", "bonus").agg(F.max_by(F.when(F.col("score").isNotNull(), F.struct("score", "place")), F.when(F.col("score").isNotNull(), F.struct(F.round("score", 9), -F.col("lpos")))).alias("best"))
    method = F.when(F.col("best").isNull(), "temporal_validity_rescue").when(F.col("best.place").isNotNull(), "issue_label_spatial").otherwise("issue_label_nearby")
    rows = told.where(F.col("best").isNotNull() | (F.col("bonus") >= 28))
    return rows.select("sample_id", "iso", "raw", F.coalesce("best.score", 42 + F.col("bonus")).alias("score"), method.alias("method"), "variant", "seq")


def eliminated(dates: DataFrame, today: str) -> DataFrame:
    """The only admissible date of a sample whose context is a validated zone."""
    able = dates.where(allowed(today) & (F.col("context_source") == "validated_mrz"))
    one = able.groupBy("sample_id").agg(F.count_distinct("iso").alias("n"), F.min_by(F.struct("iso", "raw", "variant"), "seq").alias("d"), F.min("seq").alias("seq")).where("n = 1")
    return one.select("sample_id", "d.iso", "d.raw", F.lit(86.0).alias("score"), F.lit("date_role_elimination").alias("method"), "d.variant", F.col("seq").withField("stage", F.lit(1)).alias("seq"))


def backed_off(items: DataFrame, dates: DataFrame, labels: DataFrame, context: DataFrame, today: str) -> DataFrame:
    """Five and ten years before expiry, and the day after, where the page's text supports them."""
    text = items.groupBy("sample_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("vi", "pos", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"]), " ").alias("t")).withColumn("t", normal_date_text("t"))
    other = dates.where(~(F.col("iso").eqNullSafe(F.col("birth")) | F.col("iso").eqNullSafe(F.col("expiry")))).groupBy("sample_id").agg(F.collect_set("iso").alias("others"))
    marks = labels.select("sample_id", F.lit(True).alias("any_label")).distinct()
    tries = F.array(*[F.struct(F.lit(y).alias("years"), F.lit(k).alias("late"), F.lit(i).alias("place")) for i, (y, k) in enumerate((y, k) for y in (5, 10) for k in (0, 1))])
    rows = context.where(F.col("expiry").isNotNull()).select("*", F.explode(tries).alias("w")).select("*", "w.*")
    day = F.date_add(F.add_months(F.col("expiry").cast("date"), -12 * F.col("years")), F.col("late"))
    rows = rows.withColumn("iso", F.date_format(day, "yyyy-MM-dd")).where(allowed(today)).join(text, "sample_id", "left").join(other, "sample_id", "left").join(marks, "sample_id", "left")
    iso, t = F.col("iso"), F.coalesce("t", F.lit(""))
    others, mark = F.coalesce("others", F.array().cast("array<string>")), F.coalesce("any_label", F.lit(False))
    year, short, month, number = iso.substr(1, 4), iso.substr(3, 2), iso.substr(6, 2), iso.substr(9, 2)
    seen = lambda *parts: F.regexp_like(t, F.concat(*parts))
    alone = lambda *parts: seen(F.lit(r"(?<!\d)"), *parts, F.lit(r"(?!\d)"))
    by_year = t.contains(year) | alone(short)
    between = F.lit(r"\s+[a-z0-9/]+\s+")
    by_day_year = alone(number, between, year) | alone(number.cast("int").cast("string"), between, short)
    same_month = lambda x: x.substr(6, 2) == month
    by_day_month = F.exists(others, lambda x: same_month(x) & (F.abs(x.substr(9, 2).cast("int") - number.cast("int")) <= 1))
    by_day = F.exists(others, lambda x: same_month(x) & (x.substr(9, 2) == number))
    wrong = lambda x: reduce(lambda a, b: a + b, [(x.substr(i, 1) != iso.substr(i, 1)).cast("int") for i in range(1, 5)])
    by_digit = F.exists(others, lambda x: same_month(x) & (x.substr(9, 2) == number) & (wrong(x) == 1))
    names = F.element_at(F.create_map(*[F.lit(v) for m, all_ in MONTHS.items() for v in (f"{m:02d}", "|".join(n for n in all_ if len(n) == 3))]), month)
    by_month = seen(F.lit(r"\b(?:"), names, F.lit(r")\b"))
    points = lambda when, n: F.when(when, n).otherwise(0)
    score = BACKED + points(by_year, YEAR) + points(by_day_year, DAY_YEAR) + points(by_digit, ONE_DIGIT) + points(by_day_month, DAY_MONTH) + points(by_day, EXACT_DAY) + points(mark, LABEL) + points((F.col("years") == 10) & ~by_year & ~by_day, TEN_YEARS)
    good = rows.where(by_year | by_day_year | by_digit | (mark & (by_day_month | by_month)))
    seq = F.struct(F.lit(2).alias("stage"), F.lit(0).alias("vi"), F.lit(0).alias("pos"), F.lit(0).alias("n"), F.col("place").alias("place"))
    return good.select("sample_id", "iso", F.lit(None).cast("string").alias("raw"), score.cast("double").alias("score"), F.format_string("expiry_backoff_%dy_v6", F.col("years")).alias("method"), F.lit(None).cast("string").alias("variant"), seq.alias("seq"))


def candidates(items: DataFrame, context: DataFrame, today: str) -> DataFrame:
    """All candidates of all samples, with variant and order. Dates and labels are read by several methods, so they are written once."""
    dates = written(dated(items, context, today).drop("vi", "n", "text", "end"), "dates")
    labels = written(signalled(items).select("sample_id", "variant", "pos", *BOX, "similarity", "at"), "labels")
    found = [labelled(dates, labels, today), eliminated(dates, today), backed_off(items, dates, labels, context, today)]
    return reduce(DataFrame.unionByName, [f.select(*CANDIDATE) for f in found])


def ranked(found: DataFrame) -> DataFrame:
    """The best candidate of each date, with seven points for each further variant that has the date; place is its rank in the sample."""
    support = found.groupBy("sample_id", "iso").agg(F.collect_set("variant").alias("variants"), F.min("seq").alias("first"), F.max_by(F.struct("score", "raw", "method", "variant"), F.struct("score", -F.col("seq.stage"), -F.col("seq.vi"), -F.col("seq.pos"), -F.col("seq.n"), -F.col("seq.place"))).alias("best"))
    rows = support.select("sample_id", "iso", "first", F.size("variants").alias("agreement"), F.array_join(F.array_sort("variants"), " | ").alias("variants"), "best.*").withColumn("score", F.col("score") + 7.0 * F.greatest(F.lit(0), F.col("agreement") - 1))
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("sample_id").orderBy(F.desc("score"), "first"))).drop("first")


def decided(found: DataFrame, items: DataFrame, manifest: DataFrame, context: DataFrame) -> DataFrame:
    """One row for each sample of the manifest: date, method, score, margin to the next date, status and all dates."""
    rows = ranked(found).groupBy("sample_id").agg(F.min_by(F.struct("iso", "raw", "method", "score", "variant", "agreement", "variants"), "place").alias("best"), F.min(F.when(F.col("place") == 2, F.col("score"))).alias("second"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "iso"))), lambda x: x["iso"]), " | ").alias("all_dates"))
    seen = items.select("sample_id", F.lit(True).alias("has_items")).distinct()
    r = manifest.select("sample_id").join(rows, "sample_id", "left").join(seen, "sample_id", "left").join(context, "sample_id", "left")
    margin = F.col("best.score") - F.col("second")
    status = F.when(F.col("best").isNull(), F.when(F.col("has_items"), "no_date_found").otherwise("no_ocr_items")).when((F.col("best.score") >= 88) & F.coalesce(margin >= 4, F.lit(True)), "high_confidence").when(F.col("best.score") >= 65, "medium_confidence").otherwise("low_confidence")
    return r.select("sample_id", status.alias("status"), F.col("best.iso").alias("date_of_issue"), F.col("best.raw").alias("raw_date"), F.col("best.method").alias("method"), F.round("best.score", 3).alias("score"), F.round(margin, 3).alias("score_margin"), "birth", "expiry", "context_source", F.col("best.variant").alias("variant"), F.col("best.agreement").alias("agreement"), F.coalesce("all_dates", F.lit("")).alias("all_dates"))
