"""Toxic passages as maximum-scoring segments of token log-odds.

Lexicon: over labelled training documents, each token's log-odds of occurring in toxic against clean documents, under
an informative Dirichlet prior in proportion to the token's overall frequency; repeated texts count once. Tokens are kept if the signed root
of their likelihood ratio exceeds what the largest of as many unrelated tokens is expected to reach, sqrt(2 ln V), by `MARGIN`; all
others share the (negative) log-odds of the rest.

Scan: one pass finds all maximal scoring segments of a text (Ruzzo and Tompa), each a passage that neither extension nor
trimming improves. A segment of score S among n tokens has the expectation E = K n exp(-lambda S) under the clean
distribution; lambda solves sum p(s) exp(lambda s) = 1 and K is fitted on clean training documents. A document's evidence sums
ln(1/E) over its significant segments (E below one), and a logistic function calibrates it.

Training takes `LABELLED` rows at most, chosen by a hash of doc_id; that bounds the fitted model and what the driver sees. The lexicon is
learnt on all of them, and the calibration by cross-fitting: each half is scored by the lexicon of the other half. Everything else covers
all documents. Labels, lang, source and doc_id are never inputs of a score.

Defined cases: null text is empty and scores as a text without passages; labels of null doc_id or null class are not used; of several
labels of a document the largest holds; without labels of both classes every score is 0; repeated rows give repeated rows; an empty
table gives an empty table. Further columns may have any names: toxicity() ignores them, civil() keeps them.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import drop_table, extended, map_arrow, materialise, spare

LABELLED = 30_000
PRIOR = 2_000.0
MARGIN = 0.3
REMEMBERED = 500_000

LETTERS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    rest: float = -1e-3
    lam: float = 1.0
    k: float = 1.0
    a: float = -50.0
    b: float = 0.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (begin, end, score) in linear time: Ruzzo and Tompa's scan.

    Each candidate knows the last one before it that starts from a smaller total, so the search for where a new one joins skips all
    others, and what it passes over is not passed again.
    """
    found: list[tuple[int, int, float, float, int]] = []  # begin, end, total left of it, total at its end, the last one with a smaller left total
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        begin, left, j = i, before, len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= total:
                found.append((begin, i + 1, left, total, j))
                break
            begin, _, left, _, after = found[j]
            del found[j:]
            j = after
    return [(b, e, r - l) for b, e, l, r, _ in found]


class Scanner:
    """Finds the passages of texts by one model; remembers which white-space units hold lexicon tokens, up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.seen, self.hot = model, set(), {}

    def units(self, text: str) -> list[str]:
        found = text.lower().split()
        new = set(found) - self.seen
        if len(self.seen) + len(new) > REMEMBERED:
            self.seen = set()
        for u in new:
            s = [self.model.lexicon.get(t, 0.0) for t in LETTERS.findall(u)]
            if any(s):
                self.hot[u] = sum(s)
        self.seen |= new
        return found

    def passages(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """Maximal segments (first unit, unit after the last, score) and the number of units."""
        u = self.units(text or "")
        hot = self.hot
        at = [i for i, x in enumerate(u) if x in hot]
        if not at:
            return [], len(u)
        line, where, last = [], [], -1
        for i in at:  # what lies between two scored units is one negative step
            if i - last > 1:
                line.append((i - last - 1) * self.model.rest)
                where.append(last + 1)
            line.append(hot[u[i]])
            where.append(i)
            last = i
        where.append(last + 1)
        return [(where[b], where[e], s) for b, e, s in segments(line)], len(u)

    def evidence(self, text: str | None) -> float:
        """Sum of ln(1/E) over the significant segments."""
        found, n = self.passages(text)
        base = math.log(max(self.model.k * n, 1e-300)) if n else 0.0
        return sum(max(0.0, self.model.lam * s - base) for _, _, s in found)

    def score(self, text: str | None) -> float:
        return 1.0 / (1.0 + math.exp(min(700.0, max(-700.0, -(self.model.a + self.model.b * self.evidence(text))))))


def training_rows(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """text, toxic, fold of at most about bound labelled rows outside the held-out fifth."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = usable.count()
    if n > bound:
        usable = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < int((1 << 30) * bound / n))
    side = usable.select(F.col("doc_id").alias("id_"), F.col("toxic").cast("int").alias("toxic"))
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.join(F.broadcast(side), F.col("doc_id") == F.col("id_")).select("text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2)).cast("int").alias("fold"))


def lexicon(rows: DataFrame) -> tuple[list, float, float]:
    """(token, log-odds, clean rate per token) of the tokens kept, the log-odds of the rest and the clean rate of the rest."""

    def count(batch: pa.RecordBatch) -> dict:
        sums: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for t in set(LETTERS.findall(text.lower())):
                sums.setdefault(t, [0, 0])[toxic] += 1
        return {"token": list(sums), "clean": [x[0] for x in sums.values()], "toxic": [x[1] for x in sums.values()]}

    counts = map_arrow(rows.select("text", "toxic"), count, "token string, clean long, toxic long").groupBy("token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = materialise(counts, "counts")
    n0, n1, v = counts.agg(F.sum("clean"), F.sum("toxic"), F.count("*")).first()
    if not n0 or not n1:
        return [], -1e-3, 1.0
    prior = PRIOR * (F.col("clean") + F.col("toxic")) / (n0 + n1)
    odds = lambda y, n: F.log((y + prior) / (n + PRIOR - y - prior))
    delta = odds(F.col("toxic"), n1) - odds(F.col("clean"), n0)
    both = F.col("toxic") + F.col("clean")
    part = lambda y, n: F.when(y > 0, y * F.log(y * (n0 + n1) / (both * n))).otherwise(F.lit(0.0))
    ratio = F.sqrt(F.greatest(F.lit(0.0), 2 * (part(F.col("toxic"), n1) + part(F.col("clean"), n0))))
    least = math.sqrt(2 * math.log(max(v, 2))) + MARGIN
    kept = counts.select("token", "clean", "toxic", delta.alias("delta"), ratio.alias("z")).where((F.col("delta") > 0) & (F.col("z") >= least)).collect()  # tokens of bound rows that stand out
    drop_table(counts)
    p0 = sum(r["clean"] for r in kept) / n0
    p1 = sum(r["toxic"] for r in kept) / n1
    rest = math.log((1 - p1) / (1 - p0)) if p1 < 1 and p0 < 1 else -1.0
    return [(r["token"], r["delta"], r["clean"] / n0) for r in kept], min(rest, -1e-4), 1 - p0


def karlin(scores: list[tuple[float, float]]) -> float:
    """The positive lambda with sum p exp(lambda s) = 1."""
    f = lambda x: sum(p * math.exp(min(500, x * s)) for s, p in scores) - 1
    low, high = 1e-6, 1.0
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope, by Newton's method with a little ridge."""
    w, m = np.zeros(2), np.column_stack([np.ones_like(x), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        h = (m * (p * (1 - p))[:, None]).T @ m + np.diag([1e-3, 1e-3])
        step = np.linalg.solve(h, m.T @ (y - p) - 1e-3 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def learnt(rows: DataFrame) -> Model:
    """Lexicon and lambda from training rows; the calibration is open."""
    kept, rest, clean_rest = lexicon(rows.dropDuplicates(["text", "toxic"]))
    model = Model({t: s for t, s, _ in kept}, rest)
    if kept:
        model.lam = karlin([(s, max(p, 1e-9)) for _, s, p in kept] + [(rest, clean_rest)])
    return model


def segment_scores(rows: DataFrame, model: Model) -> list:
    """toxic, n (units) and lambda times the scores of the segments of each training row: bound rows at most."""

    def found(batch: pa.RecordBatch) -> dict:
        scan = Scanner(model)
        each = [scan.passages(t) for t in batch.column(0).to_pylist()]
        return {"toxic": batch.column(1), "n": [n for _, n in each], "scores": [[model.lam * s for _, _, s in x] for x, _ in each]}

    return map_arrow(rows.select("text", "toxic"), found, "toxic int, n long, scores array<double>").collect()


def fitted(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Model:
    rows = materialise(training_rows(docs, labels, bound), "labelled")
    model = learnt(rows)
    halves = [(rows.where(F.col("fold") == i), learnt(rows.where(F.col("fold") != i))) for i in (0, 1)]
    sample = [r for half, other in halves for r in segment_scores(half, other)]
    clean = [(max(r["scores"], default=0.0), r["n"]) for r in sample if r["toxic"] == 0 and r["n"]]
    if clean and any(r["toxic"] for r in sample) and all(other.lexicon for _, other in halves):
        # the best segment of a clean document has an expectation of about one: K is what makes that so
        model.k = float(np.exp(np.median([s - math.log(n) for s, n in clean])))
        ev = np.array([sum(max(0.0, s - math.log(max(model.k * r["n"], 1e-300))) for s in r["scores"]) for r in sample])
        model.a, model.b = logistic(ev, np.array([r["toxic"] for r in sample], float))
    drop_table(rows)
    return model


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with the score of each text."""
    columns = docs.columns
    (own,) = spare(columns, "text_")
    source = docs.select(*[F.col(f"`{c}`") for c in columns], F.col("text").alias(own))

    def rows(batch: pa.RecordBatch) -> dict:
        scan = scanner(model)
        return {c: batch.column(i) for i, c in enumerate(columns)} | {name: [scan.score(t) for t in batch.column(len(columns)).to_pylist()]}

    return map_arrow(source, rows, extended(docs.schema, f"`{name}` double"))


_scanners: dict[int, Scanner] = {}


def scanner(model: Model) -> Scanner:
    if id(model) not in _scanners:
        _scanners.clear()
        _scanners[id(model)] = Scanner(model)
    return _scanners[id(model)]


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of docs."""
    model = fitted(docs, labels, bound)
    done = scored(docs.select("doc_id", "text"), model)
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def civil(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """docs without those whose score is 0.5 or more."""
    (score,) = spare(docs.columns, "score")
    return scored(docs, fitted(docs, labels, bound), score).where(F.col(score) < 0.5).drop(score)
