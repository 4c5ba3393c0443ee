"""Removal of repeated substrings by common-prefix interval trees over a range-partitioned, enhanced suffix array.

All byte strings of `n` bytes that start in two or more places of the corpus are found, and every byte that one of them covers
is removed.

1. Anchors. Among the hashes of the n - k + 1 grams of k bytes in any n-byte string the smallest (leftmost of equals) is an
   anchor, so equal strings have equal anchors at equal offsets. About 2 in n - k + 2 positions are anchors. An anchor's
   context is what n-byte strings with this anchor can cover: n - k bytes before its gram and n from its start.
2. Equal contexts (128 bits of digest; combined before the shuffle) are one entry of the array; if there are two or more, the
   whole context is repeated. Contexts whose gram has no other context are done.
3. Suffix array. The starts of n-byte strings in a context are served by suffixes at every `step`-th place: all strings of a
   place share a core of n - step + 1 bytes. The suffixes of all contexts are sorted globally, by range partitions over core (its
   digest), what follows it and what stands before it, so equal grams, however many, fall into as many tasks as they need.
4. Intervals. A stack scan over the common-prefix lengths of neighbours gives for each suffix the intervals of the common-prefix
   tree that hold it; the stack is a set of lengths, one bit each. Each chunk of a partition reports its first and last
   suffix with their stacks, and the driver carries the stacks across borders (a row for each chunk). An interval's key is its
   core and the prefix that its members share.
5. Left extension. Members are sorted globally by interval and by the bytes before them, read backwards; the longer of the common
   lengths with both neighbours is how far a member extends to the left with any other member. The interval is a maximal repeat
   group for the members whose left and right extensions together reach n bytes. Neighbours across a border are compared
   on the driver (two rows for each chunk).
6. Anchors take their context's ranges; a document's ranges meet its text by doc_id and text digest.

Strings are judged on the input. No group is gathered: both sorts split equal keys by the bytes that follow, and rows are at most
one for each suffix and interval that holds it.

Defined cases: null text is empty; texts under n bytes are kept whole; repeated rows are documents of their own, so each of them is
a repeat of the other; rows without doc_id take part; columns other than doc_id and text are ignored, whatever their names; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import drop_table, extended, map_arrow, materialise

LENGTH = 200
GRAM = 40
#: Starts that one suffix serves; a stack of prefix lengths 0..STEP - 1 fits into 64 bits.
STEP = 54
#: Rows of the sorted suffixes that one scan holds; it reports its borders to the driver.
CHUNK = 1 << 16
#: Positions that one pass of the anchor search covers; with the overlap fewer than 2 ** 20.
PASS = 1 << 19

_B = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """B ** i and B ** -i modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < size:
        size = 1 << max(16, size.bit_length())
        _powers.clear()
        for base in (_B, pow(_B, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0], _powers[1]


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A mixed 64-bit hash of the k bytes from each position."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[: len(data) - k + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def window_least(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each w neighbours, by running minima forwards and backwards within blocks of w."""
    n = len(x) - w + 1
    pad = -len(x) % w
    blocks = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def anchors(data: bytes, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the anchor grams of one text."""
    w = n - k + 1
    if len(data) < n:
        return np.array([], np.int64), np.array([], np.uint64)
    low = np.uint64((1 << 20) - 1)
    at, hashes = [], []
    for a in range(0, len(data) - n + 1, PASS):
        h = gram_hashes(np.frombuffer(data, np.uint8, min(len(data) - a, PASS + n - 1), a), k)
        least = window_least((h & ~low) | np.arange(len(h), dtype=np.uint64), w) & low
        keep = np.concatenate([[True], least[1:] != least[:-1]])
        p = least[keep].astype(np.int64)
        at.append(p + a)
        hashes.append(h[p])
    p, first = np.unique(np.concatenate(at), return_index=True)
    return p, np.concatenate(hashes)[first]


def text_key() -> list[Column]:
    t = F.coalesce("text", F.lit(""))
    return [F.col("doc_id"), F.xxhash64(t).alias("t")]


def anchor_rows(docs: DataFrame, n: int, k: int) -> DataFrame:
    """doc_id, t, p (start), g (gram), c1 and c2 (context) for each anchor."""
    source = docs.select(*text_key(), F.coalesce("text", F.lit("")).cast("binary").alias("b"))
    schema = extended(source.select("doc_id", "t").schema, "p int, g long, c1 long, c2 long")
    w, digest = n - k + 1, xxhash.xxh3_128_digest

    def rows(batch: pa.RecordBatch) -> dict:
        ps, gs, cs, counts = [], [], [], []
        for data in batch.column(2).to_pylist():
            p, g = anchors(data, n, k)
            ps.append(p)
            gs.append(g)
            counts.append(len(p))
            cs += [digest(data[max(0, x - w + 1) : x + n], min(x, w - 1)) for x in p.tolist()]
        take = pa.array(np.repeat(np.arange(len(counts)), counts))
        g = np.concatenate(gs).astype(np.uint64).view(np.int64)
        c = np.frombuffer(b"".join(cs), "<i8").reshape(-1, 2)
        return {"doc_id": batch.column(0).take(take), "t": batch.column(1).take(take), "p": np.concatenate(ps).astype(np.int32), "g": g, "c1": c[:, 0], "c2": c[:, 1]}

    return map_arrow(source, rows, schema)


def suffixes(docs: DataFrame, wanted: DataFrame, n: int, k: int, step: int) -> DataFrame:
    """c1, c2 (context), many, place, k1, k2 (core), follows, before (read backwards) of the suffixes of wanted contexts: rows of doc_id, t, p, c1, c2, many."""
    w, core = n - k + 1, n - step + 1
    asked = wanted.groupBy("doc_id", "t").agg(F.collect_list(F.struct("p", "c1", "c2", "many")).alias("asked"))
    source = docs.select(F.col("doc_id").alias("id_"), text_key()[1].alias("t_"), F.coalesce("text", F.lit("")).cast("binary").alias("b"))
    both = source.join(asked, F.col("id_").eqNullSafe(F.col("doc_id")) & (F.col("t_") == F.col("t"))).select("b", "asked")
    places = range(0, -w, -step)
    seeds = {place: i for i, place in enumerate(places)}

    def rows(batch: pa.RecordBatch) -> dict:
        c1, c2, many, at, cores, follows, before = [], [], [], [], [], [], []
        digest = xxhash.xxh3_128_digest
        for data, asks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            size = len(data)
            for a in asks:
                p = a["p"]
                first, end = max(0, p - w + 1), min(size, p + n)
                for place in places:
                    x = p + place
                    y = x + core
                    if x < first or y > end:
                        continue
                    c1.append(a["c1"])
                    c2.append(a["c2"])
                    many.append(a["many"])
                    at.append(place)
                    cores.append(digest(data[x:y], seeds[place]))
                    follows.append(data[y : min(end, y + step - 1)])
                    before.append(data[max(first, x - step + 1) : x][::-1])
        keys = np.frombuffer(b"".join(cores), "<i8").reshape(-1, 2)
        return {"c1": c1, "c2": c2, "many": many, "place": at, "k1": keys[:, 0], "k2": keys[:, 1], "follows": follows, "before": before}

    return map_arrow(both, rows, "c1 long, c2 long, many boolean, place int, k1 long, k2 long, follows binary, before binary")


def chunked(frame: DataFrame, size: int, solve: Callable[[pa.Table, int], pa.Table], schema: str) -> DataFrame:
    """solve() over runs of `size` rows of each partition, with a number that rises with partition and run."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(T._parse_datatype_string(schema))

    def told(held: list[pa.RecordBatch], chunk: int) -> list[pa.RecordBatch]:
        return solve(pa.Table.from_batches(held), chunk).select(target.names).cast(target).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = itertools.count(TaskContext.get().partitionId() << 32)
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, size - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == size:
                    yield from told(held, next(number))
                    held, n = [], 0
        if n:
            yield from told(held, next(number))

    return frame.mapInArrow(run, schema)


def matrix(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings of up to width bytes as rows of a matrix, and their lengths."""
    x = column.combine_chunks()
    size = pa.compute.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(x), width), np.uint8)
    out[np.arange(width) < size[:, None]] = np.frombuffer(b"".join(x.to_pylist()), np.uint8)
    return out, size


def common(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Lengths of the common prefixes of the rows of two such matrices."""
    differ = a[0] != b[0]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), differ.shape[1])
    return np.minimum(first, np.minimum(a[1], b[1]))


def neighbours(keys: np.ndarray, text: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each row but the first its common prefix with the row before it; -1 where their keys differ."""
    lcp = common((text[0][1:], text[1][1:]), (text[0][:-1], text[1][:-1]))
    return np.where((keys[1:] == keys[:-1]).all(axis=1), lcp, -1)


def clamped(stack: int, length: int) -> int:
    """A stack of prefix lengths, seen from a suffix that shares `length` bytes with the one it belongs to."""
    return stack & (1 << length) - 1 | (stack >> length > 0) << length if length >= 0 else 0


def stacks(lcp: list[int]) -> list[int]:
    """For each suffix the set (one bit each) of the common-prefix lengths with all earlier ones of its core: the open intervals of a stack scan."""
    out, now = [0], 0
    for x in lcp:
        now = now & (1 << x) - 1 | 1 << x if x >= 0 else 0
        out.append(now)
    return out


SCANNED = "c1 long, c2 long, many boolean, place int, k1 long, k2 long, follows binary, before binary, own long, chunk long, to_first int, to_last int, border array<long>"


def scanned(sorted_rows: DataFrame, step: int, size: int) -> DataFrame:
    """The suffixes that share their core with another: intervals within their chunk (own), bytes shared with the chunk's first and last suffix
    (to_first, to_last; -1: another core). Of each chunk the first and the last row have border: first or last (0, 1), the stack seen from there, and what the chunk's ends share."""

    def solve(rows: pa.Table, chunk: int) -> pa.Table:
        keys = np.stack([rows.column(c).to_numpy() for c in ("k1", "k2")], axis=1)
        text = matrix(rows.column("follows"), step - 1)
        lcp = neighbours(keys, text)
        ahead, back = stacks(lcp.tolist()), stacks(lcp[::-1].tolist())[::-1]
        ends = [np.where((keys == keys[i]).all(axis=1), common(text, (text[0][i][None], text[1][i][None])), -1) for i in (0, -1)]
        own = np.array([x | y for x, y in zip(ahead, back)], np.int64)
        take = np.flatnonzero((own > 0) | (ends[0] >= 0) | (ends[1] >= 0))  # both ends are among them
        border: list = [None] * len(take)
        through = int(ends[0][-1])
        out = {c: rows.column(c).take(pa.array(take)) for c in rows.column_names}
        told = {"own": own[take], "chunk": np.full(len(take), chunk), "to_first": ends[0][take].astype(np.int32), "to_last": ends[1][take].astype(np.int32)}
        border[0] = [0, back[0], through]
        if len(take) == 1:  # the first row is the last one too
            border[0] = [2, 0, int(text[1][0])]
        else:
            border[-1] = [1, ahead[-1], through]
        return pa.table(out | told | {"border": pa.array(border, pa.list_(pa.int64()))})

    return chunked(sorted_rows, size, solve, SCANNED)


def carried(borders: list) -> list[tuple[int, int, int]]:
    """(chunk, stack from the left, stack from the right) of the chunks that share a core with a neighbour, from the border rows of all chunks."""
    ends: dict[int, list] = {}
    for r in sorted(borders, key=lambda r: (r["chunk"], r["border"][0])):
        ends.setdefault(r["chunk"], []).append(r)
    order = list(ends)

    def shared(a, b) -> int:
        if (a["k1"], a["k2"]) != (b["k1"], b["k2"]):
            return -1
        return next((i for i, (x, y) in enumerate(zip(a["follows"], b["follows"])) if x != y), min(len(a["follows"]), len(b["follows"])))

    def carry(chunks: list[int], out_at: int, in_at: int) -> dict[int, int]:
        found, now = {}, 0
        for a, b in zip(chunks, chunks[1:]):
            out, into = ends[a][out_at], ends[b][in_at]
            whole = out["border"][2]
            inside = out["border"][1] | clamped(now, whole)
            length = shared(out, into)
            now = clamped(inside, length) | 1 << length if length >= 0 else 0
            found[b] = now
        return found

    left, right = carry(order, -1, 0), carry(order[::-1], 0, -1)
    return [(c, left.get(c, 0), right.get(c, 0)) for c in order if left.get(c, 0) or right.get(c, 0)]


def intervals(rows: DataFrame, step: int) -> DataFrame:
    """One row for each suffix and interval that holds it: c1, c2, many, place, n1, n2 (interval), q (bytes after the core that its members share), before."""
    spark = rows.sparkSession
    borders = rows.where(F.col("border").isNotNull()).select("chunk", "k1", "k2", "follows", "border").collect()  # two rows a chunk
    carries = spark.createDataFrame(carried(borders), "chunk long, from_left long, from_right long")

    def seen(stack: str, length: str) -> Column:
        m = F.expr(f"shiftleft(1L, greatest({length}, 0))")
        over = F.when(F.expr(f"shiftright({stack}, greatest({length}, 0))") > 0, m).otherwise(F.lit(0).cast("long"))
        return F.when(F.col(length) >= 0, F.coalesce(F.col(stack).bitwiseAND(m - 1).bitwiseOR(over), F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))

    every = rows.join(F.broadcast(carries), "chunk", "left")
    every = every.withColumn("held", F.col("own").bitwiseOR(seen("from_left", "to_first")).bitwiseOR(seen("from_right", "to_last")))
    # an interval with q bytes after the core needs step - 1 - q before it
    lengths = F.filter(F.sequence(F.greatest(F.lit(0), F.lit(step - 1) - F.length("before")), F.lit(step - 1)), lambda q: F.col("held").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), q)) != 0)
    each = every.select("c1", "c2", "many", "place", "k1", "k2", "follows", "before", F.explode(lengths).alias("q"))
    shared = F.substring("follows", F.lit(1), F.col("q"))
    return each.select("c1", "c2", "many", "place", F.xxhash64("k1", "k2", "q", shared).alias("n1"), F.xxhash64(F.lit(1), shared, "q", "k2", "k1").alias("n2"), "q", "before")


EXTENDED = "c1 long, c2 long, many boolean, a int, b int, edge struct<chunk: long, last: boolean, n1: long, n2: long, before: binary, place: int, q: int>"


def left_extended(sorted_rows: DataFrame, n: int, step: int, size: int) -> DataFrame:
    """Ranges [a, b) of a context, relative to its gram's start, that the members of an interval repeat; the first and the last row of each chunk come as edges."""
    core = n - step + 1

    def solve(rows: pa.Table, chunk: int) -> pa.Table:
        keys = np.stack([rows.column(c).to_numpy() for c in ("n1", "n2")], axis=1)
        lcp = neighbours(keys, matrix(rows.column("before"), step - 1))
        e = np.maximum(np.concatenate([[-1], lcp]), np.concatenate([lcp, [-1]]))
        place, q = (rows.column(c).to_numpy() for c in ("place", "q"))
        many = rows.column("many").to_numpy()
        good = np.flatnonzero((e >= step - 1 - q) & ~many)  # contexts that repeat as a whole are only what others repeat
        ends = np.array([0, len(e) - 1])
        take = np.concatenate([good, ends])
        edge = [None] * len(good) + [{"chunk": chunk, "last": last, **{c: rows.column(c)[int(i)].as_py() for c in ("n1", "n2", "before", "place", "q")}} for i, last in zip(ends, (False, True))]
        kind = pa.struct([("chunk", pa.int64()), ("last", pa.bool_()), ("n1", pa.int64()), ("n2", pa.int64()), ("before", pa.binary()), ("place", pa.int32()), ("q", pa.int32())])
        told = {"a": (place - e)[take].astype(np.int32), "b": (place + core + q)[take].astype(np.int32), "edge": pa.array(edge, kind)}
        return pa.table({c: rows.column(c).take(pa.array(take)) for c in ("c1", "c2", "many")} | told)

    return chunked(sorted_rows, size, solve, EXTENDED)


def across(edges: list, n: int, step: int) -> list[tuple[int, int, int, int]]:
    """(c1, c2, a, b) that neighbours on either side of a border share."""
    out = []
    rows = sorted(edges, key=lambda r: (r["edge"]["chunk"], r["edge"]["last"]))
    for x, y in zip(rows, rows[1:]):
        u, v = x["edge"], y["edge"]
        if u["chunk"] != v["chunk"] and (u["n1"], u["n2"]) == (v["n1"], v["n2"]):
            e = next((i for i, (p, q) in enumerate(zip(u["before"], v["before"])) if p != q), min(len(u["before"]), len(v["before"])))
            if e >= step - 1 - u["q"]:
                out += [(r["c1"], r["c2"], r["edge"]["place"] - e, r["edge"]["place"] + n - step + 1 + r["edge"]["q"]) for r in (x, y)]
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def repeat_spans(docs: DataFrame, n: int = LENGTH, k: int = GRAM, step: int = STEP, chunk: int = CHUNK) -> DataFrame:
    """doc_id, t (digest of the text), spans: for each document with repeats, sorted disjoint byte ranges [a, b) that repeats cover."""
    w = n - k + 1
    found = materialise(anchor_rows(docs, n, k), "anchors")
    kinds = materialise(found.groupBy("g", "c1", "c2").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "t", "p")).alias("one")).select("g", "c1", "c2", (F.col("copies") > 1).alias("many"), "one"), "contexts")
    grams = materialise(kinds.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "grams")
    wanted = materialise(kinds.join(grams, "g", "left_semi").select("one.*", "c1", "c2", "many"), "wanted")
    many = materialise(kinds.where("many").select("c1", "c2"), "many")
    for table in (found, kinds, grams):
        drop_table(table)
    place = ["k1", "k2", "follows", "before"]
    ordered = suffixes(docs, wanted, n, k, step).repartitionByRange(*place).sortWithinPartitions(*place)
    held = materialise(scanned(ordered, step, chunk), "suffixes")
    place = ["n1", "n2", "before"]
    members = left_extended(intervals(held, step).repartitionByRange(*place).sortWithinPartitions(*place), n, step, chunk)
    # all strings of a context hold its gram, so what repeats of it is one range
    ranges = materialise(members.groupBy("c1", "c2", "many").agg(F.min(F.when(F.col("edge").isNull(), F.col("a"))).alias("a"), F.max(F.when(F.col("edge").isNull(), F.col("b"))).alias("b"), F.collect_list("edge").alias("edges")), "ranges")
    edges = ranges.where(F.size("edges") > 0).select("c1", "c2", F.explode("edges").alias("edge")).collect()  # two rows a chunk
    beyond = docs.sparkSession.createDataFrame(across(edges, n, step), "c1 long, c2 long, a int, b int")
    whole = many.select("c1", "c2", F.lit(1 - w).alias("a"), F.lit(n).alias("b"))
    own = ranges.where("a is not null").select("c1", "c2", "a", "b").union(beyond).groupBy("c1", "c2").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    spans = materialise(own.join(many, ["c1", "c2"], "left_anti").union(whole), "ranges")
    for table in (wanted, many, held, ranges):
        drop_table(table)
    # anchors are found again: kept through both sorts they would take more disk than any other table
    hit = anchor_rows(docs, n, k).join(spans, ["c1", "c2"]).select("doc_id", "t", F.greatest(F.lit(0), F.col("p") + F.col("a")).alias("a"), (F.col("p") + F.col("b")).alias("b"))
    done = materialise(hit.groupBy("doc_id", "t").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")
    drop_table(spans)
    return done


def without_repeats(docs: DataFrame, n: int = LENGTH, k: int = GRAM, step: int = STEP, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans for each row of docs."""
    spans = repeat_spans(docs, n, k, step, chunk)
    source = docs.select(F.col("doc_id").alias("id_"), text_key()[1].alias("t_"), F.coalesce("text", F.lit("")).cast("binary").alias("b"))
    both = source.join(spans, F.col("id_").eqNullSafe(F.col("doc_id")) & (F.col("t_") == F.col("t")), "left").select(F.col("id_").alias("doc_id"), "b", "spans")
    schema = extended(both.select("doc_id").schema, "n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<a:int,b:int>>")

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "removed")}
        for data, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            cut = merged([(r["a"], min(r["b"], len(data))) for r in found or []])
            digest, at = hashlib.sha256(), 0
            for a, b in cut:
                digest.update(data[at:a])
                at = b
            digest.update(data[at:])
            for name, v in zip(out, (len(data), sum(b - a for a, b in cut), len(cut), digest.hexdigest(), [{"a": a, "b": b} for a, b in cut])):
                out[name].append(v)
        return {"doc_id": batch.column(0)} | out

    return map_arrow(both, rows, schema)
