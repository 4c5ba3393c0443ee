"""SimHash near-duplicate groups by Burkhard-Keller trees.

Fingerprints: whole text, A-Z lower-cased, words between ASCII white space, 4-word shingles with repeats (a
shorter text is one shingle, a text without words has fingerprint zero). A bit is set if it is set in over half
of the shingles' XXH64 values (seed 42).

Two fingerprints link at `radius` or fewer differing bits. All exact copies share a fingerprint, so the search runs
over distinct fingerprints. Cut the 64 bits into b blocks: two fingerprints at most r bits apart agree on at
least b - r whole blocks, so every choice of b - r blocks is a shard key and each linked pair meets in a shard.
b grows with the number of distinct fingerprints, so that a shard holds some `SHARD` of them at any input size. A task builds a
BK-tree per shard (children keyed by their integer Hamming distance to the parent) and probes it along edges within
the radius only. A shard above `tree_rows` is split into blocks, and the tree of each block is sent to every
later block of its shard, so a tree has a proven bound. Trees travel by shuffle: sending them through the driver
would gather the fingerprints of all documents there. A shard emits a spanning forest of its links, never its pairs.

Groups are connected components, by alternating large-star and small-star steps over written tables.

Defined cases: null text is a text without words; rows without doc_id take part, and a group's component_id is its
smallest non-null doc_id (null if it has none); repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from leafmill.llm import near_copies
from leafmill.llm.common import broadcast_if_small, drop_table, extended, map_arrow, materialise, spare

SEED = 42
RADIUS = 4
SHINGLE = 4
TREE_ROWS = 4096
#: Fingerprints of a shard at most, if they are spread evenly.
SHARD = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    if n == 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    counts, at = np.zeros(64, np.int64), 0
    stops = ends[len(words) - n :].tolist()
    while at < n:  # blocks, so that a very long text needs little memory
        block = [digest(joined[a:b], SEED) for a, b in zip(begins[at : at + 65536], stops[at : at + 65536])]
        bits = np.unpackbits(np.array(block, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        at += 65536
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprints(docs: DataFrame, name: str = "fp", keep: list[str] | None = None) -> DataFrame:
    """docs (or the columns in keep) with the fingerprint as a signed long."""
    keep = docs.columns if keep is None else keep
    (own,) = spare([*keep, name], "text_")
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias(own))
    schema = extended(docs.select(*[f"`{c}`" for c in keep]).schema, f"`{name}` long")

    def rows(batch: pa.RecordBatch) -> dict:
        seen: dict[str | None, int] = {}
        out = []
        for text in batch.column(len(keep)).to_pylist():
            fp = seen.get(text)
            if fp is None:
                fp = seen[text] = signed(fingerprint(text))
            out.append(fp)
        return {c: batch.column(i) for i, c in enumerate(keep)} | {name: out}

    return map_arrow(source, rows, schema)


class BKTree:
    """A metric tree over 64-bit integers: the children of a node are keyed by their Hamming distance to it."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        self.left: list[int] = []

    def add(self, value: int) -> int:
        new = len(self.values)
        self.values.append(value)
        self.children.append({})
        at = 0
        while new:
            d = (self.values[at] ^ value).bit_count()
            after = self.children[at].setdefault(d, new)
            if after == new:
                break
            at = after
        return new

    def take(self, value: int, radius: int) -> list[int]:
        """Like near(), but what is found is never found again; subtrees of which nothing is left are not entered."""
        values, children = self.values, self.children
        if len(self.left) != len(values):  # since the last add(): how much of each subtree is left
            self.left, self.above, self.gone = [1] * len(values), [-1] * len(values), [False] * len(values)
            for at in range(len(values) - 1, -1, -1):  # a node's children have larger numbers
                for k in children[at].values():
                    self.above[k] = at
                    self.left[at] += self.left[k]
        found, todo = [], [0] if values and self.left[0] else []
        while todo:
            at = todo.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius and not self.gone[at]:
                found.append(at)
            todo += [k for e, k in children[at].items() if -radius <= e - d <= radius and self.left[k]]
        for at in found:
            self.gone[at] = True
            while at >= 0:
                self.left[at] -= 1
                at = self.above[at]
        return found

    def near(self, value: int, radius: int) -> list[int]:
        """Numbers of the nodes within radius; only edges that can lead to one are followed."""
        found, todo = [], [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            at = todo.pop()
            d = (values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            todo += [k for e, k in children[at].items() if -radius <= e - d <= radius]
        return found


def blocks_for(distinct: int, radius: int) -> int:
    """Fewest blocks whose shards hold SHARD fingerprints each at most, if those are spread evenly."""
    for b in range(radius + 1, radius + 5):
        if distinct <= SHARD * 2 ** (64 * (b - radius) / b):
            return b
    return radius + 4


def shard_masks(blocks: int, radius: int) -> list[int]:
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(x) for x in combinations(parts, blocks - radius)]


def links(fps: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """Edges (u, v) that connect all fingerprints of the distinct column fp within radius, transitively."""
    distinct = fps.count()
    masks = shard_masks(blocks_for(distinct, radius), radius)
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k")) for i, m in enumerate(masks)])).alias("s")).select("s.m", "s.k", "fp")
    big = keyed.groupBy("m", "k").count().where(F.col("count") > tree_rows).select("m", "k", F.ceil(F.col("count") / tree_rows).cast("int").alias("n"))
    split = keyed.join(big, ["m", "k"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("n").cast("long")).cast("int")
    # the tree of block i meets the probes of the blocks i..n-1 in the cells (i, j)
    cells = F.flatten(F.array(F.transform(F.sequence(F.lit(0), F.col("b")), lambda i: F.struct(i.alias("i"), F.col("b").alias("j"))), F.transform(F.sequence(F.col("b"), F.col("n") - 1), lambda j: F.struct(F.col("b").alias("i"), j.alias("j")))))
    rows = split.withColumn("b", own).select("m", "k", "fp", "b", F.explode(F.array_distinct(cells)).alias("c")).select("m", "k", F.col("c.i").alias("i"), F.col("c.j").alias("j"), (F.col("b") == F.col("c.i")).alias("tree"), "fp")
    dealt = rows.repartition("m", "k", "i", "j").sortWithinPartitions("m", "k", "i", "j", F.desc("tree"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, us, vs = None, [], [], []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4)], axis=1)
            tree = batch.column(4).to_numpy(zero_copy_only=False)
            fp = batch.column(5).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(fp)]
            for a, b in zip(cuts, cuts[1:]):
                if (key := tuple(keys[a].tolist())) != shard:
                    forest(shard, held, radius, us, vs)
                    shard, held = key, []
                held.append((tree[a:b], fp[a:b]))
            if us:
                yield pa.record_batch({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})
                us, vs = [], []
        forest(shard, held, radius, us, vs)
        yield pa.record_batch({"u": pa.array(us, pa.int64()), "v": pa.array(vs, pa.int64())})

    return dealt.mapInArrow(run, "u long, v long")


def forest(shard: tuple | None, held: list, radius: int, us: list[int], vs: list[int]) -> None:
    """Add a spanning forest of one cell's links: its tree's rows come first; in a cell on the diagonal they probe too."""
    if sum(len(f) for _, f in held) < 2:
        return
    mask, parent = (1 << 64) - 1, []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    nodes: list[int] = []
    bk = BKTree()
    for in_tree, fps in held:
        for is_tree, x in zip(in_tree.tolist(), fps.tolist()):
            me = len(nodes)
            nodes.append(x)
            parent.append(me)
            if not is_tree or shard[2] == shard[3]:
                for other in bk.near(x & mask, radius):
                    a, b = root(me), root(other)
                    if a != b:
                        parent[a] = b
                        us.append(x)
                        vs.append(nodes[other])
            if is_tree:  # the tree's rows come first, so node numbers agree
                bk.add(x & mask)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge reaches, by alternating large-star and small-star."""
    now = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        new = materialise(small, "edges")
        after = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_table(now)
        now = new
        if after == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = after


def groups(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """From written rows (doc_id, fp): fp, component (smallest fingerprint of the group, signed) and component_id (its smallest doc_id)."""
    fps = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    return named(fps, links(fps.select("fp"), radius))


def named(fps: DataFrame, edges: DataFrame) -> DataFrame:
    """fp, component and component_id of the distinct (fp, doc_id) that edges connect."""
    roots = components(edges)
    each = fps.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("component"))
    least = each.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return each.select("fp", "component").join(least, "component")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row."""
    rows = materialise(with_fingerprints(docs, keep=["doc_id"]), "simhash")
    return rows.join(groups(rows, radius), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """docs with one row of each group of near copies (see near_copies): the smallest doc_id, and one of its rows where it repeats within the group.

    What goes is decided on keys. All columns stay as they are, whatever their names; nulls and empty texts are copies of each other.
    """
    node, row = spare(docs.columns, "node", "row")
    rows = materialise(near_copies.with_nodes(docs, node).withColumn(row, F.monotonically_increasing_id()), "nodes")
    slim = rows.select(F.col(node).alias("fp"), F.col(row).alias("row"), "doc_id")
    nodes = materialise(slim.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    found = named(nodes, near_copies.edges(rows.select(F.col(node).alias("node"), "text")))
    known = slim.join(found, "fp").select("component", "row", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("least"))
    kept = known.where("least").groupBy("component").agg(F.min("row").alias("kept"))
    gone = materialise(known.join(kept, "component").where("row <> kept").select(F.col("row").alias("gone")), "gone")
    (gone_row,) = spare(rows.columns, "gone")
    side = broadcast_if_small(gone, F.lit(24)).withColumnRenamed("gone", gone_row)
    return rows.join(side, F.col(row) == F.col(gone_row), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
