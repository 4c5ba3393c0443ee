"""Near copies for the pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Words are those of simhash (A-Z lower-cased, between ASCII white space); a shorter text is one shingle, texts without words
are copies of each other. At similarity 0.8 two 64-bit SimHashes differ in ten bits on the average, which blocks of agreeing bits
cannot find at any size, so the shards of the candidate search are 32 bands of 5 minima of hashed shingles (all bands miss a pair at
0.8 with a chance of 3e-6). Within a band, texts whose SimHashes differ in `RADIUS` bits or fewer, found in a BK-tree as op1 finds them, are linked by a
spanning forest, never by pairs. Connected candidates meet in one task, once each, where similarities are exact: shared shingles are
counted over an inverted index, and texts that are connected already are not compared again.

Texts and shingles are told apart by 64-bit XXH64.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.common import broadcast_if_small, extended, map_arrow, materialise, spare

SEED = 42
SHINGLE = 5
SIMILARITY = 0.8
BANDS, MINIMA = 32, 5
RADIUS = 24
_RNG = np.random.default_rng(SEED)
FACTORS = _RNG.integers(0, 2**63, BANDS * MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MASKS = _RNG.integers(0, 2**63, BANDS * MINIMA, dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 of the shingles, as unsigned 64 bits."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = [0, *(ends[: len(words) - n] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begins, ends[n - 1 :].tolist())), np.uint64, len(begins)))


def sketch(found: np.ndarray) -> tuple[int, list[int]]:
    """SimHash of a set of shingles and the keys of its bands, signed."""
    counts, low = np.zeros(64, np.int64), np.full(BANDS * MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):  # blocks, so that a very long text needs little memory
        part = found[at : at + 2048]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        low = np.minimum(low, ((part[None, :] ^ MASKS[:, None]) * FACTORS[:, None]).min(axis=1))
    fp = int(np.packbits(counts * 2 > len(found), bitorder="little").view(np.int64)[0])
    rows = low.reshape(BANDS, MINIMA)
    return fp, [xxhash.xxh64_intdigest(r.tobytes(), i) - (1 << 63) for i, r in enumerate(rows)] if len(found) else []


def with_nodes(docs: DataFrame, name: str) -> DataFrame:
    """docs with the digest of each text's words under a name that docs doesn't have; equal texts have equal digests."""
    (own,) = spare([*docs.columns, name], "text_")
    source = docs.select("*", F.col("text").alias(own))
    columns = docs.columns
    n = len(columns)

    def rows(batch: pa.RecordBatch) -> dict:
        node = [xxhash.xxh64_intdigest(b" ".join(words_of(t)), SEED) - (1 << 63) for t in batch.column(n).to_pylist()]
        return {c: batch.column(i) for i, c in enumerate(columns)} | {name: node}

    return map_arrow(source, rows, extended(docs.schema, f"`{name}` long"))


def by_key(df: DataFrame, solve: Callable[[list], Iterator[tuple[int, int]]]) -> DataFrame:
    """Edges (u, v) that solve() finds among the rows of each key; df is (key, ...) and sorted by key within partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            edges = []
            key = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a and key[a] != now:
                    edges += solve(held)
                    now, held = key[a], []
                if b > a:
                    held.append(batch.slice(a, b - a))
            yield table(edges)
        yield table(solve(held))

    return df.mapInArrow(run, "u long, v long")


def table(edges) -> pa.RecordBatch:
    edges = list(edges)
    return pa.record_batch({"u": pa.array([u for u, _ in edges], pa.int64()), "v": pa.array([v for _, v in edges], pa.int64())})


def near_in_band(held: list[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
    """A spanning forest of the texts of one band within RADIUS, by a BK-tree of their different SimHashes; what is linked leaves the tree."""
    from leafmill.llm.simhash import BKTree

    if sum(b.num_rows for b in held) < 2:
        return
    first: dict[int, int] = {}
    for b in held:
        for u, x in zip(b.column(1).to_pylist(), b.column(2).to_numpy().view(np.uint64).tolist()):
            if (known := first.setdefault(x, u)) != u:  # copies of a SimHash are no nodes of the tree
                yield known, u
    tree, nodes = BKTree(), list(first.values())
    for x in first:
        tree.add(x)
    for x in first:
        todo = tree.take(x, 0)
        while todo and tree.left[0]:
            me = todo.pop()
            near = tree.take(tree.values[me], RADIUS)
            todo += near
            yield from ((nodes[me], nodes[k]) for k in near)


def alike(held: list[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of SIMILARITY or more among candidates (component, node, shingles)."""
    rows = [(n, np.frombuffer(s, np.uint64)) for b in held for n, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
    while len(rows) > 1:
        sizes = np.array([len(s) for _, s in rows])
        owner, ends = np.repeat(np.arange(len(rows)), sizes), np.cumsum(sizes)
        _, ids, df = np.unique(np.concatenate([s for _, s in rows]), return_inverse=True, return_counts=True)
        posts, starts = owner[np.argsort(ids, kind="stable")], np.cumsum(df) - df
        left, todo, step = np.ones(len(rows), bool), [], max(1, 4_000_000 // len(rows))
        while todo or left.sum() * 2 > len(rows):  # then the index is made anew, of what is left
            if not todo:
                todo = [int(np.argmax(left))]
                left[todo[0]] = False
            me = todo.pop()
            mine, common = ids[ends[me] - sizes[me] : ends[me]], np.zeros(len(rows), np.int64)
            for at in range(0, len(mine), step):
                n, first = df[mine[at : at + step]], starts[mine[at : at + step]]
                common += np.bincount(posts[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(rows))
            near = np.flatnonzero(left & (common >= SIMILARITY * (sizes[me] + sizes - common) - 1e-9))
            left[near] = False
            todo += near.tolist()
            yield from ((rows[me][0], rows[k][0]) for k in near)
        rows = [r for r, x in zip(rows, left) if x]


def edges(rows: DataFrame) -> DataFrame:
    """Edges (u, v) that connect the nodes of near copies, from written rows (node, text). Texts stay where they lie but for candidates."""
    from leafmill.llm.simhash import components

    def sketches(batch: pa.RecordBatch) -> dict:
        first: dict[int, int] = {}  # copies within a batch are sketched once
        for i, n in enumerate(batch.column(0).to_pylist()):
            first.setdefault(n, i)
        fps, bands = zip(*[sketch(shingles(words_of(t))) for t in batch.column(1).take(pa.array(first.values())).to_pylist()])
        return {"node": list(first), "fp": fps, "bands": bands}

    sketched = map_arrow(rows.select("node", "text"), sketches, "node long, fp long, bands array<long>").dropDuplicates(["node"])
    keyed = sketched.select(F.explode("bands").alias("key"), "node", "fp").repartition("key").sortWithinPartitions("key", "node")
    candidates = components(by_key(keyed, near_in_band))
    held = candidates.select("node", F.col("root").alias("component"))
    members = materialise(held.union(held.select(F.col("component").alias("node"), "component")).distinct(), "candidates")
    found = rows.join(broadcast_if_small(members, F.lit(32)), "node").groupBy("node").agg(F.first("component").alias("component"), F.first("text").alias("text")).select("component", "node", "text")

    def sets(batch: pa.RecordBatch) -> dict:
        return {"component": batch.column(0), "node": batch.column(1), "shingles": [shingles(words_of(t)).tobytes() for t in batch.column(2).to_pylist()]}

    dealt = map_arrow(found, sets, "component long, node long, shingles binary").repartition("component").sortWithinPartitions("component", "node")
    return by_key(dealt, alike)
