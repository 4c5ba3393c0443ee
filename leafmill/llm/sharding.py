"""Reproducible shuffle into shards by a Feistel permutation with cycle walking.

Rows get global numbers 0..N-1 in the order of (doc_id, crc32 of the text, size). A keyed Feistel network permutes
the smallest even-bit domain that holds N; a value beyond N walks on through the network until it falls below N, so the
network is a permutation of 0..N-1. Permuted number p has shard p mod S and slot p div S: shard sizes differ by one row at
most, slots have no gaps, and shard and slot of any row number can be computed, and inverted, without a table.

Only doc_id, size and checksum are sorted; texts do not move. The sorted table is written once, so row numbers stay the same
if a task is repeated; the driver sees one count per partition.

Defined cases: null text has size 1 and checksum 0; null doc_ids come first; rows that agree in all three are
interchangeable; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.common import extended, map_arrow, materialise

SHARDS = 8
KEY = 20_240_601
ROUNDS = 6


def half_bits(n: int) -> int:
    return max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)


def mixed(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser of values and round key."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key & (2**64 - 1))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def network(x: np.ndarray, bits: int, key: int, back: bool) -> np.ndarray:
    low, b = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> b, x & low
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if back:
            left, right = right ^ (mixed(left, key * 31 + r) & low), left
        else:
            left, right = right, left ^ (mixed(right, key * 31 + r) & low)
    return (left << b) | right


def permuted(x: np.ndarray, n: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """The permutation of 0..n-1, or its inverse; x holds numbers below n."""
    bits = half_bits(n)
    out = network(x.astype(np.uint64), bits, key, back)
    while (over := out >= np.uint64(n)).any():
        out[over] = network(out[over], bits, key, back)
    return out.astype(np.int64)


def locate(row: int, n: int, shards: int = SHARDS, key: int = KEY) -> tuple[int, int]:
    """Shard and slot of a global row number."""
    p = int(permuted(np.array([row]), n, key)[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int = SHARDS, key: int = KEY) -> int:
    """Global row number at a shard and slot."""
    return int(permuted(np.array([slot * shards + shard]), n, key, back=True)[0])


def numbered(rows: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """rows with global numbers from 0 in the given order; the sorted rows are written once."""
    placed = materialise(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__at", 33).cast("int")
    counts = placed.groupBy(part.alias("part")).count().orderBy("part").collect()  # a row per partition
    starts, total = [], 0
    for r in counts:
        starts.append((r["part"], total))
        total += r["count"]
    offsets = rows.sparkSession.createDataFrame(starts, "__part int, __start long")
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), part == F.col("__part")).withColumn(name, F.col("__start") + within).drop("__at", "__part", "__start"), total


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of docs."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed, total = numbered(rows, ["doc_id", "text_crc32", "size"])

    def out(batch: pa.RecordBatch) -> dict:
        p = permuted(batch.column(3).to_numpy(), total, key)
        return {c: batch.column(i) for i, c in enumerate(("doc_id", "size", "text_crc32"))} | {"shard": p % shards, "slot": p // shards}

    schema = extended(placed.select("doc_id", "size", "text_crc32").schema, "shard int, slot long")
    done = map_arrow(placed.select("doc_id", "size", "text_crc32", "row_number"), out, schema)
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
