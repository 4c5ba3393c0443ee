"""Benchmark decontamination by a broadcast hash set of n-grams, in DataFrame functions only.

Words: A-Z lower-cased, runs of digits, a-z and characters beyond ASCII. A window is `n` consecutive words of a benchmark item; an
item of fewer words, but not none, is one window. Windows are hashed and broadcast as a long-keyed hash table; every window
of a document of the same word counts is hashed and probed while it streams by, and a hit is verified word by word.
The broadcast side holds hashes and windows only, and its size is measured: beyond `broadcast_bytes` the set is dealt into parts
by hash, and the documents' words, written once, stream past one part after another. Items meet the windows that were hit, not
the documents.

A document's hits meet again in an aggregation by row, combined before the shuffle; documents without hits
ride on a sentinel window, so that one scan and one shuffle of small rows give all results.

Defined cases: null text and text without words have no windows and are clean; an item without id can contaminate
but is not named; repeated rows give repeated rows; empty tables give an empty table or clean documents. Further columns may have any
names: contamination() ignores them, clean_documents() keeps them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leafmill.llm.common import BROADCAST_BYTES, by_content, content_key, materialise

N = 10
#: Estimated bytes of a row of the hash table beside its window.
ROW_BYTES = 64
#: Words after A-Z are lower-cased; a fixed value.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENTINEL = -7_777_777_777_777_777_777


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; a text of ASCII characters takes the fast path."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def windows_of(w: Column, n: int) -> Column:
    """Structs (i, n, h) of the windows of n words; i counts from 1."""
    some = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.struct(i.alias("i"), F.lit(n).alias("n"), F.xxhash64(F.slice(w, i, n)).alias("h")))
    return F.when(F.size(w) >= n, some).otherwise(F.array().cast("array<struct<i:int,n:int,h:bigint>>"))


def benchmark_windows(items: DataFrame, n: int = N) -> DataFrame:
    """item_id, h, n, window (words with spaces between) for each window of the items, repeats included."""
    w = items.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    every = w.select("item_id", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.slice("w", i, size))).alias("x"))
    return every.select("item_id", F.xxhash64("x").alias("h"), F.size("x").alias("n"), F.array_join("x", " ").alias("window"))


def window_id(window: Column) -> Column:
    """128 bits that stand for a window."""
    return F.unhex(F.md5(window))


def hits(docs: DataFrame, found: DataFrame, sizes: list[int]) -> DataFrame:
    """docs (columns kept, with words w) once for each verified hit, and once without one: i__, n__, window__ (nulls without one)."""
    first = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("n"), F.lit(SENTINEL).cast("long").alias("h")))
    windows = docs.withColumn("x__", F.explode(F.concat(first, *[windows_of(F.col("w"), n) for n in sizes])))
    windows = windows.withColumns({"i__": F.col("x__.i"), "n__": F.col("x__.n"), "h__": F.col("x__.h")})
    sentinel = docs.sparkSession.range(1).select(F.lit(SENTINEL).cast("long").alias("h"), F.lit(None).cast("string").alias("window"))
    side = F.broadcast(found.select("h", "window").union(sentinel).select(F.col("h").alias("set__"), F.col("window").alias("window__")))
    text = F.array_join(F.slice("w", F.greatest("i__", F.lit(1)), F.col("n__")), " ")
    # both ways of containment, not equality, which would turn the text into a join key to be made for every window
    same = (F.col("n__") == 0) & F.col("window__").isNull() | text.contains(F.col("window__")) & F.col("window__").contains(text)
    return windows.join(side, (F.col("h__") == F.col("set__")) & same).drop("x__", "h__", "set__")


def all_hits(base: DataFrame, every: DataFrame, broadcast_bytes: int) -> DataFrame:
    """hits() of documents (with words w) and all windows, in as many parts as the bound of the broadcast asks for."""
    distinct = every.select("h", "n", "window").distinct()
    size = F.octet_length("window") + ROW_BYTES
    bounds = distinct.groupBy("n").agg(F.sum(size).alias("bytes")).collect()  # n rows at most
    sizes, parts = [r["n"] for r in bounds], max(1, -(-sum(r["bytes"] for r in bounds) // broadcast_bytes))
    if parts == 1:
        return hits(base, distinct, sizes)
    base = materialise(base, "words")
    return reduce(DataFrame.union, [hits(base, distinct.where(F.pmod("h", F.lit(parts)) == p), sizes) for p in range(parts)])


def contamination(docs: DataFrame, items: DataFrame, n: int = N, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and items (ids) for each row of docs."""
    every = materialise(benchmark_windows(items, n), "windows")
    base = docs.select("doc_id", F.monotonically_increasing_id().alias("row__"), words(F.col("text")).alias("w"))
    hit = F.when(F.col("n__") > 0, F.struct(F.col("i__").alias("i"), F.col("n__").alias("n")))
    rows = materialise(all_hits(base, every, broadcast_bytes).select("doc_id", "row__", F.size("w").cast("long").alias("n_words"), hit.alias("hit"), window_id(F.col("window__")).alias("id")), "hits")
    byrow = rows.groupBy("row__").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_set("hit").alias("hits"))
    ids = every.where(F.col("item_id").isNotNull()).select(window_id(F.col("window")).alias("id"), "item_id").distinct()
    told = rows.where(F.col("id").isNotNull()).select("row__", "id").distinct().join(ids, "id").groupBy("row__").agg(F.collect_set("item_id").alias("items"))
    covered = F.aggregate(F.array_sort("hits"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("next")), lambda a, h: F.struct((a["n"] + F.greatest(F.lit(0).cast("long"), h["i"] + h["n"] - F.greatest(a["next"], h["i"].cast("long")))).alias("n"), F.greatest(a["next"], (h["i"] + h["n"]).cast("long")).alias("next")), lambda a: a["n"])
    none = F.array().cast(told.schema["items"].dataType)
    done = byrow.join(told, "row__", "left").withColumn("items", F.coalesce("items", none))
    named = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return done.select("doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(named, 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"), "items")


def clean_documents(docs: DataFrame, items: DataFrame, n: int = N, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """docs without the documents that hold any window of an item; what goes is decided on keys, and texts are not shuffled for a few of them."""
    every = materialise(benchmark_windows(items, n), "windows")
    base = docs.select(*content_key(), words(F.col("text")).alias("w"))
    found = all_hits(base, every, broadcast_bytes).where(F.col("n__") > 0).select("id_", "hash_", "size_").distinct()
    return by_content(docs, materialise(found, "contaminated"), "left_anti", F.lit(64))[0]
