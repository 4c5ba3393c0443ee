"""Substring dedup by hashing lines, paragraphs, sentences or pieces of lines.

A text is cut into units whose concatenation is the text. Every unit with words is normalised (case folded, all but letters, marks
and digits turned to single spaces) and hashed to 128 bits. Over all documents the earliest ranked occurrence of each
digest stays, by (doc_id, text digest, start); every other one is a repeat. Repeats that follow one another in a text, with nothing but
units without words between, form a passage; passages of `passage_words` words or more are removed, and the offsets of what was removed refer
to the original text. With passage_words = 1 every repeated unit goes, be it a single short line. Counting is combined before the
shuffle and no group is gathered: digests are written once, and copies of a frequent unit are joined with its first occurrence
from two written tables, which Spark deals anew where a key is hot.

Unit "sentence" cuts lines further at sentence ends: passages that were pasted into the middle of a line are not lines
of their own. Unit "piece" cuts sentences further where their content says so: before a word whose hash is smaller than those of
the `REACH` words on either side. The cut depends on these words only, so a passage that was pasted into the middle of a sentence
falls into the same pieces everywhere but for its ends. Equal sentences have equal pieces, so pieces find all that sentences do.

Defined cases: null text is empty; null doc_ids rank first; rows that repeat doc_id and text are one document and are cut alike; units
without words stay; columns other than doc_id and text are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.common import drop_table, extended, map_arrow, materialise
from leafmill.llm.suffix_repeats import text_key

#: Words of the shortest passage that the query removes.
PASSAGE_WORDS = 30
REACH = 4
CUTS = {
    "line": re.compile(r"(?<=\n)"),
    "paragraph": re.compile(r"(?<=\n)(?=\n)(?<!\n\n)|(?<=\n\n)(?!\n)"),
    "sentence": re.compile(r"(?<=\n)|(?<=[.!?…])(?=\s)"),
}
OTHER = re.compile(r"[\W_]+")
WORD = re.compile(r"[^\W_]+")


def units(text: str, unit: str) -> list[tuple[int, int, str]]:
    """(start, end, normalised) of the units with words."""
    out, at = [], 0
    for x in (p for s in CUTS["sentence"].split(text) for p in pieces_of(s)) if unit == "piece" else CUTS[unit].split(text):
        if norm := normal(x):
            out.append((at, at + len(x), norm))
        at += len(x)
    return out


def pieces_of(sentence: str) -> list[str]:
    """A sentence cut before each word whose hash is the smallest of REACH words on either side, all within the sentence; a piece has over REACH words, or is the sentence."""
    found = list(WORD.finditer(sentence))
    n = len(found)
    if n < 2 * REACH + 1:
        return [sentence]
    h = [crc32(m.group().casefold().encode()) for m in found]
    out, at, i = [], 0, REACH
    while i < n - REACH:
        x = h[i]
        if x < min(h[i - REACH : i]) and x < min(h[i + 1 : i + REACH + 1]):
            out.append(sentence[at : found[i].start()])
            at = found[i].start()
            i += REACH
        i += 1
    return [*out, sentence[at:]]


def unit_rows(docs: DataFrame, unit: str) -> DataFrame:
    """doc_id, t, start, end, h1, h2 of the units with words."""
    source = docs.select(*text_key(), F.coalesce("text", F.lit("")).alias("x"))

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("start", "end")}
        take, digests = [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            found = units(text, unit)
            take += [i] * len(found)
            out["start"] += [u[0] for u in found]
            out["end"] += [u[1] for u in found]
            digests += [xxhash.xxh3_128_digest(u[2]) for u in found]
        at = pa.array(take, pa.int32())
        h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        return {"doc_id": batch.column(0).take(at), "t": batch.column(1).take(at), "h1": h[:, 0], "h2": h[:, 1]} | out

    return map_arrow(source, rows, extended(source.select("doc_id", "t").schema, "start int, end int, h1 long, h2 long"))


def normal(x: str) -> str:
    return OTHER.sub(" ", x.casefold()).strip()


def passages(text: str, later: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """(start, end, units) of the runs of units (start, end) with no words between them, that have `least` words or more together."""
    out: list[tuple[int, int, int]] = []
    run: list[tuple[int, int]] = []
    for u in [*later, None]:
        if run and (u is None or normal(text[run[-1][1] : u[0]])):
            if least <= 1 or sum(normal(text[a:b]).count(" ") + 1 for a, b in run) >= least:
                out.append((run[0][0], run[-1][1], len(run)))
            run = []
        run.append(u)
    return out


def repeated_units(docs: DataFrame, unit: str) -> DataFrame:
    """doc_id, t, later: sorted (start, end) of the units that repeat an earlier one, for documents that have any."""
    rows = materialise(unit_rows(docs, unit), "units")
    here = F.struct("doc_id", "t", "start")
    first = materialise(rows.groupBy("h1", "h2").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "first")
    later = rows.join(first, ["h1", "h2"]).where(~here.eqNullSafe(F.col("first")))
    found = materialise(later.groupBy("doc_id", "t").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("later")), "later")
    for table in (rows, first):
        drop_table(table)
    return found


def deduplicated(docs: DataFrame, unit: str = "piece", passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """doc_id, n_chars_in, n_removed_units, n_removed_chars, removed (start:end of the original, comma-joined), kept_sha256, text (what is kept) for each row."""
    source = docs.select(F.col("doc_id").alias("id_"), text_key()[1].alias("t_"), F.coalesce("text", F.lit("")).alias("x"))
    found = repeated_units(docs, unit)
    both = source.join(found, F.col("id_").eqNullSafe(F.col("doc_id")) & (F.col("t_") == F.col("t")), "left").select(F.col("id_").alias("doc_id"), "x", "later")
    schema = extended(both.select("doc_id").schema, "n_chars_in long, n_removed_units long, n_removed_chars long, removed string, kept_sha256 string, text string")

    def rows(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {f.name: [] for f in schema.fields[1:]}
        for text, later in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            cut = passages(text, [(u["start"], u["end"]) for u in later or []], passage_words)
            kept, at = [], 0
            for a, b, _ in cut:
                kept.append(text[at:a])
                at = b
            kept = "".join([*kept, text[at:]])
            told = ",".join(f"{a}:{b}" for a, b, _ in cut)
            for name, v in zip(out, (len(text), sum(n for *_, n in cut), len(text) - len(kept), told, hashlib.sha256(kept.encode()).hexdigest(), kept)):
                out[name].append(v)
        return {"doc_id": batch.column(0)} | out

    return map_arrow(both, rows, schema)
