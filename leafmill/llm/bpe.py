"""Byte-level BPE encoding and decoding with overlapping chunks.

A text is cut into chunks of `chunk` characters that overlap on both sides, and chunks are split into pre-tokens independently. The
pattern looks ahead but never back, so two chunks agree on all pre-tokens after a common boundary in their overlap. Stitching starts
at the text's beginning, where chunk 0 is right, and crosses to the next chunk at such a boundary; the pre-tokens between two crossings
are the text's, and are then encoded, each distinct one once. Boundaries in a chunk's last characters, which its cut may have made,
are not used. A text whose chunks nowhere agree (one pre-token longer than the overlap) is encoded whole. Decoding concatenates the
bytes of the ids.

Texts of up to `spread` characters are cut and stitched in the task that reads them. Chunks of longer ones are dealt over tasks, which also
encode their pre-tokens, and meet again for stitching.

Defined cases: null text is empty and has no ids; repeated rows give repeated rows; columns other than doc_id and text are ignored, whatever
their names; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.common import extended, map_arrow

CHUNK = 4_096
OVERLAP = 256
#: Longest text, in characters, that one task cuts and stitches alone.
SPREAD = 65_536
REMEMBERED = 400_000
#: White space in the pattern; a fixed value.
WHITE = r"\t-\r\x20\x85\xa0  -     　"
#: Longest look of the pattern beyond a pre-token.
LOOK = 4

_encodings: dict = {}


class Encoding:
    """The vocabulary of a rank file."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import regex
        import tiktoken

        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.whole = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        own = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]")
        self.pieces = regex.compile(own).findall
        self.bytes = {v: k for k, v in self.ranks.items()}
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode_ordinary(text), "<u4")

    def piece(self, x: str) -> bytes:
        """Ids of one pre-token, as little-endian unsigned 32-bit integers."""
        got = self.known.get(x)
        if got is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            raw = x.encode()
            rank = self.ranks.get(raw)
            got = self.known[x] = array("I", [rank] if rank is not None else self.whole._core_bpe.encode_single_piece(raw)).tobytes()
        return got

    def chunk(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends of the pre-tokens in characters, their numbers of ids, and the ids."""
        pieces = self.pieces(text)
        ids = [self.piece(p) for p in pieces]
        sizes = lambda x: np.fromiter(map(len, x), np.int64, len(x))
        return np.cumsum(sizes(pieces)), (sizes(ids) // 4).astype(np.int32), np.frombuffer(b"".join(ids), "<u4")

    def stitched(self, text: str, chunk: int, overlap: int) -> np.ndarray:
        """Ids of a text by chunks that are split independently, stitched, and then encoded piece by piece."""
        parts = []
        for at in range(0, max(1, len(text)), chunk):
            begin = max(0, at - overlap)
            own = self.pieces(text[begin : at + chunk + overlap])
            ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)))
            parts.append({"begin": begin, "size": min(len(text), at + chunk + overlap) - begin, "ends": ends, "pieces": own})
        runs = crossings(parts)
        if runs is None:
            return self.encode(text)
        return np.frombuffer(b"".join([self.piece(p) for c, (a, b) in zip(parts, runs) for p in c["pieces"][a:b]]), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


def encoding(ranks_path: str, pattern: str) -> Encoding:
    """One for each worker and rank file."""
    key = (ranks_path, pattern)
    if key not in _encodings:
        _encodings[key] = Encoding(*key)
    return _encodings[key]


def crossings(chunks: list[dict]) -> list[tuple[int, int]] | None:
    """For each chunk of a text in order (begin, size, ends) the range of its pre-tokens that are the text's; None if two neighbours nowhere agree."""
    out, at = [], 0
    for k, c in enumerate(chunks):
        ends = c["begin"] + c["ends"]
        first = int(np.searchsorted(ends, at, side="right")) if at > c["begin"] else 0
        if k + 1 == len(chunks):
            out.append((first, len(ends)))
            break
        after = chunks[k + 1]
        mine = ends[np.searchsorted(ends, max(at, after["begin"])) :]
        both = np.intersect1d(mine[mine <= c["begin"] + c["size"] - LOOK], np.concatenate([[after["begin"]], after["begin"] + after["ends"][: 2 * len(mine) + 16]]))
        if not len(both):
            return None
        cross = int(both[len(both) // 2])
        out.append((first, int(np.searchsorted(ends, cross, side="right"))))
        at = cross
    return out


def stitch(chunks: list[dict]) -> np.ndarray | None:
    """Ids of a text from its encoded chunks (with counts and ids), or None."""
    runs = crossings(chunks)
    if runs is None:
        return None
    upto = [np.concatenate([[0], np.cumsum(c["counts"])]) for c in chunks]
    return np.concatenate([c["ids"][n[a] : n[b]] for c, n, (a, b) in zip(chunks, upto, runs)])


def digests(ids: np.ndarray, decoded: bytes) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest()


def encoded(docs: DataFrame, ranks_path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP, spread: int = SPREAD, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row of docs; with ids, also the ids as an array."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    schema = extended(docs.select("doc_id").schema, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids)

    def row(doc_ids, found: list[np.ndarray]) -> dict:
        e = encoding(ranks_path, pattern)
        told = [digests(x, e.decode(x)) for x in found]
        out = {"doc_id": doc_ids} | {c: [t[i] for t in told] for i, c in enumerate(("n_tokens", "ids_sha256", "decoded_sha256"))}
        return out | ({"ids": [x.tolist() for x in found]} if ids else {})

    def short(batch: pa.RecordBatch) -> dict:
        e = encoding(ranks_path, pattern)
        return row(batch.column(0), [e.stitched(x, chunk, overlap) for x in batch.column(1).to_pylist()])

    def cut(batch: pa.RecordBatch) -> dict:
        e = encoding(ranks_path, pattern)
        done = [e.chunk(x) for x in batch.column(4).to_pylist()]
        kept = {c: batch.column(i) for i, c in enumerate(("row", "doc_id", "k", "begin", "text"))}
        return kept | {c: [d[i].astype(t).tobytes() for d in done] for i, (c, t) in enumerate((("ends", "<i8"), ("counts", "<i4"), ("ids", "<u4")))}

    def joined(batch: pa.RecordBatch) -> dict:
        e = encoding(ranks_path, pattern)
        found = []
        for chunks in batch.column(1).to_pylist():
            chunks.sort(key=lambda c: c["k"])
            parts = [{"begin": c["begin"], "size": len(c["text"]), "ends": np.frombuffer(c["ends"], "<i8"), "counts": np.frombuffer(c["counts"], "<i4"), "ids": np.frombuffer(c["ids"], "<u4")} for c in chunks]
            got = stitch(parts)
            if got is None:
                text, at = [], 0
                for c in chunks:
                    text.append(c["text"][at - c["begin"] :])
                    at = c["begin"] + len(c["text"])
                got = e.encode("".join(text))
            found.append(got)
        return row(batch.column(0), found)

    size = F.length("text")
    long = rows.where(size > spread).withColumn("row", F.monotonically_increasing_id())
    long = long.select("row", "doc_id", "text", F.explode(F.sequence(F.lit(0), F.ceil(size / spread).cast("int") - 1)).alias("k"))
    begin = F.greatest(F.lit(0), F.col("k") * spread - overlap)
    long = long.select("row", "doc_id", "k", begin.alias("begin"), F.substring("text", begin + 1, (F.col("k") + 1) * spread + overlap - begin).alias("text"))
    chunked = map_arrow(long.repartition("row", "k"), cut, extended(long.schema, "ends binary, counts binary, ids binary"))
    whole = chunked.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.collect_list(F.struct("k", "begin", "text", "ends", "counts", "ids")).alias("chunks")).select("doc_id", "chunks")
    return map_arrow(rows.where(size <= spread), short, schema).union(map_arrow(whole, joined, schema))
