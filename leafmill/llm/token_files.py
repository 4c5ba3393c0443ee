"""Token ids in Arrow stream files of fixed-size lists.

Documents are put in ascending order (doc_id, then a hash of the text, then the text), encoded with the tokenizers library,
and each is closed by an end id. A task writes two files in the Arrow stream format for its range of documents:

* ids: rows of two fixed-size lists, `ids` (uint16 where the vocabulary allows, else uint32) and `mask` (bits), `length` entries each. The range's ids follow one
  another through the rows; the last row is filled up with zeros whose mask is 0. All record batches but the last
  have `batch_rows` rows, so a reader that maps the file finds sequence k by arithmetic, and without a copy.
* index: doc_id, begin (in the file's ids), n_tokens.

A file gets a temporary name and is then renamed, and its content depends on its range only, so a task that runs again puts the
same bytes in the same place. Global starts come from one token count per file.

Defined cases: null text is empty and gets the end id alone; null doc_ids come first; repeated rows stay; an empty table
gives an empty table.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from leafmill.llm.common import fresh_path, map_arrow

END_ID = 2
LENGTH = 1024
BATCH_ROWS = 256
REMEMBERED = 400_000

#: Marks that are a pre-token of their own after letters.
CLOSING = frozenset(".,;:!?")

#: The pre-tokeniser of the byte-level vocabularies; a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else the next free code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Remembered(dict):
    """Values by key, made when first asked for."""

    def __init__(self, make) -> None:
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


class UnitEncoder:
    """Texts to bytes of little-endian unsigned 32-bit ids.

    Between a character and a single space, both without white space around, a pre-token always ends. So a text without a space
    beside other white space falls apart at its spaces, and what follows a space is encoded once and remembered. Special tokens
    and other texts take the library's whole path.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize, self.letters = self.tokenizer.model.tokenize, byte_letters()
        self.split = regex.compile(PATTERN).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mixed = not any(map(str.isalpha, self.special))  # then letters alone hold no special token
        self.units, self.pieces = Remembered(self.unit), Remembered(self.piece)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def piece(self, x: str) -> bytes:
        """Ids of one pre-token."""
        letters = x.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(letters)]).tobytes()

    def unit(self, x: str) -> bytes | None:
        """Ids of a space and x; None if the space may belong to what is before it, or x may hold a special token."""
        if self.mixed:
            if x.isalpha():
                return self.pieces[" " + x]
            if x[-1:] in CLOSING and x[:-1].isalpha():
                return self.pieces[" " + x[:-1]] + self.pieces[x[-1]]
        if not x or x[0].isspace() or x[-1].isspace() or any(s in x for s in self.special):
            return None
        return b"".join(map(self.pieces.__getitem__, self.split(" " + x)))

    def __call__(self, texts: list[str]) -> list[bytes]:
        out, unit = [], self.units.__getitem__
        for text in texts:
            first, *rest = text.split(" ")
            try:
                out.append(self.whole(first) + b"".join(map(unit, rest)) if rest and not first[-1:].isspace() else self.whole(text))
            except TypeError:  # a unit that is None
                out.append(self.whole(text))
            for known in (self.units, self.pieces):
                if len(known) > REMEMBERED:
                    known.clear()
        return out


_encoders: dict[str, UnitEncoder] = {}


def library_encoder(path: str) -> UnitEncoder:
    """One encoder for each worker and vocabulary file."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = UnitEncoder(path)
    return _encoders[path]


class FileWriter:
    """Streams ids into rows of fixed-size lists."""

    def __init__(self, sink, length: int, batch_rows: int, most: int) -> None:
        self.length, self.size = length, length * batch_rows
        self.kind = np.dtype("<u2" if most < 1 << 16 else "<u4")
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(self.kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.held, self.n, self.total = [], 0, 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.n += len(ids) // 4
        self.total += len(ids) // 4
        if self.n >= self.size:
            joined = b"".join(self.held)
            full = self.n // self.size * self.size
            for a in range(0, full, self.size):
                self.write(np.frombuffer(joined, "<u4", self.size, a * 4))
            self.held, self.n = [joined[full * 4 :]], self.n - full

    def write(self, ids: np.ndarray) -> None:
        ids = ids.astype(self.kind)
        rows = -(-len(ids) // self.length)
        pad = rows * self.length - len(ids)
        mask = np.arange(len(ids) + pad) < len(ids)
        ids = np.pad(ids, (0, pad))
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.out.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        if self.n:
            self.write(np.frombuffer(b"".join(self.held), "<u4"))
        self.out.close()


class SequenceFile:
    """Random access to the sequences of one ids file; local files are mapped, and arrays are views of the mapping."""

    def __init__(self, path: str) -> None:
        store, at = fs.FileSystem.from_uri(path)
        source = pa.memory_map(at) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(at)
        self.batches = list(pa.ipc.open_stream(source))
        self.rows_per_batch = self.batches[0].num_rows if self.batches else 1
        self.length = self.batches[0].schema.field("ids").type.list_size if self.batches else 1

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence k, both views."""
        batch, row = divmod(k, self.rows_per_batch)
        ids, mask = (self.batches[batch].column(c).values.slice(row * self.length, self.length) for c in (0, 1))
        return ids.to_numpy(), mask

    def slices(self, begin: int, n: int) -> Iterator[np.ndarray]:
        """The ids from begin on, n of them, as views batch by batch."""
        size = self.rows_per_batch * self.length
        while n > 0:
            batch, at = divmod(begin, size)
            view = self.batches[batch].column(0).values.slice(at, min(n, size - at)).to_numpy()
            yield view
            begin, n = begin + len(view), n - len(view)


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int = END_ID, length: int = LENGTH, batch_rows: int = BATCH_ROWS) -> tuple[str, DataFrame]:
    """Write the files; returns their folder and the manifest (part, n_docs, n_tokens), which runs the writing when it is read."""
    folder = fresh_path(docs.sparkSession, "tokens")
    order = ["doc_id", "__tie", "text"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("__tie", F.xxhash64("text"))
    placed = rows.repartitionByRange("doc_id", "__tie").sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode, end = library_encoder(vocabulary), np.array([end_id], "<u4").tobytes()
        most = encode.tokenizer.get_vocab_size() - 1
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        names = [f"{root}/{kind}-{part:06d}.arrows" for kind in ("ids", "index")]
        spare = [f"{n}.{uuid.uuid4().hex}" for n in names]
        n_docs = 0
        with store.open_output_stream(spare[0]) as a, store.open_output_stream(spare[1]) as b:
            ids, index = FileWriter(a, length, batch_rows, max(end_id, most)), None
            for batch in batches:
                done, counts = encode(batch.column(1).to_pylist()), []
                begin = ids.total
                for x in done:
                    ids.add(x + end)
                    counts.append(len(x) // 4 + 1)
                n = np.array(counts, np.int64)
                rows = pa.record_batch({"doc_id": batch.column(0), "begin": pa.array(begin + np.cumsum(n) - n), "n_tokens": pa.array(n)})
                index = index or pa.ipc.new_stream(b, rows.schema)
                index.write_batch(rows)
                n_docs += len(n)
            ids.close()
            if index:
                index.close()
        if n_docs:
            for old, new in zip(spare, names):
                if store.get_file_info(new).type == fs.FileType.NotFound:
                    store.move(old, new)
                else:  # an earlier attempt of this task has put the same bytes there
                    store.delete_file(old)
            yield pa.record_batch({"part": pa.array([part], pa.int32()), "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([ids.total], pa.int64())})
        else:
            for old in spare:
                store.delete_file(old)

    return folder, placed.mapInArrow(run, "part int, n_docs long, n_tokens long")


def read_tokens(spark, folder: str, files: list[tuple[int, int, int]], doc_type) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files; files: part, its tokens and the tokens before it."""
    manifest = spark.createDataFrame([(p, start) for p, _, start in files], "part int, start long").repartition(max(1, len(files)), "part")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("doc_id", doc_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, start in zip(*[batch.column(c).to_pylist() for c in (0, 1)]):
                data = SequenceFile(f"{folder}/ids-{part:06d}.arrows")
                store, root = fs.FileSystem.from_uri(folder)
                with store.open_input_file(f"{root}/index-{part:06d}.arrows") as f:
                    for rows in pa.ipc.open_stream(f):
                        begin, n = rows.column(1).to_numpy(), rows.column(2).to_numpy()
                        crc = []
                        for a, k in zip(begin.tolist(), n.tolist()):
                            c = 0
                            for view in data.slices(a, k):
                                c = zlib.crc32(view.astype("<u4"), c)
                            crc.append(c)
                        yield pa.record_batch([rows.column(0), pa.array(begin + start), rows.column(2), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.mapInArrow(run, schema)


def token_round_trip(docs: DataFrame, vocabulary: str, **how) -> DataFrame:
    """Write docs as token files and return what the files hold for each document."""
    folder, manifest = write_tokens(docs, vocabulary, **how)
    files, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r["part"]):  # a row per file
        files.append((r["part"], r["n_tokens"], start))
        start += r["n_tokens"]
    return read_tokens(docs.sparkSession, folder, files, docs.schema["doc_id"].dataType)
