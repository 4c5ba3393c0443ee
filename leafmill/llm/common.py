"""Shared helpers: table access, written intermediates and Arrow mapping."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Largest estimated size of what is broadcast; larger sides are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a fresh one where that is unset and all runs on one machine (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage is cut, and the data outlives any executor."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    del df
    time.sleep(0.3)  # until the listeners have let go of the plan
    spark.sparkContext._jvm.System.gc()  # Spark deletes the shuffle files of what is unreachable now
    return spark.read.schema(schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_table(df: DataFrame) -> None:
    """Delete the files of a table that materialise() wrote and nothing will read again."""
    files = df.inputFiles()
    if files:
        drop_path(df.sparkSession, files[0].rpartition("/")[0])


def spare(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores after it as make it none of the taken ones, in either case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def content_key() -> list[Column]:
    """What makes two rows the same document: id_, hash_ and size_."""
    text = F.coalesce("text", F.lit(""))
    return [F.col("doc_id").alias("id_"), F.xxhash64(text).alias("hash_"), F.octet_length(text).alias("size_")]


def broadcast_if_small(side: DataFrame, row_bytes: Column) -> DataFrame:
    """side, marked for broadcast if its estimated size is within the bound; read once to find out."""
    return F.broadcast(side) if (side.agg(F.sum(row_bytes)).first()[0] or 0) <= BROADCAST_BYTES else side


def by_content(docs: DataFrame, side: DataFrame, how: str, row_bytes: Column) -> tuple[DataFrame, list[Column]]:
    """docs joined with a written side (id_, hash_, size_ and more) by content, and the side's further columns, under names that docs doesn't have."""
    names = dict(zip(side.columns, spare(docs.columns, *side.columns)))
    side = broadcast_if_small(side, row_bytes).select(*[F.col(c).alias(n) for c, n in names.items()])
    text = F.coalesce("text", F.lit(""))
    on = F.col("doc_id").eqNullSafe(F.col(names["id_"])) & (F.xxhash64(text) == F.col(names["hash_"])) & (F.octet_length(text) == F.col(names["size_"]))
    return docs.join(side, on, how), [F.col(n) for c, n in names.items() if c not in ("id_", "hash_", "size_")]


def map_arrow(df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: T.StructType | str) -> DataFrame:
    """mapInArrow with a function from one batch to columns (a dict of lists or arrays)."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                out = rows(piece)
                yield pa.record_batch([as_array(out[f.name], f.type) for f in target], schema=target)

    return df.mapInArrow(run, schema)


def extended(schema: T.StructType, more: str) -> T.StructType:
    """A copy of schema with further columns."""
    return T.StructType([*schema.fields, *T._parse_datatype_string(more).fields])


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def pieces(batch: pa.RecordBatch, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about limit bytes, so that what is made of them stays small; a single row is never cut."""
    n, size = batch.num_rows, batch.nbytes
    if size <= limit or n <= 1:
        if n:
            yield batch
        return
    step = max(1, n * limit // size)
    for at in range(0, n, step):
        yield batch.slice(at, step)
