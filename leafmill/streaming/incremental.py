"""Resumable stages: fingerprints, validity of what an earlier run left, and runs over what is not done yet."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from importlib import metadata

from pyspark.sql import DataFrame, SparkSession


def versions(packages: Iterable[str]) -> dict[str, str | None]:
    """Installed versions; null for what is not installed."""
    found = {}
    for name in packages:
        try:
            found[name] = metadata.version(name)
        except metadata.PackageNotFoundError:
            found[name] = None
    return found


def fingerprint(stage: str, inputs: DataFrame, code: dict[str, str], extra: dict | None = None, packages: Iterable[str] = ()) -> str:
    """Digest of a stage's code digests, options, versions of packages, and input files (path, length, modificationTime); files are summed where they are."""
    files = inputs.selectExpr("count(*) as n", "sum(cast(xxhash64(path, length, modificationTime) as decimal(38, 0))) as total").first()
    payload = {"stage": stage, "code": dict(sorted(code.items())), "files": [files["n"], str(files["total"])], "extra": extra or {}, "packages": versions(packages)}
    return hashlib.sha256(json.dumps(payload, sort_keys=True).encode()).hexdigest()


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


#: What a stage leaves in its folder.
OWN = ("done.parquet", "_checkpoint")


def prepare(spark: SparkSession, folder: str, digest: str, own: Iterable[str] = OWN) -> bool:
    """Whether what lies in a stage's folder can be resumed. What another fingerprint left there under the stage's own names is deleted, and nothing else. A first run counts as resumable."""
    meta, files = _path(spark, f"{folder}/_fingerprint")
    old = spark.read.text(meta.toString()).first()[0] if files.exists(meta) else None
    if old == digest:
        return True
    had = False
    for path in [meta, *(_path(spark, f"{folder}/{name}")[0] for name in own)]:
        had |= files.exists(path)
        files.delete(path, True)
    spark.createDataFrame([(digest,)], "value string").coalesce(1).write.text(meta.toString())
    return not had


def resume(rows: DataFrame, folder: str, key: str, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run a stage over the rows whose key is not in its folder's table yet, append, and return the whole table."""
    spark, table = rows.sparkSession, f"{folder}/done.parquet"
    p, files = _path(spark, table)
    todo = rows.join(spark.read.parquet(table).select(key).distinct(), key, "left_anti") if files.exists(p) else rows
    stage(todo).write.mode("append").parquet(table)
    return spark.read.parquet(table)


def stream_files(spark: SparkSession, source: str, schema: str, folder: str, stage: Callable[[DataFrame], DataFrame]) -> None:
    """The same over a stream of JSON files: what has arrived and is not done yet is run once; the checkpoint knows the files seen."""
    rows = spark.readStream.schema(schema).json(source)
    query = stage(rows).writeStream.format("parquet").option("path", f"{folder}/done.parquet").option("checkpointLocation", f"{folder}/_checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
