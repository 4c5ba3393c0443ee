"""Written intermediates in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a fresh folder where that is unset and all runs on one machine (tests, bench)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table that later steps read: computed once, its lineage cut, and safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    spark, schema = df.sparkSession, df.schema
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()  # the driver lets go of the step's plan and code before the next one, and Spark of its shuffle files
    return spark.read.schema(schema).parquet(path)
