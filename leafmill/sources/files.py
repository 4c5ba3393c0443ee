"""Readers and writers: image folders, manifests, CSV, JSON, JSON lines; flat forms of nested records."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Image suffixes; fixed values.
SUFFIXES = [".jpg", ".jpeg", ".png", ".bmp", ".webp", ".tif", ".tiff"]
MANIFEST = ["sample_id", "source_filename", "relative_path"]


def sample_id(path: Column) -> Column:
    return F.concat(F.lit("sample_"), F.left(F.sha1(F.trim(F.replace(path, F.lit("\\"), F.lit("/")))), F.lit(16)))


def image_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, modificationTime of the images below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "length", "modificationTime").where(F.lower(F.regexp_extract("path", r"\.[^./]+$", 0)).isin(SUFFIXES)).orderBy("path")


def manifest(images: DataFrame, folder: str) -> DataFrame:
    """One keyed row per image; an empty folder and a clash of keys are errors."""
    rel = F.regexp_replace("path", f"^(file:)?/*{folder.removeprefix('file:').strip('/')}/", "")
    rows = images.select(sample_id(rel).alias("sample_id"), F.regexp_extract("path", "[^/]+$", 0).alias("source_filename"), rel.alias("relative_path"), F.lower(F.regexp_extract("path", r"\.[^./]+$", 0)).alias("source_extension"))
    if rows.isEmpty():
        raise ValueError(f"no images in {folder}")
    if not rows.groupBy("sample_id").count().where("count > 1").isEmpty():
        raise ValueError("two images have one sample_id")
    return rows


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_csv(spark: SparkSession, path: str, columns: list[str], required: bool = True) -> DataFrame:
    """Columns of a CSV by their names in its header, as texts; a column that it lacks is null, and a missing optional file an empty table.

    A mark of byte order before the first name is left out. Files of one folder whose headers differ are an error.
    """
    if not required and not _exists(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    found = spark.read.option("header", True).option("enforceSchema", False).csv(path)
    names = {c.lstrip("\ufeff"): c for c in found.columns}
    return found.select(*[F.col(f"`{names[c]}`").alias(c) if c in names else F.lit(None).cast("string").alias(c) for c in columns])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.option("header", True).csv(path)
    names = {c.lstrip("﻿"): c for c in found.columns}
    if missing := [c for c in MANIFEST if c not in names]:
        raise ValueError(f"the manifest lacks {missing}")
    return found.select(*[F.col(f"`{v}`").alias(k) for k, v in names.items()])


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str, otherwise: str = "empty") -> DataFrame:
    """The objects of a JSON list. A document that is no list is empty, an 'error', or taken for JSON 'lines'."""
    if otherwise != "empty" and not spark.read.text(path, wholetext=True).where(~F.ltrim("value").startswith("[")).isEmpty():
        if otherwise == "error":
            raise ValueError(f"{path} is not a list")
        return read_json_lines(spark, path, schema, strict=False)
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    whole = spark.read.text(path, wholetext=True).where(F.ltrim("value").startswith("["))
    return whole.select(F.explode(F.from_json("value", T.ArrayType(kind))).alias("r")).where("r is not null").select("r.*")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """JSON lines. Strict: a malformed last line of a file (a torn append) is left out and an earlier one is an error; else all malformed lines are left out. Values that are no objects are left out."""
    at = F.struct("_metadata.file_block_start", F.monotonically_increasing_id().alias("i"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), at.alias("at")).where(F.trim("value") != "")
    parsed = lines.select("file", "at", "value", F.from_json("value", schema).alias("r"), F.try_parse_json("value").isNull().alias("bad"))
    if strict:
        ends = parsed.groupBy("file").agg(F.max("at").alias("last"), F.min(F.when(F.col("bad"), F.col("at"))).alias("torn")).where("torn < last")
        if not ends.isEmpty():
            raise ValueError(f"a line of {path} is malformed")
    return parsed.where(~F.col("bad") & F.ltrim("value").startswith("{")).select("r.*")


def write_csv(rows: DataFrame, path: str, columns: list[str] | None = None, required: bool = False) -> bool:
    """CSV with the given columns, or all in their order; no rows are an error where some are required, else nothing is written. Says whether it wrote."""
    if rows.isEmpty():
        if required:
            raise ValueError(f"no rows for {path}")
        return False
    rows.select(*(columns or rows.columns)).write.mode("overwrite").option("header", True).csv(path)
    return True


def write_json(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").json(path)


def write_json_document(rows: DataFrame, path: str, order: list[str]) -> int:
    """One file that holds a JSON list of the rows in an order. Rows pass through the driver one partition at a time; the file appears whole or not at all."""
    spark = rows.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target, spare = hadoop.Path(path), hadoop.Path(f"{path}.{uuid.uuid4().hex}")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out, n = files.create(spare), 0
    try:
        for r in rows.orderBy(*order).select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
            text = json.dumps(json.loads(r["j"]), ensure_ascii=False, indent=2)
            out.write(bytearray((",\n" if n else "[\n").encode() + text.encode()))
            n += 1
        out.write(bytearray(b"\n]\n" if n else b"[]\n"))
    finally:
        out.close()
    files.delete(target, False)
    files.rename(spare, target)
    return n


def append_line(path: str, record: dict, durable: bool = True) -> None:
    """One more JSON line in a file that the driver sees; durable: it is on the disk when this returns."""
    with open(path, "a", encoding="utf-8") as f:
        f.write(json.dumps(record, ensure_ascii=False, separators=(",", ":")) + "\n")
        f.flush()
        if durable:
            os.fsync(f.fileno())


def write_bundle(bundle: DataFrame, failures: DataFrame, folder: str) -> int:
    """An index of the samples to review, in order, and a folder with the failures of each."""
    n = bundle.count()
    bundle.orderBy("position").coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/index")
    columns = [c for c in failures.columns if c != "sample_id"]
    each = failures.join(bundle.select("sample_id", "position", "errors"), "sample_id").groupBy("sample_id", "position", "errors").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("failures"))
    each.write.mode("overwrite").partitionBy("sample_id").json(f"{folder}/reviews")
    return n


def flat(rows: DataFrame) -> DataFrame:
    """The flat form of nested records: arrays joined by bars, issue structs by their codes, structs and maps as JSON or by member."""
    out = []
    for f in rows.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            inner = f.dataType.elementType
            c = F.transform(c, lambda x: x["code"]) if isinstance(inner, T.StructType) and "code" in inner.names else c
            out.append(F.array_join(c.cast("array<string>"), " | ").alias(f.name))
        elif isinstance(f.dataType, T.StructType):
            out += [c[m].alias(f"{f.name}_{m}") for m in f.dataType.names]
        elif isinstance(f.dataType, T.MapType):
            out.append(F.to_json(c).alias(f.name))
        else:
            out.append(c)
    return rows.select(*out)
