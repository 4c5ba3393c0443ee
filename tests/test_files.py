"""Sources, sinks, resumable stages and similarity."""

import json
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from leafmill.functions.similarity import best_label, gestalt, label_text, strip_accents
from leafmill.operators.matching import FIELD_LABELS, near_duplicate_identities
from leafmill.sources import files
from leafmill.streaming import incremental


def test_images_and_manifest(spark, tmp_path):
    (tmp_path / "a/b").mkdir(parents=True)
    for n in ("a/x.JPG", "a/b/y.png", "a/z.txt"):
        (tmp_path / n).write_bytes(b"1")
    images = files.image_files(spark, str(tmp_path))
    got = files.manifest(images, str(tmp_path)).orderBy("relative_path").collect()
    assert [r["relative_path"] for r in got] == ["a/b/y.png", "a/x.JPG"]
    assert all(r["sample_id"].startswith("sample_") and len(r["sample_id"]) == 23 for r in got)
    with pytest.raises(ValueError):
        files.manifest(images.limit(0), str(tmp_path))


def test_csv(spark, tmp_path):
    rows = spark.createDataFrame([("1", "x"), ("2", None)], "b string, a string")
    assert files.write_csv(rows, f"{tmp_path}/t") and not files.write_csv(rows.limit(0), f"{tmp_path}/none")
    assert files.read_csv(spark, f"{tmp_path}/t", ["a", "b"]).count() == 2
    assert files.read_csv(spark, f"{tmp_path}/missing", ["a"], required=False).count() == 0
    with pytest.raises(ValueError):
        files.read_manifest(spark, f"{tmp_path}/t")


def test_json_lines_with_torn_tail(spark, tmp_path):
    (tmp_path / "t.jsonl").write_text('{"filename":"a.jpg"}\n\n{"filename":')
    assert [r["filename"] for r in files.read_json_lines(spark, f"{tmp_path}/t.jsonl", "filename string").collect()] == ["a.jpg"]
    (tmp_path / "u.jsonl").write_text('{"filename":\n{"filename":"b.jpg"}\n')
    with pytest.raises(ValueError):
        files.read_json_lines(spark, f"{tmp_path}/u.jsonl", "filename string")
    assert files.read_json_lines(spark, f"{tmp_path}/u.jsonl", "filename string", strict=False).count() == 1


def test_flat(spark):
    rows = spark.createDataFrame([(1, ["a", "b"], [("c1", "high")], ("x",))], "id long, l array<string>, issues array<struct<code:string,severity:string>>, s struct<m:string>")
    assert files.flat(rows).first().asDict() == {"id": 1, "l": "a | b", "issues": "c1", "s_m": "x"}


def test_resume_and_fingerprint(spark, tmp_path):
    folder = f"file://{tmp_path}/stage"
    assert incremental.prepare(spark, folder, "one") and incremental.prepare(spark, folder, "one")
    seen = []

    def stage(rows):
        seen.append(rows.count())
        return rows.withColumn("v", F.lit(1))

    rows = spark.range(4).withColumnRenamed("id", "key")
    incremental.resume(rows.limit(2), folder, "key", stage)
    assert incremental.resume(rows, folder, "key", stage).count() == 4 and seen == [2, 2]
    assert not incremental.prepare(spark, folder, "two")
    assert incremental.resume(rows, folder, "key", stage).count() == 4 and seen[-1] == 4


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(2):
        (tmp_path / f"in/{i}.json").write_text(json.dumps({"k": i}))
        incremental.stream_files(spark, f"{tmp_path}/in", "k long", f"{tmp_path}/out", lambda x: x)
    assert sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/out/done.parquet").collect()) == [0, 1]


def test_similarity(spark):
    pairs = [("Nguyen", "Nguyén"), ("abcd", "bcde"), (None, "x")]
    got = spark.createDataFrame(pairs, "a string, b string").select(gestalt("a", "b").alias("r"), strip_accents("b").alias("p")).collect()
    assert [r["r"] for r in got] == [SequenceMatcher(None, *p).ratio() if p[0] else None for p in pairs] and got[0]["p"] == "Nguyen"
    labels = spark.createDataFrame([("Surname / Nom",), ("Dat of birth",), ("zzzz",), (None,)], "t string").select(best_label(FIELD_LABELS)("t").alias("m")).collect()
    assert [r["m"]["field"] for r in labels] == ["surname", "date_of_birth", None, None] and label_text("Né(e) 01") == "ne e o1"


def test_near_duplicates(spark):
    rows = [("s1", "i1", "A1234567", "NGUYEN", "1990-01-01", "2030-01-01"), ("s2", "i2", "A1234568", "NGUYEN", "1990-01-01", "2031-01-01"), ("s3", "i3", "B9", "OTHER", "1990-01-01", "2032-01-01"), ("s4", "i1", "A1234567", "NGUYEN", "1990-01-01", "2030-01-01")]
    got = near_duplicate_identities(spark.createDataFrame(rows, "sample_id string, suggested_id string, passport_number string, surname string, date_of_birth string, date_of_expiry string")).collect()
    assert [(r["left_sample_id"], r["right_sample_id"], r["hint_score"]) for r in got] == [("s1", "s2", 8.5), ("s2", "s4", 8.5)]
