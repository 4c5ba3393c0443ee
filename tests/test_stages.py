"""Stages that start and end anywhere, readers by header, documents and bundles as files."""

import json

import pytest

from leafmill import __main__ as cli
from leafmill.plans import runner
from leafmill.sources import files
from leafmill.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    folder = f"{tmp_path}/run"
    with pytest.raises(FileNotFoundError):
        runner.run_stages(spark, SF, folder, 3)
    with pytest.raises(ValueError):
        runner.run_stages(spark, SF, folder, 2, 3, fresh=True)
    lines = runner.run_stages(spark, SF, folder, 1, 2)
    n = lines.count()
    assert runner.run_stages(spark, SF, folder, 3, 3).count() == n > 0
    assert len(list(tmp_path.joinpath("run").iterdir())) == 3 and len(runner.listed()) == len(runner.STAGES)
    assert runner.run_stages(spark, SF, folder, 1, 1, fresh=True).count() > 0 and len(list(tmp_path.joinpath("run").iterdir())) == 1


def test_command_line(capsys, spark, tmp_path):
    assert cli.main(["list"]) == 0 and "page_gate" in capsys.readouterr().out
    assert cli.main(["stages", "--list-stages"]) == 0 and "assessed_records" in capsys.readouterr().out


def test_csv_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffb,a\n1,2\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_csv(spark, f"{tmp_path}/a.csv", ["a", "b", "c"]).collect()] == [("2", "1", None)]
    assert files.read_csv(spark, f"{tmp_path}/none.csv", ["a"], required=False).count() == 0
    with pytest.raises(ValueError):
        files.write_csv(spark.createDataFrame([], "a int"), f"{tmp_path}/x", required=True)


def test_json_documents(spark, tmp_path):
    (tmp_path / "list.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "lines.json").write_text('{"a": 3}\n\n7\n{"a"')
    for name, how, want in (("list", "error", [1, 2]), ("lines", "empty", []), ("lines", "lines", [3])):
        assert sorted(r["a"] for r in files.read_json_array(spark, f"{tmp_path}/{name}.json", "a int", how).collect()) == want
    with pytest.raises(ValueError):
        files.read_json_array(spark, f"{tmp_path}/lines.json", "a int", "error")
    rows = spark.createDataFrame([(2, "é"), (1, None)], "a int, b string").repartition(2)
    assert files.write_json_document(rows, f"{tmp_path}/doc.json", ["a"]) == 2
    assert json.loads((tmp_path / "doc.json").read_text(encoding="utf-8")) == [{"a": 1, "b": None}, {"a": 2, "b": "é"}]
    files.append_line(f"{tmp_path}/log.jsonl", {"a": "é"})
    files.append_line(f"{tmp_path}/log.jsonl", {"a": 1}, durable=False)
    assert (tmp_path / "log.jsonl").read_text(encoding="utf-8") == '{"a":"é"}\n{"a":1}\n'


def test_torn_lines_by_file(spark, tmp_path):
    folder = tmp_path / "torn"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"a": 1}\n{"a')
    (folder / "b.jsonl").write_text('{"a": 2}\n{"a": 3}\n')
    assert sorted(r["a"] for r in files.read_json_lines(spark, str(folder), "a int").collect()) == [1, 2, 3]
    (folder / "a.jsonl").write_text('{"a\n{"a": 1}\n')
    with pytest.raises(ValueError):
        files.read_json_lines(spark, str(folder), "a int")


def test_bundle_files(spark, tmp_path):
    bundle = spark.createDataFrame([("s1", 2, 1), ("s2", 1, 2)], "sample_id string, errors long, position long")
    failures = spark.createDataFrame([("s1", "sex", "x"), ("s1", "surname", "y"), ("s2", "sex", "z"), ("s3", "sex", "w")], "sample_id string, field string, failure_category string")
    assert files.write_bundle(bundle, failures, f"{tmp_path}/bundle") == 2
    got = {r["sample_id"]: [f["field"] for f in r["failures"]] for r in spark.read.json(f"{tmp_path}/bundle/reviews").collect()}
    assert got == {"s1": ["sex", "surname"], "s2": ["sex"]}


def test_only_own_files_go(spark, tmp_path):
    folder = tmp_path / "stage"
    folder.mkdir()
    (folder / "notes.txt").write_text("kept")
    assert incremental.prepare(spark, str(folder), "one")
    spark.range(3).write.parquet(f"{folder}/done.parquet")
    assert not incremental.prepare(spark, str(folder), "two")
    assert (folder / "notes.txt").exists() and not (folder / "done.parquet").exists()
    assert incremental.versions(["pyspark", "nothing-of-that-name"])["nothing-of-that-name"] is None
