"""Operators on public specimens and small hand-made rows."""

import duckdb
import pytest

import __spark_entry__
from leafmill.functions.dialect import DUCK
from leafmill.operators import audit, evaluation, identity, mrz
from leafmill.plans.catalogue import ORACLES, QUERIES

LINE_1 = "P<UTOERIKSSON<<ANNA<MARIA<<<<<<<<<<<<<<<<<<<"
LINE_2 = "L898902C36UTO7408122F1204159ZE184226B<<<<<10"


@pytest.fixture(scope="module")
def specimen(spark):
    rows = [("s", "v", 0, LINE_1, LINE_2, 0.9), ("bad", "v", 0, LINE_1, LINE_2[:9] + "7" + LINE_2[10:], 0.9), ("odd", "v", 0, LINE_1, "!" + LINE_2[1:], 0.9), ("short", "v", 0, LINE_1, LINE_2[:40], 0.9), ("none", "v", 0, LINE_1, None, 0.9)]
    return spark.createDataFrame(rows, "sample_id string, variant string, vi long, line_1 string, line_2 string, confidence double")


def by_id(frame):
    return {r["sample_id"]: r for r in frame.collect()}


def test_check_digits(specimen):
    got = by_id(mrz.validated(specimen))
    names = ("passport_number", "birth_date", "expiry_date", "personal_number", "final")
    assert [got["s"][f"{n}_expected_digit"] for n in names] == list("62910") and got["s"]["all_main_checks_valid"]
    assert not got["bad"]["all_main_checks_valid"] and got["bad"]["birth_date_check_valid"]
    assert got["odd"]["validation_status"] == "error" and got["odd"]["final_check_valid"] is None
    assert got["short"]["validation_status"] == got["none"]["validation_status"] == "skipped_invalid_length"


def test_parse(specimen):
    strict, soft = by_id(mrz.parsed(specimen, today="2026-08-01")), by_id(mrz.parsed(specimen, strict=False, today="2026-08-01"))
    r = strict["s"]
    assert (r["surname"], r["given_names"], r["passport_number"], r["nationality"], r["sex"]) == ("ERIKSSON", "ANNA MARIA", "L898902C3", "UTO", "F")
    assert (r["date_of_birth"], r["date_of_expiry"], r["personal_number"]) == ("1974-08-12", "2012-04-15", "ZE184226B")
    assert strict["short"]["parse_status"] == "error" and strict["short"]["surname"] is None
    assert soft["short"]["parse_mode"] == "padded_or_truncated" and strict["none"]["parse_status"] == "not_parsed"


def test_prefix_repair(spark):
    rows = [("a", "v", "X" + LINE_1[:43], LINE_2), ("b", "v", LINE_1, LINE_2)]
    got = by_id(mrz.prefix_repaired(spark.createDataFrame(rows, "sample_id string, variant string, line_1 string, line_2 string")))
    assert got["a"]["line_1"] == LINE_1[:43] + "<" and got["a"]["prefix_repair"] == "line1_prefix_trim_1" and got["b"]["prefix_repair"] is None


def test_row_assembly(spark):
    schema = "sample_id string, pos long, text string, x1 double, y1 double, x2 double, y2 double"
    two = [("t", 0, LINE_1[20:], 200.0, 10.0, 400.0, 30.0), ("t", 1, LINE_1[:20], 0.0, 11.0, 190.0, 31.0), ("t", 2, LINE_2[:22], 0.0, 50.0, 190.0, 70.0), ("t", 3, LINE_2[22:], 200.0, 51.0, 400.0, 71.0)]
    one = [("o", 0, LINE_1, 0.0, 10.0, 190.0, 30.0), ("o", 1, LINE_2, 200.0, 10.0, 400.0, 30.0)]
    got = by_id(mrz.rows_from_items(spark.createDataFrame(two + one, schema)))
    assert got["t"]["assembly_method"] == "geometry_two_rows" and (got["t"]["line_1"], got["t"]["line_2"]) == (LINE_1, LINE_2)
    assert got["o"]["assembly_method"] == "text_order_fallback" and got["o"]["line_2"] == LINE_2


def test_seeded_split_ignores_row_order(spark):
    rows = [(f"s{i}", f"p{i // 2}") for i in range(40)]
    split = lambda r, seed: {x["sample_id"]: x["split"] for x in identity.seeded_split(spark.createDataFrame(r, "sample_id string, identity_id string"), seed=seed).collect()}
    assert split(rows, 42) == split(rows[::-1], 42) != split(rows, 1)
    got = split(rows, 42)
    assert all(got[f"s{i}"] == got[f"s{i + 1}"] for i in range(0, 40, 2))


def test_last_wins(spark):
    rows = [("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), (None, 4, "w")]
    got = audit.last_wins(spark.createDataFrame(rows, "key string, pos long, v string"), key="key", position="pos").collect()
    assert sorted((r["key"], r["v"], r["first_position"]) for r in got) == [("a", "z", 1), ("b", "y", 2)]


def test_majority_vote(spark):
    rows = [("s1", "i", "t", "f", "A", "B"), ("s2", "i", "t", "f", "A", "A"), ("s3", "i", "t", "f", "A", None), ("s4", "i", "t", "f", "A", "A")]
    got = evaluation.identity_votes(spark.createDataFrame(rows, "sample_id string, identity_id string, split string, field string, expected string, predicted string")).collect()
    assert [(r["expected"], r["predicted"], r["correct"]) for r in got] == [("A", "A", True)]


@pytest.mark.parametrize("name", ["mrz_validity_by_issuer", "td3_parse_soft", "viz_records", "seeded_split", "last_wins_dedupe", "coercions"])
def test_query_matches_sql(spark, name):
    folder, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("customer", "nation", "events", "documents", "labels", "pages", "conversations"):
        con.sql(f"create view {t} as select * from '{folder}/{t}.parquet'")
    frame = QUERIES[name](spark, folder)
    columns = ", ".join(sorted(frame.columns))
    assert sorted(map(repr, map(tuple, frame.select(*sorted(frame.columns)).collect()))) == sorted(map(repr, con.sql(f"select {columns} from ({ORACLES[name]}) as q").fetchall()))


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert DUCK.name == "duckdb"
