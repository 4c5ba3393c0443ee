"""Reasons for review and failure categories over the smallest tables."""

import duckdb

from leafmill.plans.catalogue import ORACLES


def rows(name):
    con = duckdb.connect()
    for t in ("customer", "nation"):
        con.sql(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    frame = con.sql(ORACLES[name])
    return [dict(zip(frame.columns, r)) for r in frame.fetchall()]


def test_reasons_and_review_agree():
    got = rows("assessed_records")
    assert all(bool(r["review_reasons"]) == r["review_required"] for r in got)
    assert any(r["review_required"] and r["quality_status"] in ("high_confidence", "medium_confidence") for r in got)
    assert any("passport_stage:no_passport_evidence" in r["review_reasons"] for r in got)
    for r in got:
        told = [x.removeprefix("consistency:") for x in (r["review_reasons"] or "").split(" | ") if x.startswith("consistency:")]
        assert told == [x.rpartition(":")[0] for x in (r["issues"] or "").split(" | ") if x.endswith((":high", ":medium"))]
