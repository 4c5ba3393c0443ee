"""Failure categories by the values of both sources, on rows made by hand."""

from leafmill.operators import evaluation
from leafmill.operators.fusion import FIELDS


def test_other_source_is_held_against_the_truth(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    wrong = [("a", "surname", "X", "Y", "viz_high"), ("b", "surname", "X", "Y", "viz_high"), ("c", "surname", "X", "Y", "mrz_strong"), ("d", "date_of_issue", "2020-01-01", None, None), ("e", "date_of_issue", "2020-01-01", None, None), ("f", "surname", "X", None, None), ("g", "surname", "X", None, None), ("h", "surname", "X", "Y", "mrz_strong")]
    compared = frame([(s, "i", "t", "review", f, e, p, src, "high", False) for s, f, e, p, src in wrong], "sample_id string, identity_id string, split string, quality_status string, field string, expected string, predicted string, source string, quality string, correct boolean")
    cols = ", ".join(f"{f} string" for f in FIELDS)
    one = lambda s, name: (s, *[name if f == "surname" else None for f in FIELDS])
    mrz = frame([(*one(s, n), "success", "strict_44_44", None, None, None) for s, n in (("a", "X"), ("b", "Z"), ("c", "Y"), ("f", "Q"), ("h", "Y"))], f"sample_id string, {cols}, parse_status string, parse_mode string, passport_number_check_valid boolean, birth_date_check_valid boolean, expiry_date_check_valid boolean")
    viz = frame([one(s, n) for s, n in (("a", "Y"), ("b", "Y"), ("c", "X"), ("h", "Z"))], f"sample_id string, {cols}")
    issue = frame([("d", "2020-01-01"), ("e", "2020-01-02")], "sample_id string, date_of_issue string")
    pages = frame([("h", "empty_crop")], "sample_id string, status string")
    got = {r["sample_id"]: r["failure_category"] for r in evaluation.failures(compared, mrz, viz, issue, pages).collect()}
    assert got == {"a": "fusion", "b": "viz_field_extraction", "c": "fusion", "d": "fusion_or_finalization", "e": "doi_extraction", "f": "mrz_ocr_or_parse", "g": "upstream_missing", "h": "passport_stage"}
