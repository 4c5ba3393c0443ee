"""Risk and ease worked out by hand from the reference's terms."""

from leafmill.operators import identity
from leafmill.operators.fusion import CORE


def test_every_fault_counts(spark):
    checks = ["passport_number_check_valid", "birth_date_check_valid", "expiry_date_check_valid", "final_check_valid"]
    schema = ["sample_id string", "quality_status string", "coverage string", "review_required boolean", "conflict_count int", "missing_count int", "high_count int", "medium_count int", "has_high boolean", "all_main_checks_valid boolean", "parse_mode string", "date_of_issue_quality string", "quality_score double", *[f"{c} boolean" for c in checks], *[f"{f} string" for f in CORE]]
    rows = [("a", "medium_confidence", "complete", False, 0, 0, 2, 1, True, False, "strict_44_44", "high_confidence", 80.0, False, False, True, None, *["X"] * 8), ("b", "high_confidence", "complete", False, 0, 0, 0, 0, False, True, "strict_44_44", "high_confidence", 95.0, True, True, True, True, *["X"] * 8)]
    got = {r["sample_id"]: r for r in identity.risks(spark.createDataFrame(rows, ", ".join(schema))).collect()}
    assert (got["a"]["risk"], got["a"]["ease"], got["a"]["difficulty"]) == (8.6, 9.71, "hard")
    assert (got["b"]["risk"], got["b"]["ease"], got["b"]["difficulty"]) == (0.0, 13.0, "easy")
