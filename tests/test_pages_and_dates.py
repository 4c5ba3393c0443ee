"""Mined dates, issue dates, page fields, corners and recogniser results, with values worked out by hand."""

import json

import pytest

from leafmill.functions import mining
from leafmill.operators import fields, issue, pages, recognition

TODAY = "2026-01-01"
ITEMS = "sample_id string, variant string, vi long, pos long, text string, x1 double, y1 double, x2 double, y2 double, confidence double"


def isos(text, birth=None, expiry=None):
    return [x[0] for x in mining.dates_in(text, birth, expiry, TODAY)]


def test_dates_of_all_forms():
    assert isos("12/03/2015") == ["2015-03-12"] and isos("31.02.2015") == []
    assert isos("12 03 2015") == ["2015-03-12"] and isos("120315") == isos("12032015") == ["2015-03-12"]
    assert isos("2812/DEC 11") == ["2011-12-28"] and isos("2811/DEC 11") == ["2011-12-28"]
    assert isos("12 0CT 15") == ["2015-10-12"] and isos("5 ME/JUN 2014") == ["2014-06-05"] and isos("5décembr 2014") == ["2014-12-05"]
    assert isos("1/1/2028") == [] and isos("1/1/2027") == ["2027-01-01"] and isos("1/1/1899") == []
    raw = mining.dates_in("on 12/03/2015 or 12 mar 2015", None, None, TODAY)
    assert raw == [("2015-03-12", "12 mar 2015", 17, 28)]  # the later match's offsets


def test_two_digit_years():
    assert isos("12/03/15", "1990-01-01", "2030-01-01") == ["2015-03-12"]
    assert isos("12/03/85", "1990-01-01", "2030-01-01") == ["1985-03-12"]  # neither fits, the nearer one
    assert isos("12/03/20", "1900-01-01", "1999-01-01") == ["1920-03-12"]
    assert isos("12/03/25") == ["2025-03-12"]


def test_months_and_signals():
    assert [mining.month_of(x) for x in ("oet", "noy", "nar", "septembre", "sepl", "xx", "me/jun", "")] == [10, 11, 3, 9, 9, None, 6, None]
    assert mining.issue_signal("DATE OF ISHUE") and mining.issue_signal("DateofIssue") and not mining.issue_signal("Surname")
    assert mining.holds(mining.date_text("Date of birth / Date of issue"), mining.OTHER)
    assert mining.issue_similarity("iss") == 0 and mining.issue_similarity("Date d'émission") == 1


def test_field_dates():
    assert mining.field_date("born 1.2.85") == "1985-02-01" and mining.field_date("1.2.40") == "2040-02-01" and mining.field_date("31/02/2015 1/1/2015") is None
    assert mining.field_date("12 marz 1987") == "1987-03-12" and mining.field_date("12 MAR 2015") is None  # zeros are read as o there


def page(spark, texts):
    rows = [(s, v, i, p, t, *(box or (None,) * 4), c) for s, v, i, p, t, box, c in texts]
    return spark.createDataFrame(rows, ITEMS)


def test_date_of_issue(spark):
    label, value = (20.0, 110.0, 150.0, 130.0), (170.0, 111.0, 270.0, 131.0)
    items = page(spark, [
        ("a", "enhanced", 0, 0, "Date of issue", label, 0.5), ("a", "enhanced", 0, 1, "12/03/2015", value, 0.9),
        ("b", "enhanced", 0, 0, "something", None, 0.5), ("b", "enhanced", 0, 1, "12/03/2015", value, 0.9),
        ("c", "enhanced", 0, 0, "07/08/2017", value, 0.9), ("d", "enhanced", 0, 0, "nothing", None, None),
        ("e", "enhanced", 0, 0, "01/01/1999 Date of issue", label, 0.5),
    ])
    context = spark.createDataFrame([("a", "1980-01-01", "2025-03-12", "birth_viz+expiry_viz"), ("b", None, "2025-03-12", "expiry_viz"), ("c", "1980-01-01", "2025-06-12", "validated_mrz"), ("d", None, None, "none"), ("e", None, None, "none"), ("f", None, None, "none")], "sample_id string, birth string, expiry string, context_source string")
    found = issue.candidates(items, context, TODAY)
    got = {r["sample_id"]: r for r in issue.decided(found, items, context, context).collect()}
    # label 45, place 34 - 3, validity 28 + 10, confidence 4.5; the next date is a day after ten years before expiry: 72 + 10 + 5 + 5
    assert (got["a"]["date_of_issue"], got["a"]["score"], got["a"]["score_margin"], got["a"]["status"], got["a"]["method"]) == ("2015-03-12", 118.5, 26.5, "high_confidence", "issue_label_spatial")
    assert got["a"]["all_dates"] == "2015-03-12 | 2015-03-13 | 2020-03-12 | 2020-03-13"
    # no label: rescue 42 + 38, back-off 72 + 10 + 5 + 7 = 94 for the same day
    assert (got["b"]["date_of_issue"], got["b"]["score"], got["b"]["method"]) == ("2015-03-12", 94.0, "expiry_backoff_10y_v6")
    assert (got["c"]["date_of_issue"], got["c"]["score"], got["c"]["method"], got["c"]["status"]) == ("2017-08-07", 86.0, "date_role_elimination", "medium_confidence")
    assert got["d"]["status"] == got["e"]["status"] == "no_date_found" and got["f"]["status"] == "no_ocr_items"


def test_agreement_of_variants(spark):
    schema = "sample_id string, iso string, raw string, score double, method string, variant string, seq struct<stage:int,vi:int,pos:int,n:int,place:int>"
    rows = [("a", "2015-01-01", "x", 50.0, "m", "enhanced", (0, 0, 1, 1, 0)), ("a", "2015-01-01", "y", 50.0, "m", "color", (0, 1, 1, 1, 0)), ("a", "2016-01-01", "z", 56.0, "m", "color", (0, 1, 2, 1, 0))]
    got = issue.ranked(spark.createDataFrame(rows, schema)).orderBy("place").collect()
    assert [(r["iso"], r["score"], r["agreement"], r["raw"]) for r in got] == [("2015-01-01", 57.0, 2, "x"), ("2016-01-01", 56.0, 1, "z")]


def test_temporal_context(spark):
    records = spark.createDataFrame([("a", "x/p1.jpg"), ("b", "p2.jpg"), ("c", "p3.jpg"), ("d", "p4.jpg")], "sample_id string, filename string")
    parsed = spark.createDataFrame([("p1", "1980-01-01", "2030-01-01", "strict_44_44", 1), ("p2.png", "1980-01-01", "2030-01-01", "strict_44_44", 1), ("p3", "2031-01-01", None, "x", 1)], "filename string, birth_date string, expiry_date string, parse_mode string, pos int")
    valid = spark.createDataFrame([("p1.jpg", "True", 1), ("p2", "no", 1)], "filename string, all_main_checks_valid string, pos int")
    viz = spark.createDataFrame([("p1", "1981-01-01", "bad", 1), ("p2", None, "2029-01-01", 1), ("p3.png", None, "2029-01-01", 1)], "filename string, date_of_birth string, date_of_expiry string, pos int")
    got = {r[0]: tuple(r)[1:] for r in issue.temporal_context(records, parsed, valid, viz).collect()}
    assert got == {"a": ("1980-01-01", "2030-01-01", "validated_mrz"), "b": ("1980-01-01", "2029-01-01", "birth_mrz+expiry_viz"), "c": (None, "2029-01-01", "birth_mrz+expiry_viz+birth_discarded_invalid"), "d": (None, None, "none")}


def test_page_fields(spark):
    box = (20.0, 10.0, 120.0, 30.0)
    items = page(spark, [
        ("a", "enhanced", 0, 0, "Surname / Nom", box, 0.9), ("a", "enhanced", 0, 1, " Nowak ;", (22.0, 34.0, 120.0, 54.0), 0.3), ("a", "enhanced", 0, 2, "Passport No. X1234567", (220.0, 10.0, 400.0, 30.0), 0.5),
        ("a", "enhanced", 0, 3, "12/03/2015", (22.0, 60.0, 120.0, 80.0), 0.9), ("a", "enhanced", 0, 4, "Sex F", None, None),
    ])
    got = {r["field"]: (r["value"], r["method"], r["score"]) for r in fields.field_candidates(items).collect()}
    # below: 4 + 3 - 0.45 * 4 / 20 - 0.9 * 1 / 100; label 2.3, confidence 0.3 - 0.8, neighbours 1.3
    assert got["surname"] == ("NOWAK", "spatial", pytest.approx(4 + 3 - 0.09 - 0.009 + 2.3 - 0.5 + 1.3))
    assert got["passport_number"] == ("X1234567", "inline", 9.5) and got["sex"] == ("F", "inline", 9.0)


def test_page_variants(spark):
    rows = [("a", "enhanced", "success", 9, 0.9), ("b", "enhanced", "success", 4, 0.9), ("b", "color", "success", 5, 0.875), ("c", "enhanced", "success", 4, 0.5), ("c", "color", "error", 0, None), ("c", "grayscale", "success", 3, 0.95)]
    got = {r[0]: (r[1], r[2], r[3]) for r in fields.page_variants(spark.createDataFrame(rows, "sample_id string, variant string, status string, text_count long, mean_confidence double")).collect()}
    assert got == {"a": ("enhanced", 27.0, 1), "b": ("color", 22.5, 2), "c": ("grayscale", 22.0, 3)}


def test_inside_ratio():
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    assert pages.clipped_area(square, (5.0, 5.0, 15.0, 15.0)) == 25 and pages.clipped_area(square, (20.0, 20.0, 30.0, 30.0)) == 0
    assert pages.clipped_area([(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)], (0.0, 0.0, 10.0, 10.0)) == 50


def test_recogniser_results(spark):
    result = {"a": [1, {"rec_texts": ["x", "y"], "rec_scores": [0.5], "rec_polys": [[[1, 2], [5, 1], [6, 9]]]}]}
    assert recognition.items_in(json.dumps(result)) == [{"text": "x", "confidence": 0.5, "x1": 1, "y1": 1, "x2": 6, "y2": 9}, {"text": "y", "confidence": None, "x1": None, "y1": None, "x2": None, "y2": None}]
    assert recognition.items_in("{") == recognition.items_in(None) == recognition.items_in("[]") == []
    assert recognition.box_of([1, 2, 3, 4, 5]) == [1, 2, 3, 4] and recognition.box_of([1, 2]) is None

    def load():
        def model(content):
            if content == b"bad":
                raise ValueError("unreadable")
            return {"rec_texts": [content.decode()], "rec_scores": [0.5]}

        return model

    frame = spark.createDataFrame([("a", b"hi"), ("b", b"bad"), ("c", None)], "sample_id string, content binary")
    got = {r["sample_id"]: (r["status"], r["text_count"], r["mean_confidence"], r["error"]) for r in recognition.recognised(frame, load).collect()}
    assert got == {"a": ("success", 1, 0.5, None), "b": ("error", 0, None, "ValueError: unreadable"), "c": ("image_missing", 0, None, "no image")}
    boxes = {r["sample_id"]: (r["status"], r["class"], r["confidence"]) for r in recognition.detected(frame, lambda: lambda c: [("mrz", 0.3, [0, 0, 1, 1]), ("mrz", 0.6, [0, 0, 1, 1]), ("mrz", 0.1, [0, 0, 1, 1])] if c == b"hi" else []).collect()}
    assert boxes == {"a": ("success", "mrz", 0.6), "b": ("nothing_found", None, None), "c": ("image_read_failed", None, None)}
