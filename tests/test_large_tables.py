"""What keeps large tables within their limits: work that is spread, done once, or left out because it cannot matter."""

import pandas as pd
import pyarrow as pa

from leafmill.functions import mining, similarity
from leafmill.functions.dialect import DUCK
from leafmill.operators import audit, evaluation
from leafmill.operators.fusion import CORE
from leafmill.operators.matching import FIELD_LABELS
from leafmill.plans import pages, records, relational, synth

TEXTS = ["Surname", "Surnane", "Glven nannes", "HOUSEHOLDBFC", "Passport No. A12345678", "date of issue", "DATE OF ISHUE", "Date d'émission / Date of issue", "x", "", None, "nom", "of", "Sexe M", "12/03/2015", "Ausstellungsdatum"]


def test_windows_of_a_page_hold_the_dates_of_their_texts(spark):
    page = ["Date of issue", "12 MAR", "2015 ", None, "", "é 01/02/03", "U12345678", "15031990", "Σ", "5 0CT/XXX 19"]
    got = mining.mined("2026-01-01").func(pa.array([page, [], None]), pa.array(["1980-01-01", None, None]), pa.array([None, "2030-01-01", None])).to_pylist()
    want = []
    for i in range(len(page)):
        for n in range(1, min(3, len(page) - i) + 1):
            text = " ".join(x or "" for x in page[i : i + n]).strip()
            want += [(i, n, *d, place) for place, d in enumerate(mining.dates_in(text, "1980-01-01", None, "2026-01-01"))]
    assert [tuple(x.values()) for x in got[0]] == want and len(want) > 10 and got[1:] == [[], []]


def test_labels_that_no_ratio_can_reach_are_not_compared(spark, monkeypatch):
    calls = []
    own = similarity.label_similarity
    monkeypatch.setattr(mining, "label_similarity", lambda *a: calls.append(a) or own(*a))
    texts = [*TEXTS, *[f"HOUSEHOLD{x}" for x in "ABCDEFGHIJ"], *[f"U{i:08d}" for i in range(20)]]
    got = list(mining.label_table(FIELD_LABELS, 0.58).func(pd.Series(texts, dtype=object)))
    for text, found in zip(texts, got):
        each = {f: max(own(similarity.label_text(text or ""), similarity.label_text(x)) for x in xs) for f, xs in FIELD_LABELS.items()}
        assert found == {f: s for f, s in each.items() if s >= 0.58}
    assert 0 < len(calls) < len(texts) * sum(map(len, FIELD_LABELS.values())) / 2


def test_signals_by_bounds():
    for f in (mining.label_signals, mining.issue_signals):
        got = f.func(pd.Series(TEXTS, dtype=object))
        assert list(got["issue"]) == [mining.issue_signal(x or "") for x in TEXTS]
        if f is mining.label_signals:
            assert list(got["similarity"]) == [mining.issue_similarity(x or "") for x in TEXTS]


def test_zones_are_worked_out_once_for_the_context(monkeypatch):
    calls = []

    class Read(Exception):
        pass

    def once(df, name):
        calls.append(name)
        if name == "context":
            raise Read
        return Frame()

    class Frame:
        def drop(self, *_):
            return self

        select = drop

    monkeypatch.setattr(pages, "query", lambda plan: plan(relational.SPARK) and (lambda *_: Frame()))
    monkeypatch.setattr(pages, "written", once)
    monkeypatch.setattr(pages.issue, "temporal_context", lambda *_: Frame())
    try:
        pages.context(None, "")
    except Read:
        pass
    assert calls == ["zones", "context"]


def test_one_small_file_is_spread_over_tasks(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    got = relational.query(lambda d: [("q", f"select * from {d.table('customer')}")])(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1 and got.count() == 100


def test_wide_steps_are_written_for_one_reader(spark, tmp_path, monkeypatch):
    names = []
    monkeypatch.setattr(relational, "written", lambda df, name: names.append(name) or df)
    spark.range(3).write.parquet(f"{tmp_path}/customer.parquet")
    steps = lambda d: [("final", f"select id from {d.table('customer')}"), ("small", "select id from final"), ("q", "select id from small")]
    assert relational.query(steps)(spark, str(tmp_path)).count() == 3 and names == ["final"]


def test_check_digits(spark):
    for text in ("L898902C<", "740812", "ZE184226B<<<<<", "L898902C<369080619406236ZE184226B<<<<<1", "a é:?Z"):
        want = sum(max("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ".find(c), 0) * (7, 3, 1)[i % 3] for i, c in enumerate(text)) % 10
        weights = relational.SPARK.weights("x", len(text))
        assert spark.createDataFrame([(text,)], "x string").selectExpr(f"{weights} % 10 as d").first()["d"] == want
        assert "named_struct" not in weights


def test_near_duplicates_are_scored_by_falling_bounds(spark, tmp_path, monkeypatch):
    import itertools
    import random

    from pyspark.sql import functions as F, types as T

    from leafmill.operators import matching

    pick, calls = random.Random(7), tmp_path / "calls"
    worn = lambda x: pick.choice([x, x[1:], x[:-1], "X" + x, x.replace("E", "F"), "", None])
    rows = []
    for i in range(150):
        ppn, name = pick.choice(["A12345678", "A12345687", "B99999999", "C5550123"]), pick.choice(["HOUSEHOLDABCD", "HOUSEHOLDABED", "NÚÑEZ", "DE LA FUENTE"])
        rows.append((f"s{i:03}", f"i{pick.randrange(60)}", worn(ppn), worn(name), pick.choice(["1990-01-01", "1991-01-01", "", None]), pick.choice(["2030-01-01", "2031-01-01", None])))
    want = []
    for a, b in itertools.combinations(rows, 2):
        same = lambda i: a[i] is not None and a[i] == b[i]
        like = lambda i, x: a[i] is not None and b[i] is not None and similarity.ratio(a[i], b[i]) >= x
        score = 3.0 * same(4) + 2.5 * same(5) + 2.5 * like(3, 0.9) + 3.0 * like(2, 0.85)
        if a[1] != b[1] and score >= 6:
            want.append((*a, *b, score))
    want.sort(key=lambda r: (-r[12], r[0], r[6]))

    @F.pandas_udf(T.DoubleType())
    def counted(a: pd.Series, b: pd.Series) -> pd.Series:
        with open(calls, "a") as log:
            log.write("x" * sum(x is not None and y is not None for x, y in zip(a, b)))
        return pd.Series([None if x is None or y is None else similarity.ratio(x, y) for x, y in zip(a, b)], dtype="float64")

    monkeypatch.setattr(matching, "gestalt", counted)
    table = spark.createDataFrame(rows, "sample_id string, suggested_id string, passport_number string, surname string, date_of_birth string, date_of_expiry string")
    for most in (len(want) + 1, 5):
        calls.write_text("")
        got = [tuple(r) for r in matching.near_duplicate_identities(table, most).collect()]
        assert got == want[:most]
        made = len(calls.read_text())
    assert len(want) > 400 and 0 < made < len(want) / 2


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_rows_are_stacked_in_one_pass(spark):
    got = relational.SPARK.stacked("id", ["'a' as name, id + 1 as n", "'b' as name, cast(null as bigint) as n"], "range(2)")
    assert rows_of(spark.sql(got)) == [(0, "a", 1), (0, "b", None), (1, "a", 2), (1, "b", None)]
    for text in (synth.viz_rows(relational.SPARK, "sample"), synth.page_items(relational.SPARK, "sample"), evaluation.compared.text(relational.SPARK, "final", "truth")):
        assert "union" not in text and relational.uses("sample", text) + relational.uses("final", text) == 1


def test_flags_of_one_pass_are_those_of_the_union(spark):
    import duckdb

    base = ["A1234567", "DOE", "ANN", "UTO", "1990-03-04", "F", "2030-01-02", "2020-01-02"]
    edit = lambda **x: [x.get(f, v) for f, v in zip(CORE, base)]
    truth = [("a", "i1", edit()), ("b", "i1", edit(surname="DÖE", sex=" ")), ("b", "i1", edit(surname="DÖE")), ("c", None, edit(surname=None)), ("d", None, edit(given_names="bob  x")), ("e", "i2", edit(date_of_birth="2031-01-01", date_of_issue="2027-01-01")), ("f", "i3", edit(date_of_expiry="2020-01-03")),
             ("g", "i4", edit(date_of_expiry="1980-01-01")), ("h", "i5", edit(date_of_issue="04/03/1990")), (None, "i6", edit(passport_number="")), ("unknown", "i7", edit(date_of_issue="1990-03-04"))]
    final = [("a", edit(date_of_birth="1990-04-03")), ("a", edit(surname="doe")), ("b", edit(nationality="XXX")), ("c", edit()), ("d", edit(given_names="BOB X", date_of_expiry=None)), ("e", edit()), ("f", edit(date_of_issue="2020-02-01")), ("g", edit()), (None, edit()), ("h", edit())]
    columns = ", ".join(f"{f} string" for f in CORE)
    tables = {"truth": spark.createDataFrame([(s, i, *x) for s, i, x in truth], f"sample_id string, identity_id string, {columns}"), "final": spark.createDataFrame([(s, *x) for s, x in final], f"sample_id string, {columns}")}
    got = audit.truth_flags(tables["truth"], tables["final"])
    con = duckdb.connect()
    for name, table in tables.items():
        con.register(name, table.toArrow())
    want = con.execute(audit.truth_flags.text(DUCK, "truth", "final")).fetchall()
    assert rows_of(got) == sorted(want, key=repr) and len({r[2] for r in want}) == 11
    text = audit.truth_flags.text(relational.SPARK, "truth", "final")
    assert relational.uses("truth", text) == relational.uses("final", text) == 1


def test_audit_and_review_do_without_assessments():
    for name in ("review_bundle", "gt_audit_flags", "gt_audit_summary"):
        assert all("review_reasons" not in text for _, text in relational.needed(records.PLANS[name](relational.SPARK), set())), name
    assert "quality_score" in dict(records.PLANS["review_bundle"](DUCK))["assessed"]


def test_calibration_writes_no_reasons():
    text = dict(records.quality_calibration(relational.SPARK))["assessed"]
    head = text[: text.index(" from (")]
    assert "quality_status" in head and "review_reasons" not in head and "issues" not in head
