"""Synthetic identity documents derived from customer and nation: the tables that operators are checked on.

The same text gives the same rows in either engine. One customer is one identity with up to three scans; each scan has three
recognition variants, some of them damaged.
"""

from __future__ import annotations

#: What operators take for today.
TODAY = "2026-01-01"


def check(d, x: str, n: int) -> str:
    return d.text(f"({d.weights(x, n)} % 10)")


def identities(d) -> str:
    k, n = "c_custkey", "c_nationkey"
    letters = lambda x: f"translate({d.text(x)}, '0123456789', 'ABCDEFGHIJ')"
    tens = f"cast(({k} - {k} % 10) / 10 as bigint)"
    expiry = d.plus_days("date '2026-06-01'", f"({k} * 53 % 3000)")
    base = f"""select {k} as k, {n} as n, 'U' || chr(65 + {n}) || 'O' as issuer,
        chr(65 + {n}) || lpad({d.text(f'(({k} * 7919 + 13) % 100000000)')}, 8, '0') as ppn,
        replace(c_mktsegment, ' ', '') || {letters(tens)} as surname, 'C' || {letters(k)} as given,
        {d.plus_days("date '1950-01-01'", f"({k} * 37 % 18000)")} as birth, {expiry} as expiry, {d.plus_years(expiry, -10)} as issue,
        case {k} % 3 when 0 then 'M' when 1 then 'F' else '<' end as sex, lpad({d.text(k)}, 8, '0') || '<<<<<<' as personal
        from {d.table('customer')} join {d.table('nation')} on c_nationkey = n_nationkey"""
    lines = f"""select *, {d.ymd('birth')} as b6, {d.ymd('expiry')} as e6, rpad('P<' || issuer || surname || '<<' || given, 44, '<') as l1 from ({base}) as q"""
    ends = f"""select *, ppn || {check(d, 'ppn', 9)} || issuer || b6 || {check(d, 'b6', 6)} || sex || e6 || {check(d, 'e6', 6)} || personal || {check(d, 'personal', 14)} as body from ({lines}) as q"""
    return f"""select k, n, issuer, ppn, surname, given, birth, expiry, issue, sex, personal, l1,
        body || {check(d, "(substr(body, 1, 10) || substr(body, 14, 7) || substr(body, 22, 22))", 39)} as l2 from ({ends}) as q"""


def samples(d, ident: str) -> str:
    return f"""select *, 'sample_' || left({d.sha1('relative_path')}, 16) as sample_id, 'id_' || {d.text('k')} as identity_id from
        (select *, 'set' || {d.text('k % 7')} || '/c' || {d.text('k')} || '_' || {d.text('v')} || '.jpg' as relative_path
        from (select * from {ident}{d.each('0', 'k % 3', 'v')}) as q) as q"""


def variants(d, sample: str) -> str:
    """Recognised lines: sample_id, k, v, vi, variant, line_1, line_2, confidence."""
    damaged = "(k * 31 + v * 17 + vi * 7) % 20"
    return f"""select sample_id, k, v, cast(vi as bigint) as vi, issuer, case vi when 0 then 'original' when 1 then 'grayscale' else 'threshold' end as variant,
        case when {damaged} = 2 then 'X' || left(l1, 43) else l1 end as line_1,
        case {damaged} when 0 then replace(substr(l2, 1, 9), '0', 'O') || substr(l2, 10)
            when 1 then substr(l2, 1, 10) || translate(substr(l2, 11, 3), 'O', 'Q') || substr(l2, 14)
            when 3 then left(l2, 40)
            when 6 then substr(l2, 1, 10) || translate(substr(l2, 11, 3), 'O', 'Q') || substr(l2, 14, 6) || translate(substr(l2, 20, 1), '0123456789', '1234567890') || substr(l2, 21)
            when 4 then substr(l2, 1, 9) || translate(substr(l2, 10, 1), '0123456789', '1234567890') || substr(l2, 11)
            when 5 then null else l2 end as line_2,
        {d.num(0.5)} + cast((k + v + vi) % 50 as double) / 100 as confidence, case when (k + vi) % 3 = 0 then 'text_order_fallback' else 'geometry_two_rows' end as assembly_method
        from (select * from {sample}{d.each('0', '2', 'vi')}) as q"""


def viz_rows(d, sample: str) -> str:
    """Fields read from the page: sample_id, field, value, score, agreement; some missing, some wrong."""
    def one(field: str, value: str, i: int) -> str:
        return f"""'{field}' as field, case when (k * 13 + v * 5 + {i}) % 11 = 0 then null when (k * 7 + v + {i}) % 13 = 0 then 'X' || {value} else {value} end as value,
            {d.num(4)} + cast((k * 3 + v + {i}) % 60 as double) / 10 as score, cast((k + v + {i}) % 3 + 1 as bigint) as agreement"""

    fields = {"passport_number": "ppn", "surname": "surname", "given_names": "given", "nationality": "issuer", "date_of_birth": d.iso("birth"), "sex": "replace(sex, '<', 'X')", "date_of_expiry": d.iso("expiry")}
    return d.stacked("sample_id", [one(f, v, i) for i, (f, v) in enumerate(fields.items())], sample)


def page_items(d, sample: str) -> str:
    """Text items of a page with boxes: labels above and beside values; sample_id, pos, text, x1, y1, x2, y2, confidence."""
    rows = [("surname", "label", "'Surname'", 20, 10, 120), ("surname", "value", "surname", 22, 34, 150), ("given_names", "label", "'Given names'", 220, 10, 330), ("given_names", "value", "given", 222, 36, 340), ("date_of_birth", "label", "'Date of birth'", 20, 70, 150), ("date_of_birth", "value", d.dmy("birth"), 170, 71, 270), ("date_of_issue", "label", "'Date of issue'", 20, 110, 150), ("date_of_issue", "value", d.dmy("issue"), 170, 111, 270), ("date_of_expiry", "label", "'Date of expiry'", 20, 150, 150), ("date_of_expiry", "value", d.dmy("expiry"), 170, 151, 270)]

    def one(i: int, row: tuple) -> str:
        field, kind, text, x1, y1, x2 = row
        shift = f"cast((k * {i + 3} + v * 5) % 9 as double)"
        return f"cast({i} as bigint) as pos, '{field}' as field, '{kind}' as kind, {text} as text, {d.num(x1)} + {shift} as x1, {d.num(y1)} + {shift} as y1, {d.num(x2)} + {shift} as x2, {d.num(y1 + 20)} + {shift} as y2, {d.num(0.5)} + cast((k + v + {i}) % 50 as double) / 100 as confidence"

    return d.stacked("sample_id", [one(i, r) for i, r in enumerate(rows)], sample)


def month_name(x: str) -> str:
    return f"substr('JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC', month({x}) * 3 - 2, 3)"


def scan_items(d, sample: str) -> str:
    """Items of three recognised variants of a page, labels misread here and there, dates in many forms: sample_id, variant, vi, pos, text, x1, y1, x2, y2, confidence."""
    two = lambda x: f"lpad({d.text(x)}, 2, '0')"
    day, month, year = "day(issue)", "month(issue)", d.text("year(issue)")
    name = f"case when k % 2 = 0 then replace({month_name('issue')}, 'OCT', '0CT') else {month_name('issue')} end"
    forms = [d.dmy("issue"), f"{two(day)} || ' ' || {name} || ' ' || {year}", f"{two(day)} || ' ' || {two(month)} || ' ' || {year}", f"{two(day)} || {two(month)} || {year}",
             f"{two(day)} || {d.text(month)} || '/' || {month_name('issue')} || ' ' || substr({year}, 3, 2)", f"{d.text(day)} || ' ' || {name} || '/XXX ' || substr({year}, 3, 2)", "'--'"]
    pick = lambda n, xs: f"case (k * 5 + v) % {n} {' '.join(f'when {i} then {x}' for i, x in enumerate(xs))} end"
    issue_label = pick(6, ["'Date of issue'", "'DATE OF ISHUE'", "'Date d''émission / Date of issue'", "'Issue date'", "'Iss. date'", "'illegible'"])
    worn = lambda text, bad: f"case when (k + vi) % 4 = 1 then '{bad}' else '{text}' end"
    rows = [
        (worn("Surname", "Surnane"), 20, 10, 120), ("surname", 22, 34, 150), (worn("Given names", "Glven nannes"), 220, 10, 330), ("given", 222, 36, 340),
        (worn("Date of birth", "Date of birlh"), 20, 70, 150), (f"case when vi = 2 then {two('day(birth)')} || ' ' || {month_name('birth')} || ' ' || {d.text('year(birth)')} else {d.dmy('birth')} end", 170, 71, 270),
        (issue_label, 20, 110, 150), (pick(7, forms), 170, 111, 270), ("'Date of expiry'", 20, 150, 150), (d.dmy("expiry"), 170, 151, 270),
        ("case when k % 3 = 0 then 'Passport No. ' || ppn else 'Passport No.' end", 20, 190, 150), ("case when k % 3 = 0 then '' else ppn end", 170, 191, 290),
        ("case when sex = '<' then 'Sex' else 'Sex / Sexe ' || sex end", 20, 230, 150), ("'Nationality'", 220, 230, 330), ("issuer", 222, 255, 300),
    ]

    def one(i: int, row: tuple) -> str:
        text, x1, y1, x2 = row
        shift = f"cast((k * {i + 3} + v * 5 + vi) % 9 as double)"
        x = f"case when (k + {i}) % 29 = 0 then null else {d.num(x1)} + {shift} end"
        return f"select sample_id, case vi when 0 then 'enhanced' when 1 then 'color' else 'grayscale' end as variant, cast(vi as bigint) as vi, cast({i} as bigint) as pos, {text} as text, {x} as x1, {d.num(y1)} + {shift} as y1, {d.num(x2)} + {shift} as x2, {d.num(y1 + 20)} + {shift} as y2, case when (k + {i} + vi) % 31 = 0 then null else {d.num(0.3)} + cast((k + v + {i} + vi) % 70 as double) / 100 end as confidence from {sample}"

    return " union all ".join(one(i, r) for i, r in enumerate(rows))
