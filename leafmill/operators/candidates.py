"""Candidates for page fields and dates of issue: label and value pairs by geometry, dates by role, ranking and consensus."""

from __future__ import annotations

from leafmill.functions import scalars as S
from leafmill.functions.dialect import operator


@operator
def field_candidates(d, items):
    """The best value item for each label item of a page: position near the label, confidence and order; labels are known by kind."""
    pairs = f"select a.sample_id, a.field, b.text as value, b.pos, b.confidence as c, abs(a.pos - b.pos) as off, {S.field_score(d, 'a', 'b')} as place from {items} as a join {items} as b on a.sample_id = b.sample_id where a.kind = 'label' and b.kind = 'value'"
    score = d.rounded(f"place + {d.num(2.3)} + greatest(c, cast(0 as double)) - case when c < {d.num(0.35)} then {d.num(0.8)} else 0 end + greatest(cast(0 as double), {d.num(1.5)} - {d.num(0.2)} * off)", 8)
    scored = f"select sample_id, field, value, pos, {score} as score from ({pairs}) as q where place > -1000"
    return f"select sample_id, field, value, score from (select *, row_number() over (partition by sample_id, field order by score desc, pos) as r from ({scored}) as q) as q where r = 1"


@operator
def consensus(d, candidates):
    """One value per sample and field from the variants' candidates: the best score, and 1.4 for each further variant that agrees."""
    groups = f"select sample_id, field, value, max(score) + {d.num(1.4)} * (count(*) - 1) as final_score, cast(count(*) as bigint) as agreement, min(vi) as first from {candidates} group by sample_id, field, value"
    return f"select sample_id, field, value, {d.rounded('final_score', 4)} as final_score, agreement from (select *, row_number() over (partition by sample_id, field order by final_score desc, first) as r from ({groups}) as q) as q where r = 1"


@operator
def field_records(d, chosen):
    """One record per sample with the number of its fields and its status."""
    n = "count(value)"
    return f"select sample_id, cast({n} as bigint) as extracted_field_count, case when {n} >= 5 then 'strong' when {n} >= 2 then 'partial' when {n} = 1 then 'weak' else 'no_fields' end as viz_extraction_status from {chosen} group by sample_id"


@operator
def date_windows(d, items):
    """One to three neighbouring items of a page joined: start, size, text, least confidence."""
    text = lambda k: f"lead(text, {k}) over (partition by sample_id order by pos)"
    conf = lambda k: f"lead(confidence, {k}) over (partition by sample_id order by pos)"
    inner = f"select sample_id, pos, text as t0, confidence as c0, {text(1)} as t1, {conf(1)} as c1, {text(2)} as t2, {conf(2)} as c2 from {items}"
    return f"""select sample_id, pos, cast(1 as bigint) as n, t0 as text, c0 as confidence from ({inner}) as q union all select sample_id, pos, cast(2 as bigint) as n, t0 || ' ' || t1 as text, least(c0, c1) as confidence from ({inner}) as q where t1 is not null
        union all select sample_id, pos, cast(3 as bigint) as n, t0 || ' ' || t1 || ' ' || t2 as text, least(c0, c1, c2) as confidence from ({inner}) as q where t2 is not null"""


@operator
def issue_candidates(d, items, context, *, today="2026-01-01"):
    """Dates of issue: beside an issue label, by a validity of whole years, or as the only admissible date left.

    context gives birth and expiry by sample. Labels are known by kind and field.
    """
    dated = f"select i.*, {S.slash_date(d, 'text')} as day from {items} as i where kind = 'value'"
    able = f"select a.*, c.expiry, {S.validity_bonus(d, 'a.day', 'c.expiry')} as bonus from ({dated}) as a join {context} as c on a.sample_id = c.sample_id where a.day is not null and {S.admissible(d, 'a.day', 'c.birth', 'c.expiry', today)}"
    off = f"case when abs(a.pos - b.pos) <= 3 then greatest(cast(0 as double), cast(18 - 5 * abs(a.pos - b.pos) as double)) end"
    # every date once with each issue label of its page, and once without any: one pass gives all three methods
    labels = f"select * from {items} where kind = 'label' and field = 'date_of_issue'"
    beside = f"select b.sample_id, b.day, b.pos, b.bonus, b.confidence, coalesce({S.issue_score(d, 'a', 'b')}, {off}) as near from ({able}) as b left join ({labels}) as a on a.sample_id = b.sample_id"
    dates = f"select sample_id, day, pos, bonus, max(45 + near + bonus + 5 * confidence) as labelled from ({beside}) as q group by sample_id, day, pos, bonus"
    counted = f"select *, min(day) over (partition by sample_id) = max(day) over (partition by sample_id) as alone, pos = min(pos) over (partition by sample_id) as first from ({dates}) as q"
    methods = {"issue_label": ("labelled", "labelled is not null"), "temporal_validity_rescue": ("42 + bonus", "bonus >= 28"), "date_role_elimination": ("86", "alone and first")}
    found = d.keep(d.array(*[f"case when {when} then {d.struct(method=repr(m), score=d.rounded(f'cast({score} as double)', 4))} end" for m, (score, when) in methods.items()]))
    return f"select sample_id, day, pos, m.method as method, m.score as score from (select sample_id, day, pos, {found} as found from ({counted}) as q) as q{d.unnest('found', 'm')}"


@operator
def issue_decision(d, candidates, manifest):
    """The best date per sample with the margin to the next date and a status."""
    best = f"select sample_id, day, method, score from (select *, row_number() over (partition by sample_id, day order by score desc, pos, method) as r from {candidates}) as q where r = 1"
    ranked = f"select *, row_number() over (partition by sample_id order by score desc, day) as r, lead(score) over (partition by sample_id order by score desc, day) as second from ({best}) as q"
    status = "case when r.sample_id is null then 'no_date_found' when r.score >= 88 and coalesce(r.score - r.second >= 4, true) then 'high_confidence' when r.score >= 65 then 'medium_confidence' else 'low_confidence' end"
    return f"select m.sample_id, {d.iso('r.day')} as date_of_issue, r.method, r.score, {d.rounded('r.score - r.second', 4)} as score_margin, {status} as status from {manifest} as m left join (select * from ({ranked}) as q where r = 1) as r on m.sample_id = r.sample_id"
