"""Fusion of sources into one record per sample, consistency rules and quality."""

from __future__ import annotations

from leafmill.functions import scalars as S
from leafmill.functions.dialect import operator

#: Field names shared by both sources, with the check that covers them; fixed values.
FIELDS = {"passport_number": "passport_number", "surname": None, "given_names": None, "nationality": None, "date_of_birth": "birth_date", "sex": None, "date_of_expiry": "expiry_date"}
CORE = [*FIELDS, "date_of_issue"]
WEIGHTS = {"verified": 1.0, "strong": 0.92, "high": 0.88, "medium": 0.72, "weak": 0.48, "invalid": 0.20, "missing": 0.0, "high_confidence": 0.90, "medium_confidence": 0.72, "low_confidence": 0.45, "no_date_found": 0.0, "no_ocr_items": 0.0}
UNKNOWN_WEIGHT = 0.45
#: Page statuses that lose a sample before its fields are read.
PAGE_LOST = "('no_passport_evidence', 'image_read_failed', 'unexpected_error', 'empty_crop')"
PENALTY = {"high": 30, "medium": 12, "low": 5}


def mrz_quality(field: str) -> str:
    check = FIELDS[field]
    tested = f"when m.{check}_check_valid then 'verified' when not m.{check}_check_valid then 'invalid' when m.parse_mode = 'strict_44_44' then 'medium'" if check else "when m.parse_mode = 'strict_44_44' then 'strong'"
    return f"case when coalesce(m.{field}, '') = '' then 'missing' when coalesce(m.parse_status, '') <> 'success' then 'weak' {tested} else 'weak' end"


def viz_quality(field: str) -> str:
    return f"case when coalesce(v.{field}, '') = '' then 'missing' when v.{field}_agreement >= 2 or v.{field}_score >= 8 then 'high' when v.{field}_score >= 6 then 'medium' else 'weak' end"


def strength(field: str) -> str:
    """Source strength as conflict analysis sees it: the parse status plays no part, and an open check still counts as strong."""
    check = FIELDS[field]
    tested = f"when m.{check}_check_valid then 'verified' when not m.{check}_check_valid then 'invalid'" if check else ""
    return f"case when m.{field} is null then 'missing' {tested} when m.parse_mode = 'strict_44_44' then 'strong' else 'weak' end"


@operator
def viz_wide(d, viz):
    """One row per sample of the page's fields: value, score and agreement by field."""
    cols = ", ".join(f"max(case when field = '{f}' then {c} end) as {f}{s}" for f in FIELDS for c, s in (("value", ""), ("score", "_score"), ("agreement", "_agreement")))
    return f"select sample_id, {cols} from {viz} group by sample_id"


@operator
def fused(d, manifest, mrz, viz, issue):
    """The manifest joined with its sources; each field chosen by the quality of its sources, with value, source and quality."""
    m_cols = ", ".join(f"nullif(m.{f}, '') as m_{f}, {mrz_quality(f)} as mq_{f}, {viz_quality(f)} as vq_{f}, v.{f} as v_{f}, {strength(f)} as ms_{f}" for f in FIELDS)
    joined = f"""select s.sample_id, s.identity_id, s.k, {m_cols}, m.document_type, m.issuing_country, m.parse_status, m.parse_mode, m.all_main_checks_valid, m.passport_number_check_valid, m.birth_date_check_valid, m.expiry_date_check_valid, m.final_check_valid, m.confidence as mrz_ocr_confidence,
        i.date_of_issue, i.status as doi_status, i.score as doi_score, m.sample_id is not null and m.parse_status = 'success' as mrz_available, v.sample_id is not null as viz_available
        from {manifest} as s left join {mrz} as m on s.sample_id = m.sample_id left join {viz} as v on s.sample_id = v.sample_id left join {issue} as i on s.sample_id = i.sample_id"""

    def source(f: str) -> str:
        return f"""case mq_{f} when 'verified' then 'mrz_verified' when 'invalid' then case when vq_{f} <> 'missing' then 'viz_' || vq_{f} else 'mrz_invalid_fallback' end when 'strong' then 'mrz_strong'
            when 'medium' then case when vq_{f} = 'high' then 'viz_high' else 'mrz_medium' end else case when vq_{f} <> 'missing' then 'viz_' || vq_{f} when mq_{f} = 'weak' then 'mrz_weak_fallback' end end"""

    picked = ", ".join(f"{source(f)} as {f}_source" for f in FIELDS)
    value = lambda f: f"case when left({f}_source, 3) = 'viz' then v_{f} when {f}_source is not null then m_{f} end"
    quality = lambda f: f"case when left({f}_source, 3) = 'viz' then vq_{f} when {f}_source is not null then mq_{f} else 'missing' end"
    out = ", ".join(f"{value(f)} as {f}, {f}_source, {quality(f)} as {f}_quality" for f in FIELDS)
    final = f"""select sample_id, identity_id, k, {out}, date_of_issue, case when date_of_issue is not null then 'viz_date_of_issue' end as date_of_issue_source, coalesce(doi_status, 'missing') as date_of_issue_quality,
        document_type, issuing_country, parse_status, parse_mode, all_main_checks_valid, passport_number_check_valid, birth_date_check_valid, expiry_date_check_valid, final_check_valid, mrz_ocr_confidence, doi_score, mrz_available, viz_available,
        {', '.join(f'm_{f}, v_{f}, ms_{f}, vq_{f}, mq_{f}' for f in FIELDS)} from (select *, {picked} from ({joined}) as q) as q"""
    present = " + ".join(f"case when {f} is null then 0 else 1 end" for f in CORE)
    missing = d.keep(d.array(*[f"case when {f} is null then '{f}' end" for f in CORE]))
    return f"""select *, case when {present} = {len(CORE)} then 'complete' when {present} > 0 then 'partial' else 'failed' end as coverage,
        case when mrz_available and viz_available then 'mrz_plus_viz' when mrz_available then 'mrz_only' when viz_available then 'viz_only' else 'none' end as extraction_mode,
        {missing} as missing_fields from ({final}) as q"""


def conflict(d, f: str) -> str:
    """Severity of a disagreement of both sources in a field; null without one."""
    a, b = (S.comparable(d, f, f"{x}_{f}", "consistency") for x in "mv")
    return f"case when m_{f} is not null and v_{f} is not null and {a} <> {b} then case when ms_{f} = 'verified' and vq_{f} = 'high' then 'high' when ms_{f} in ('verified', 'strong') and vq_{f} in ('high', 'medium') then 'medium' else 'low' end end"


def temporal_rules(d, today: str) -> list[tuple[str, str, str]]:
    """(code, severity, condition) over the dates b, i, e and their texts."""
    t = f"date '{today}'"
    years = lambda a, b: f"cast({d.days(a, b)} as double) / {d.num(365.25)}"
    bad = [(f"invalid_{n}", "medium", f"{n} is not null and {c} is null") for n, c in (("date_of_birth", "b"), ("date_of_issue", "i"), ("date_of_expiry", "e"))]
    return [*bad, ("birth_in_future", "high", f"b > {t}"), ("issue_in_future", "medium", f"i > {t}"), ("issue_before_birth", "high", "i < b"), ("expiry_not_after_birth", "high", "e <= b"), ("expiry_not_after_issue", "high", "e <= i"),
            ("unusual_validity", "medium", f"e > i and ({years('e', 'i')} < {d.num(0.25)} or {years('e', 'i')} > 15)"), ("unusual_age", "high", f"i >= b and {years('i', 'b')} > 120")]


@operator
def assessed(d, final, pages, *, today="2026-01-01"):
    """Consistency issues (code:severity), conflict fields, quality score, status and reasons for review of fused records; pages has the status of each sample's page."""
    dates = ", ".join(f"{S.iso_date(d, n)} as {c}" for n, c in (("date_of_birth", "b"), ("date_of_issue", "i"), ("date_of_expiry", "e")))
    rules = [*temporal_rules(d, today), ("unexpected_document_type", "medium", "document_type is not null and document_type <> '' and left(document_type, 1) <> 'P'"), ("unexpected_sex", "medium", "sex is not null and upper(sex) not in ('M', 'F', 'X')")]
    issue = [f"case when {c_} is not null then 'source_conflict_{f}:' || {c_} end" for f in FIELDS for c_ in [f"conflict_{f}"]] + [f"case when {c} then '{code}:{sev}' end" for code, sev, c in rules]
    base = f"select *, {dates}, {', '.join(f'{conflict(d, f)} as conflict_{f}' for f in FIELDS)} from (select f.*, p.status as page_status from {final} as f left join {pages} as p on f.sample_id = p.sample_id) as q"
    weight = lambda f: f"case {f}_quality {' '.join(f'when {q!r} then {d.num(w)}' for q, w in WEIGHTS.items())} else {d.num(UNKNOWN_WEIGHT)} end"
    known = lambda f: f"case when {f}_quality = 'missing' then 0 else 1 end"
    total, n = " + ".join(weight(f) for f in CORE), " + ".join(known(f) for f in CORE)
    lost = " + ".join([f"case conflict_{f} when 'high' then {PENALTY['high']} when 'medium' then {PENALTY['medium']} when 'low' then {PENALTY['low']} else 0 end" for f in FIELDS] + [f"case when {c} then {PENALTY[sev]} else 0 end" for _, sev, c in rules])
    high = " or ".join([f"coalesce(conflict_{f} = 'high', false)" for f in FIELDS] + [f"coalesce({c}, false)" for _, sev, c in rules if sev == "high"])
    count = lambda level: " + ".join([f"case when conflict_{f} = '{level}' then 1 else 0 end" for f in FIELDS] + [f"case when {c} then 1 else 0 end" for _, sev, c in rules if sev == level])
    scored = f"""select *, {count('high')} as high_count, {count('medium')} as medium_count, {d.keep(d.array(*issue))} as issues, {d.keep(d.array(*[f"case when conflict_{f} is not null then '{f}' end" for f in FIELDS]))} as conflict_fields,
        case when {n} = 0 then cast(0 as double) else greatest(cast(0 as double), least(cast(100 as double), 100 * ({total}) / ({n}) - ({lost}))) end as raw, {high} as has_high from ({base}) as q"""
    status = "case when raw >= 90 and not has_high then 'high_confidence' when raw >= 75 and not has_high then 'medium_confidence' when raw >= 50 then 'review' else 'low_confidence' end"
    told = [f"case when conflict_{f} in ('high', 'medium') then 'consistency:source_conflict_{f}' end" for f in FIELDS] + [f"case when {c} then 'consistency:{code}' end" for code, sev, c in rules if sev in ("high", "medium")]
    invalid = " or ".join(f"mq_{f} = 'invalid'" for f in FIELDS)
    reasons = d.keep(d.array("case when coverage <> 'complete' then 'incomplete_fields' end", f"case when {status} in ('review', 'low_confidence') then 'quality_status:' || {status} end", "case when not all_main_checks_valid then 'mrz_checksum_failed' end",
        "case when parse_mode = 'padded_or_truncated' then 'mrz_soft_parse' end", f"case when {invalid} then 'invalid_mrz_field_used_as_fallback' end", *told, f"case when page_status in {PAGE_LOST} then 'passport_stage:' || page_status end"))
    return f"""select sample_id, identity_id, k, {', '.join(CORE)}, {', '.join(f'{f}_source, {f}_quality' for f in CORE)}, document_type, issuing_country, parse_mode, all_main_checks_valid, passport_number_check_valid, birth_date_check_valid, expiry_date_check_valid, final_check_valid, mrz_available, viz_available,
        high_count, medium_count, coverage, extraction_mode, {d.joined('missing_fields', ' | ')} as missing_fields, {d.joined('issues', ' | ')} as issues, {d.joined('conflict_fields', ' | ')} as conflict_fields, has_high,
        {d.size('missing_fields')} as missing_count, {d.size('conflict_fields')} as conflict_count, {d.rounded('raw', 2)} as quality_score, {status} as quality_status,
        {d.joined('reasons', ' | ')} as review_reasons, {d.size('reasons')} > 0 as review_required from (select *, {reasons} as reasons from ({scored}) as q) as q"""
