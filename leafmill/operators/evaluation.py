"""Accuracy, calibration and failures of final records against a truth; summaries of final records."""

from __future__ import annotations

from leafmill.functions import scalars as S
from leafmill.functions.dialect import operator
from leafmill.operators.fusion import CORE, FIELDS, PAGE_LOST


@operator
def coverage_summary(d, final):
    """Counts and rates over all records, one row per metric."""
    metrics = [(f"coverage_{c}", f"coverage = '{c}'") for c in ("complete", "partial", "failed")] + [(f"quality_{q}", f"quality_status = '{q}'") for q in ("high_confidence", "medium_confidence", "review", "low_confidence")]
    metrics += [("review_required", "review_required"), ("with_conflicts", "conflict_count > 0"), ("with_high_issue", "has_high"), *[(f"available_{f}", f"{f} is not null") for f in CORE]]
    inner = f"select cast(count(*) as bigint) as total, {', '.join(f'{d.count_if(c)} as c{i}' for i, (_, c) in enumerate(metrics))} from {final}"
    number = f"case i {' '.join(f'when {i} then c{i}' for i in range(len(metrics)))} end"
    name = f"case i {' '.join(f'when {i} then {n!r}' for i, (n, _) in enumerate(metrics))} end"
    return f"select {name} as metric, {number} as count, cast({number} as double) / total as rate from (select * from ({inner}) as q{d.each('0', str(len(metrics) - 1), 'i')}) as q"


@operator
def compared(d, final, truth):
    """One row per sample and field with a known truth: expected, predicted, correct."""
    one = lambda f: f"'{f}' as field, {S.comparable(d, f, f't.{f}', 'evaluation')} as expected, {S.comparable(d, f, f'f.{f}', 'evaluation')} as predicted, f.{f}_source as source, f.{f}_quality as quality"
    rows = d.stacked("f.sample_id, t.identity_id, t.split, f.quality_status", [one(f) for f in CORE], f"{final} as f join {truth} as t on f.sample_id = t.sample_id")
    return f"select *, coalesce(predicted = expected, false) as correct from ({rows}) as q where coalesce(expected, '') <> ''"


@operator
def field_accuracy(d, compared):
    """Accuracy by field, and of samples with every field correct."""
    inner = f"select field, cast(count(*) as bigint) as total, {d.count_if('correct')} as correct from {compared} group by field"
    strict = f"select 'all_fields' as field, cast(count(*) as bigint) as total, {d.count_if('good')} as correct from (select sample_id, min(case when correct then 1 else 0 end) = 1 as good from {compared} group by sample_id) as q"
    return f"select field, total, correct, cast(correct as double) / total as accuracy from (select * from ({inner}) as a union all select * from ({strict}) as b) as q"


def vote(table: str, value: str) -> str:
    """The most frequent non-null value of an identity's field; of equals the one of the smallest sample_id."""
    counts = f"select identity_id, split, field, {value} as v, count(*) as n, min(sample_id) as first from {table} where {value} is not null group by identity_id, split, field, {value}"
    return f"select identity_id, split, field, v from (select *, row_number() over (partition by identity_id, field order by n desc, first) as r from ({counts}) as q) as q where r = 1"


@operator
def identity_votes(d, compared):
    """Majority vote by identity and field, and whether both agree."""
    return f"select e.identity_id, e.split, e.field, e.v as expected, p.v as predicted, coalesce(e.v = p.v, false) as correct from ({vote(compared, 'expected')}) as e left join ({vote(compared, 'predicted')}) as p on e.identity_id = p.identity_id and e.field = p.field"


@operator
def identity_accuracy(d, votes):
    return f"select field, cast(count(*) as bigint) as count_total, {d.count_if('correct')} as count_correct, cast({d.count_if('correct')} as double) / count(*) as accuracy from {votes} group by field"


@operator
def calibration(d, compared):
    """Accuracy by quality status; other labels are left out."""
    rows = f"select sample_id, coalesce(quality_status, 'unknown') as quality_status, min(case when correct then 1 else 0 end) as good, count(*) as fields, sum(case when correct then 1 else 0 end) as right_fields from {compared} group by sample_id, coalesce(quality_status, 'unknown')"
    return f"""select quality_status, case quality_status when 'high_confidence' then 1 when 'medium_confidence' then 2 when 'review' then 3 when 'low_confidence' then 4 else 5 end as position, cast(count(*) as bigint) as samples,
        cast(sum(good) as double) / count(*) as all_fields_rate, cast(sum(right_fields) as double) / sum(fields) as field_accuracy from ({rows}) as q
        where quality_status in ('high_confidence', 'medium_confidence', 'review', 'low_confidence', 'unknown') group by quality_status"""


@operator
def split_metrics(d, compared, votes):
    """Accuracy by split, level (image or identity) and metric (a field or all of them)."""
    fields = lambda t, level: f"select split, '{level}' as level, coalesce(field, 'any_field') as metric, cast(sum(case when correct then 1 else 0 end) as bigint) as correct, cast(count(*) as bigint) as total from {t} group by grouping sets ((split, field), (split))"
    every = lambda t, level, key: f"select split, '{level}' as level, 'all_fields' as metric, cast(sum(good) as bigint) as correct, cast(count(*) as bigint) as total from (select split, {key}, min(case when correct then 1 else 0 end) as good from {t} group by split, {key}) as q group by split"
    parts = [fields(compared, "image"), every(compared, "image", "sample_id"), fields(votes, "identity"), every(votes, "identity", "identity_id")]
    return f"select *, cast(correct as double) / total as accuracy from ({' union all '.join(parts)}) as q"


@operator
def failures(d, compared, mrz, viz, issue, pages):
    """Each wrong field with the stage that lost it: what either source says is held against the truth, by an ordered cascade of rules."""
    value = lambda t, fields: f"case c.field {' '.join(f'when {f!r} then ' + S.comparable(d, f, f'{t}.{f}', 'evaluation') for f in fields)} end"
    check = f"case c.field {' '.join(f'when {f!r} then m.{c}_check_valid' for f, c in FIELDS.items() if c)} end"
    joined = f"""select c.*, p.status as page_status, m.sample_id is not null as has_mrz, v.sample_id is not null as has_viz, m.parse_status, m.parse_mode, {check} as check_valid,
        nullif({value('m', FIELDS)}, '') as mrz_value, nullif({value('v', FIELDS)}, '') as viz_value, {S.comparable(d, 'date_of_issue', 'i.date_of_issue', 'evaluation')} as doi_value
        from {compared} as c left join {mrz} as m on c.sample_id = m.sample_id left join {viz} as v on c.sample_id = v.sample_id left join {issue} as i on c.sample_id = i.sample_id left join {pages} as p on c.sample_id = p.sample_id where not c.correct"""
    is_from = lambda s: f"coalesce(left(source, 3) = '{s}', false)"
    right = lambda s: f"coalesce({s}_value = expected, false)"
    category = f"""case when page_status in {PAGE_LOST} then 'passport_stage'
        when field = 'date_of_issue' and {right('doi')} then 'fusion_or_finalization' when field = 'date_of_issue' then 'doi_extraction'
        when {is_from('mrz')} and {right('viz')} and not {right('mrz')} then 'fusion' when {is_from('viz')} and {right('mrz')} and not {right('viz')} then 'fusion'
        when {is_from('mrz')} or (coalesce(source, '') = '' and mrz_value is not null) then case when not check_valid then 'mrz_ocr' when coalesce(parse_status, '') <> 'success' or coalesce(parse_mode, '') = 'padded_or_truncated' then 'mrz_parse' else 'mrz_ocr_or_parse' end
        when {is_from('viz')} or (coalesce(source, '') = '' and viz_value is not null) then 'viz_field_extraction'
        when predicted is null and not has_mrz and not has_viz then 'upstream_missing' when predicted is null then 'field_missing' else 'unclassified' end"""
    return f"select sample_id, identity_id, split, quality_status, field, expected, predicted, source, quality, correct, {category} as failure_category from ({joined}) as q"


@operator
def failure_counts(d, failures):
    """Errors and identities by category, by split and category, and by field, in one pass of grouping sets."""
    return f"""select failure_category, split, field, cast(count(*) as bigint) as errors, cast(count(distinct identity_id) as bigint) as identities, cast(count(*) as double) / max(total) as rate
        from {failures} cross join (select count(*) as total from {failures}) as t group by grouping sets ((failure_category), (split, failure_category), (field))"""


@operator
def status_histogram(d, table, *, column="status"):
    return f"select {column} as status, cast(count(*) as bigint) as n from {table} group by {column}"


@operator
def review_bundle(d, failures, *, categories=(), most=50):
    """Samples to review: those with most errors first, at most `most`, with their categories."""
    only = f"where failure_category in ({', '.join(repr(c) for c in categories)})" if categories else ""
    groups = f"select sample_id, cast(count(*) as bigint) as errors, {d.joined(d.collected_set('failure_category'), ' | ')} as categories, {d.joined(d.collected_set('field'), ' | ')} as fields from {failures} {only} group by sample_id"
    return f"select * from (select *, cast(row_number() over (order by errors desc, sample_id) as bigint) as position from ({groups}) as q) as q where position <= {max(0, most)}"
