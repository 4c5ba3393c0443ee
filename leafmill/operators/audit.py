"""Audit of truth tables, dedupe, keyed indexes and merges."""

from __future__ import annotations

from leafmill.functions import scalars as S
from leafmill.functions.dialect import operator
from leafmill.operators.fusion import CORE


def flags_in_one_pass(d, truth, final, rules):
    """What the union in truth_flags gives, from one reading of either table; the union's parts, each with readings and joins of its own, are more than the driver has room to plan."""
    up = lambda f, x: S.comparable(d, f, x, "audit")
    texts = ", ".join(f"case when coalesce(trim({f}), '') <> '' then {up(f, f)} end as u_{f}" for f in CORE)
    dates = ", ".join(f"{S.iso_date(d, f'date_of_{x}')} as {x[0]}" for x in ("birth", "issue", "expiry"))
    mixed = ", ".join(f"min(u_{f}) over (partition by identity_id) <> max(u_{f}) over (partition by identity_id) as mixed_{f}" for f in CORE)
    known = f"select *, {mixed}, count(*) over (partition by sample_id) as n from (select sample_id, identity_id, {', '.join(CORE)}, {texts}, {dates} from {truth}) as q"
    both = f"select t.*, {', '.join(f'p.{f} as p_{f}' for f in CORE)} from ({known}) as t left join {final} as p on t.sample_id = p.sample_id"
    found = [*[("blank_gt_field", f, "medium", f"u_{f} is null") for f in CORE], ("duplicate_sample", "sample_id", "high", "n > 1"), *[("identity_field_inconsistent", f, "high", f"u_{f} is not null and mixed_{f}") for f in CORE],
             *[(n, f, "high", c) for n, f, c in rules], *[("gt_differs_from_prediction", f, "low", f"u_{f} <> {up(f, f'p_{f}')}") for f in CORE],
             *[("possible_day_month_swap", f, "medium", f"{S.swapped(d, S.iso_date(d, f))} = {S.iso_date(d, f'p_{f}')}") for f in CORE if f.startswith("date")]]
    flags = d.keep(d.array(*[f"case when {c} then {d.struct(flag=repr(n), field=repr(f), severity=repr(s))} end" for n, f, s, c in found]))
    return f"select distinct sample_id, identity_id, r.* from ({both}) as q lateral view inline({flags}) r"


@operator
def truth_flags(d, truth, final, *, today="2026-01-01"):
    """Flags of a truth table: blank fields, duplicate samples, fields that differ within an identity, temporal faults, and differences
    from predictions, with a day and month swap where that explains one. One row per (sample, flag, field), by severity."""
    t = f"date '{today}'"
    years = f"cast({d.days('e', 'i')} as double) / {d.num(365.2425)}"
    up = lambda f, x: S.comparable(d, f, x, "audit")
    blank = [f"select sample_id, identity_id, 'blank_gt_field' as flag, '{f}' as field, 'medium' as severity from {truth} where coalesce(trim({f}), '') = ''" for f in CORE]
    twice = f"select sample_id, identity_id, 'duplicate_sample' as flag, 'sample_id' as field, 'high' as severity from (select *, count(*) over (partition by sample_id) as n from {truth}) as q where n > 1"
    long = " union all ".join(f"select sample_id, identity_id, '{f}' as field, {up(f, f)} as v from {truth} where coalesce(trim({f}), '') <> ''" for f in CORE)
    mixed = f"select sample_id, identity_id, 'identity_field_inconsistent' as flag, field, 'high' as severity from (select *, min(v) over (partition by identity_id, field) <> max(v) over (partition by identity_id, field) as bad from ({long}) as q) as q where bad"
    dates = f"select sample_id, identity_id, {S.iso_date(d, 'date_of_birth')} as b, {S.iso_date(d, 'date_of_issue')} as i, {S.iso_date(d, 'date_of_expiry')} as e from {truth}"
    rules = [("birth_in_future", "date_of_birth", f"b > {t}"), ("issue_in_future", "date_of_issue", f"i > {t}"), ("issue_not_after_birth", "date_of_issue", "i <= b"), ("expiry_not_after_birth", "date_of_expiry", "e <= b"), ("expiry_not_after_issue", "date_of_expiry", "e <= i"), ("unusual_validity_period", "date_of_expiry", f"{years} < {d.num(0.25)} or {years} > {d.num(15.5)}")]
    if d.name == "spark":
        return flags_in_one_pass(d, truth, final, rules)
    temporal = [f"select sample_id, identity_id, '{n}' as flag, '{f}' as field, 'high' as severity from ({dates}) as q where {c}" for n, f, c in rules]
    differs = [f"select t.sample_id, t.identity_id, 'gt_differs_from_prediction' as flag, '{f}' as field, 'low' as severity from {truth} as t join {final} as p on t.sample_id = p.sample_id where {up(f, f't.{f}')} <> {up(f, f'p.{f}')} and coalesce(trim(t.{f}), '') <> ''" for f in CORE]
    swap = [f"select t.sample_id, t.identity_id, 'possible_day_month_swap' as flag, '{f}' as field, 'medium' as severity from {truth} as t join {final} as p on t.sample_id = p.sample_id where {S.swapped(d, S.iso_date(d, f't.{f}'))} = {S.iso_date(d, f'p.{f}')}" for f in CORE if f.startswith("date")]
    return f"select distinct sample_id, identity_id, flag, field, severity from ({' union all '.join([*blank, twice, mixed, *temporal, *differs, *swap])}) as q"


@operator
def flag_summary(d, flags):
    return f"select flag, severity, cast(count(*) as bigint) as n, cast(count(distinct sample_id) as bigint) as samples from {flags} group by flag, severity"


@operator
def truth_problems(d, truth):
    """What makes a truth table unfit: missing ids, duplicates, identities in more than one split."""
    return f"""select 'missing_identity' as problem, sample_id as key from {truth} where coalesce(trim(identity_id), '') = ''
        union all select 'duplicate_sample' as problem, sample_id as key from {truth} group by sample_id having count(*) > 1
        union all select 'identity_in_several_splits' as problem, identity_id as key from {truth} group by identity_id having count(distinct split) > 1"""


@operator
def last_wins(d, rows, *, key, position):
    """One row per key, with the values of its last occurrence and the place of its first; rows without key are dropped."""
    inner = f"select *, row_number() over (partition by {key} order by {position} desc) as last_r, min({position}) over (partition by {key}) as first_position from {rows} where {key} is not null"
    return f"select * from ({inner}) as q where last_r = 1"


@operator
def indexed(d, rows):
    """Rows by sample_id, or by the file name's stem where that is blank; of several the last by pos."""
    stem = d.replaced("filename", "[.][^.]*$", "")
    return f"select key, pos, filename from (select *, row_number() over (partition by key order by pos desc) as r from (select *, coalesce(nullif(trim(sample_id), ''), {stem}) as key from {rows}) as q where coalesce(key, '') <> '') as q where r = 1"


@operator
def merged_split(d, base, added):
    """Rows of both tables if no sample is doubled and no identity changes split; else the rows of base alone, and the offending rows, marked. The merge is refused whole."""
    twice = f"select a.sample_id, 'duplicate_sample' as refused from {added} as a join {base} as b on a.sample_id = b.sample_id"
    own = f"select sample_id, 'duplicate_sample' as refused from {added} group by sample_id having count(*) > 1"
    moved = f"select a.sample_id, 'identity_in_other_split' as refused from {added} as a join {base} as b on a.identity_id = b.identity_id where a.split <> b.split"
    bad = f"select sample_id, min(refused) as refused from ({twice} union all {own} union all {moved}) as q group by sample_id"
    none = f"cast(null as {'string' if d.name == 'spark' else 'varchar'})"
    return f"""select sample_id, identity_id, split, {none} as refused from {base} union all select a.sample_id, a.identity_id, a.split, o.refused
        from {added} as a left join ({bad}) as o on a.sample_id = o.sample_id cross join (select count(*) as n from ({bad}) as q) as c where c.n = 0 or o.refused is not null"""
