"""Identities: suggestion, grouping, risk, deterministic selection and splits, queues and merges."""

from __future__ import annotations

from leafmill.functions import scalars as S
from leafmill.functions.dialect import operator
from leafmill.operators.fusion import CORE

GOOD = "('verified', 'strong', 'high', 'medium')"
STRONG = "('verified', 'strong', 'high')"
#: Columns of a queue that hold work done by hand.
PROGRESS = ["identity_id", "annotation_status", "propagated_from_sample_id", "split", "notes", *[f"gt_{f}" for f in CORE]]


@operator
def suggested(d, final):
    """An identity for each record: by a strong passport number, else by surname and both dates, else of its own."""
    ppn, sur = S.comparable(d, "passport_number", "passport_number", "sampling"), S.comparable(d, "surname", "surname", "sampling")
    b, e = (S.comparable(d, f, f, "sampling") for f in ("date_of_birth", "date_of_expiry"))
    strong = f"length({ppn}) >= 5 and (passport_number_quality in {STRONG} or passport_number_source = 'mrz_verified')"
    weak = f"surname_quality in {GOOD} and date_of_birth_quality in {GOOD} and date_of_expiry_quality in {GOOD} and length({sur}) >= 2 and length({b}) = 8 and length({e}) = 8"
    h = lambda x: S.short_hash(d, x)
    return f"""select *, case when {strong} then 'id_ppn_' || {h(f"'PPN:' || {ppn}")} when {weak} then 'id_sde_' || {h(f"'SDE:' || {sur} || '|' || {b} || '|' || {e}")} else 'id_single_' || {h("'SINGLE:' || sample_id")} end as suggested_id,
        case when {strong} then 'high' when {weak} then 'medium' else 'low' end as identity_confidence from {final}"""


@operator
def risks(d, rows):
    """Annotation risk and difficulty of each record."""
    q = "case quality_status when 'low_confidence' then 5 when 'review' then 4 when 'medium_confidence' then 1.8 when 'high_confidence' then 0 else 1 end".replace("1.8", d.num(1.8))
    c = "case coverage when 'failed' then 5 when 'partial' then 3 when 'complete' then 0 else 1 end"
    doi = f"case when date_of_issue is null then {d.num(1.5)} when date_of_issue_quality in ('low_confidence', 'weak') then 1 else 0 end"
    checks = " + ".join(f"case when not {c}_check_valid then 1 else 0 end" for c in ("passport_number", "birth_date", "expiry_date", "final"))
    risk = f"{q} + {c} + case when review_required then 2 else 0 end + least(4, {d.num(1.5)} * conflict_count) + 2 * high_count + {d.num(0.8)} * medium_count + {checks} + case when parse_mode = 'padded_or_truncated' then {d.num(1.5)} else 0 end + {doi} + least(4, {d.num(0.75)} * missing_count)"
    ease = "case coverage when 'complete' then 5 when 'partial' then 2 else 0 end + case quality_status when 'high_confidence' then 4 when 'medium_confidence' then 2 when 'review' then 1 else 0 end"
    ease += "".join(f" + case when coalesce(trim({f}), '') <> '' then {d.num(0.5)} else 0 end" for f in CORE) + f" - {d.num(0.15)} * risk"
    scored = f"select *, {d.rounded(f'cast({risk} as double)', 3)} as risk from {rows}"
    inner = f"select *, {d.rounded(f'cast({ease} as double)', 3)} as ease from ({scored}) as q"
    return f"select *, case when risk >= 6 then 'hard' when risk >= {d.num(2.5)} then 'medium' else 'easy' end as difficulty from ({inner}) as q"


@operator
def identity_groups(d, rows):
    """One row per suggested identity: size, risks, difficulty, commonest country (the smallest of equals), anchor sample."""
    counts = f"select suggested_id, issuing_country, count(*) as n from {rows} where coalesce(issuing_country, '') <> '' group by suggested_id, issuing_country"
    country = f"select suggested_id, issuing_country from (select *, row_number() over (partition by suggested_id order by n desc, issuing_country) as r from ({counts}) as q) as q where r = 1"
    anchor = f"select suggested_id, sample_id from (select suggested_id, sample_id, row_number() over (partition by suggested_id order by ease desc, sample_id desc) as r from {rows}) as q where r = 1"
    sums = f"select suggested_id, cast(count(*) as bigint) as group_size, max(risk) as max_risk, {d.rounded('cast(sum(cast(round(risk * 1000) as bigint)) as double) / 1000 / count(*)', 6)} as mean_risk, min(identity_confidence) as identity_confidence from {rows} group by suggested_id"
    return f"""select s.*, coalesce(c.issuing_country, '') as country, a.sample_id as anchor_sample_id, case when s.max_risk >= 6 then 'hard' when s.max_risk >= {d.num(2.5)} then 'medium' else 'easy' end as difficulty
        from ({sums}) as s left join ({country}) as c on s.suggested_id = c.suggested_id join ({anchor}) as a on s.suggested_id = a.suggested_id"""


def robin(groups: str) -> str:
    """Groups of each difficulty taken from their countries in turn: larger countries first, riskier groups first."""
    inner = f"select *, row_number() over (partition by difficulty, country order by max_risk desc, suggested_id) as turn, count(*) over (partition by difficulty, country) as country_size from {groups}"
    return f"select *, row_number() over (partition by difficulty order by turn, country_size desc, country) as position from ({inner}) as q"


@operator
def round_robin(d, groups):
    return f"select suggested_id, difficulty, country, cast(position as bigint) as position from ({robin(groups)}) as q"


@operator
def selected(d, groups, *, target=60):
    """A stratified choice: half hard, three tenths medium, the rest easy; what a stratum lacks is filled by risk."""
    n = f"(select count(*) from {groups})"
    t = f"least({target}, {n})"
    hard, medium = f"cast(ceil({t} * {d.num(0.5)}) as bigint)", f"cast(floor({t} * {d.num(0.3)}) as bigint)"
    quota = f"case difficulty when 'hard' then {hard} when 'medium' then {medium} else {t} - {hard} - {medium} end"
    marked = f"select *, position <= {quota} as in_quota from ({robin(groups)}) as q"
    filled = f"select *, row_number() over (order by in_quota desc, case when in_quota then 0 else -max_risk end, country, suggested_id) as r from ({marked}) as q"
    return f"select suggested_id, difficulty, country, max_risk, group_size, anchor_sample_id, in_quota from ({filled}) as q where r <= {t}"


@operator
def annotation_queue(d, selection, rows):
    """All members of selected identities: the anchor is pending, the others wait for it."""
    inner = f"select s.difficulty, s.max_risk, s.suggested_id, r.sample_id, r.sample_id = s.anchor_sample_id as is_anchor, s.group_size, {', '.join(f'r.{f} as pred_{f}' for f in CORE)} from {selection} as s join {rows} as r on s.suggested_id = r.suggested_id"
    return f"""select *, case when is_anchor then 'pending' else 'waiting_for_anchor' end as annotation_status,
        cast(row_number() over (order by case difficulty when 'hard' then 0 when 'medium' then 1 else 2 end, max_risk desc, suggested_id, case when is_anchor then 0 else 1 end, sample_id) as bigint) as position from ({inner}) as q"""


@operator
def holdout(d, selection, *, count=20):
    """A holdout by largest remainder over strata of difficulty and country, in hash order within a stratum."""
    f = d.fraction(S.short_hash(d, "suggested_id"))
    sized = f"select *, {f} as fraction, count(*) over () as n, count(*) over (partition by difficulty, country) as m from {selection}"
    share = f"select *, row_number() over (partition by difficulty, country order by fraction, suggested_id) as r, cast(floor(cast(m * {count} as double) / n) as bigint) as base, cast(m * {count} % n as bigint) as remainder from ({sized}) as q"
    strata = f"select difficulty, country, min(base) as base, min(remainder) as remainder, min(n) as n from ({share}) as q group by difficulty, country"
    extra = f"select *, row_number() over (order by remainder desc, difficulty, country) as pos, {count} - sum(base) over () as left_over from ({strata}) as q"
    return f"""select s.suggested_id, s.difficulty, s.country, s.r <= e.base + case when e.pos <= e.left_over then 1 else 0 end as in_holdout
        from ({share}) as s join ({extra}) as e on s.difficulty = e.difficulty and s.country = e.country"""


@operator
def seeded_split(d, rows, *, seed=42, train=0.7, val=0.15):
    """Identities in the order of a seeded hash, cut into train, validation and test; all samples of an identity stay together."""
    ids = f"select identity_id, row_number() over (order by {d.sha256(f'{chr(39)}{seed}:{chr(39)} || identity_id')}, identity_id) as place, count(*) over () as total_ids from (select distinct identity_id from {rows}) as q"
    a, b = (d.rounded(f"cast(total_ids * {d.num(x)} as double)", 0) for x in (train, val))
    return f"select x.sample_id, x.identity_id, case when i.place <= {a} then 'train' when i.place <= {a} + {b} then 'validation' else 'test' end as split from {rows} as x join ({ids}) as i on x.identity_id = i.identity_id"


@operator
def unseen(d, rows, truth):
    """Suggested identities none of whose members is known by sample, passport number, or surname with both dates."""
    norm = lambda f, t: S.comparable(d, f, f"{t}.{f}", "sampling")
    triple = lambda t: f"{norm('surname', t)} || '|' || {norm('date_of_birth', t)} || '|' || {norm('date_of_expiry', t)}"
    full = lambda t, *fields: " and ".join(f"coalesce({norm(f, t)}, '') <> ''" for f in fields)  # noqa: E731  blanks know nobody
    ids, three = f"select r.suggested_id from {rows} as r join {truth} as t on ", ("surname", "date_of_birth", "date_of_expiry")
    known = [f"{ids}r.sample_id = t.sample_id", f"{ids}{norm('passport_number', 'r')} = {norm('passport_number', 't')} where {full('r', 'passport_number')}", f"{ids}{triple('r')} = {triple('t')} where {full('r', *three)}"]
    return f"select r.suggested_id, cast(count(*) as bigint) as members from {rows} as r left anti join ({' union '.join(known)}) as k on r.suggested_id = k.suggested_id group by r.suggested_id" if d.name == "spark" else f"select suggested_id, cast(count(*) as bigint) as members from {rows} where suggested_id not in ({' union '.join(known)}) group by suggested_id"


@operator
def propagated(d, queue, anchors):
    """A queue with verified anchors' values copied to all rows of their identity."""
    cols = ", ".join(f"case when a.suggested_id is not null then a.gt_{f} end as gt_{f}" for f in CORE)
    return f"""select q.sample_id, q.suggested_id, q.is_anchor, {cols}, case when a.suggested_id is null then q.annotation_status when q.is_anchor then 'verified' else 'propagated' end as annotation_status
        from {queue} as q left join {anchors} as a on q.suggested_id = a.suggested_id"""


@operator
def propagation_counts(d, queue, anchors):
    """For each anchor that was verified, the rows that its values reach, and an error where its identity is not in the queue."""
    n = "cast(count(q.sample_id) as bigint)"
    return f"select a.suggested_id, {n} as affected, case when count(q.sample_id) = 0 then 'unknown identity' end as error from {anchors} as a left join {queue} as q on a.suggested_id = q.suggested_id group by a.suggested_id"


@operator
def exported(d, queue):
    """Truth rows: verified or propagated ones with an identity."""
    return f"select sample_id, suggested_id as identity_id, {', '.join(f'gt_{f} as {f}' for f in CORE)} from {queue} where annotation_status in ('verified', 'propagated') and coalesce(suggested_id, '') <> ''"


@operator
def progress(d, queue):
    """Progress counts of a queue; the saving factor is samples covered per sample verified by hand."""
    inner = f"select cast(count(*) as bigint) as total, {d.count_if('is_anchor')} as anchors, {d.count_if(chr(39).join(['is_anchor and annotation_status = ', 'verified', '']))} as verified, {d.count_if(chr(39).join(['annotation_status in (', 'verified', ',', 'propagated', ')']))} as covered from {queue}"
    return f"select *, case when verified > 0 then {d.rounded('cast(covered as double) / verified', 2)} end as saving_factor from ({inner}) as q"


@operator
def extended(d, fresh, existing):
    """A fresh queue that keeps the progress of an existing one, then the existing rows that are no longer in it."""
    # what an existing row says holds, also where it says nothing
    cols = ", ".join(f"case when e.sample_id is not null then e.{c} else f.{c} end as {c}" for c in PROGRESS)
    kept = f"select f.sample_id, f.suggested_id, {cols}, e.sample_id is not null as preserved from {fresh} as f left join {existing} as e on f.sample_id = e.sample_id"
    rest = f"select e.sample_id, e.suggested_id, {', '.join(f'e.{c}' for c in PROGRESS)}, true as preserved from {existing} as e left join {fresh} as f on e.sample_id = f.sample_id where f.sample_id is null"
    return f"select * from ({kept}) as a union all select * from ({rest}) as b"
