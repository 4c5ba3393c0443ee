"""Plans of the zone operators. A plan gives the named steps of a query in one dialect; the last step is its result."""

from __future__ import annotations

from leafmill.operators import mrz
from leafmill.plans import synth

PLANS: dict = {}


def plan(f):
    PLANS[f.__name__] = f
    return f


def people(d):
    return [("ident", synth.identities(d))]


def scans(d):
    return [*people(d), ("sample", synth.samples(d, "ident"))]


def recognised(d):
    return [*scans(d), ("lines", synth.variants(d, "sample"))]


def checked(d):
    return [*recognised(d), ("checked", mrz.validated.text(d, "lines"))]


def profiled(d):
    return [*checked(d), ("profiles", mrz.format_profiles.text(d, "checked")), ("patterns", mrz.dominant_patterns.text(d, "profiles"))]


def repaired(d):
    own = [("trimmed", mrz.prefix_repaired.text(d, "lines")), ("prechecked", mrz.validated.text(d, "trimmed"))]
    fixes = [("fixes", mrz.checksum_repaired.text(d, "prechecked", "patterns")), ("codes", mrz.nationality_recovered.text(d, "prechecked"))]
    return [*profiled(d), *own, *fixes, ("repaired", mrz.repaired.text(d, "trimmed", "fixes", "codes"))]


def selected(d):
    return [*repaired(d), ("scores", mrz.candidate_scores.text(d, "checked")), ("chosen", mrz.best_variants.text(d, "scores"))]


def mrz_table(d):
    """The chosen variant of each sample, repaired, parsed and validated: sample_id, fields, checks, confidence."""
    pick = "select r.sample_id, r.variant, r.line_1, r.line_2, r.repair_methods, c.candidate_score, l.confidence from repaired as r join chosen as c on r.sample_id = c.sample_id and r.variant = c.selected_variant join lines as l on l.sample_id = r.sample_id and l.variant = r.variant"
    return [*selected(d), ("picked", pick), ("fields", mrz.parsed.text(d, "picked", strict=False, today=synth.TODAY)), ("valid", mrz.validated.text(d, "picked")),
            ("mrz", "select f.*, v.confidence, v.repair_methods, v.validation_status, v.passport_number_check_valid, v.birth_date_check_valid, v.expiry_date_check_valid, v.personal_number_check_valid, v.final_check_valid, v.all_main_checks_valid from fields as f join valid as v on f.sample_id = v.sample_id")]


@plan
def mrz_validity_by_issuer(d):
    """Counts of valid, invalid and unchecked lines by issuer."""
    return [*checked(d), ("q", f"select issuer, cast(count(*) as bigint) as n, {d.count_if('all_main_checks_valid')} as valid, {d.count_if('not all_main_checks_valid')} as invalid, {d.count_if('all_main_checks_valid is null')} as unchecked from checked group by issuer")]


@plan
def mrz_check_digits(d):
    return [*checked(d), ("q", "select * from checked")]


@plan
def mrz_line_cleaning(d):
    return [*recognised(d), ("q", mrz.cleaned.text(d, "lines"))]


@plan
def td3_parse_strict(d):
    return [*recognised(d), ("q", mrz.parsed.text(d, "lines", strict=True, today=synth.TODAY))]


@plan
def td3_parse_soft(d):
    return [*recognised(d), ("q", mrz.parsed.text(d, "lines", strict=False, today=synth.TODAY))]


@plan
def mrz_line_prefix_repair(d):
    return [*recognised(d), ("q", mrz.prefix_repaired.text(d, "lines"))]


@plan
def mrz_format_profiles(d):
    return [*checked(d), ("q", mrz.format_profiles.text(d, "checked"))]


@plan
def dominant_pattern(d):
    return [*profiled(d), ("q", "select * from patterns")]


@plan
def mrz_checksum_repair(d):
    return [*repaired(d), ("q", "select * from fixes")]


@plan
def nationality_recovery(d):
    return [*repaired(d), ("q", "select * from codes")]


@plan
def mrz_row_pipeline(d):
    return [*repaired(d), ("fields", mrz.parsed.text(d, "repaired", strict=False, today=synth.TODAY)), ("q", "select f.*, r.repair_methods, r.line_1, r.line_2 from fields as f join repaired as r on f.sample_id = r.sample_id and f.variant = r.variant")]


@plan
def mrz_candidate_scores(d):
    return [*selected(d), ("q", "select * from scores")]


@plan
def best_ocr_variant(d):
    return [*selected(d), ("q", "select * from chosen")]


@plan
def mrz_row_reconstruction(d):
    one = lambda i, text, x, y: f"select sample_id, cast({i} as bigint) as pos, {text} as text, {d.num(x)} as x1, {d.num(y)} + cast(k % 3 as double) as y1, {d.num(x + 100)} as x2, {d.num(y + 18)} + cast(k % 3 as double) as y2 from sample"
    items = " union all ".join([one(0, "substr(l2, 23)", 260, "40" and 40), one(1, "left(l1, 20)", 10, 10), one(2, "substr(l1, 21)", 250, 12), one(3, "left(l2, 22)", 12, 42)])
    flat = "select sample_id, pos, text, x1, case when sample_id like '%0' then 10 + 0 * y1 else y1 end as y1, x2, case when sample_id like '%0' then 28 + 0 * y2 else y2 end as y2 from items"
    return [*scans(d), ("items", items), ("boxed", flat), ("q", mrz.rows_from_items.text(d, "boxed"))]
