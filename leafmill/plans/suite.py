"""Further queries: scalars and geometry, choice of variants, joins by name, expansion, and the benchmark suite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.functions import scalars as S
from leafmill.operators import audit, evaluation, fields, identity, pages
from leafmill.operators.fusion import CORE
from leafmill.plans import synth
from leafmill.plans.extraction import mrz_table, people, scans
from leafmill.plans.records import annotated, failed, risky, truth_rows
from leafmill.plans.relational import query

PLANS: dict = {}
QUERIES: dict = {}
ORACLES: dict = {}


def plan(f):
    PLANS[f.__name__] = f
    return f


@plan
def hamming_codes(d):
    """Differing places of texts of any length; 999 where lengths differ."""
    return [*people(d), ("q", f"select k, {S.hamming(d, 'ppn', 'reverse(ppn)')} as own, {S.hamming(d, 'surname', 'given')} as names, {S.hamming(d, 'l1', 'l2')} as lines from ident")]


@plan
def value_validators(d):
    """Names and nationalities by their own rules, in scripts and white space of all kinds."""
    raw = "case k % 6 when 0 then ' |' || surname || '  x;' when 1 then 'Я' || chr(9) || given when 2 then '12.03.2015' when 3 then 'é' when 4 then '7 é' else '--' end"
    return [*people(d), ("q", f"select k, {S.value_trimmed(d, 'raw')} as trimmed, {S.name_valid(d, 'raw')} as name_valid, {S.nationality_valid(d, 'raw')} as nationality_valid from (select k, {raw} as raw from ident) as q")]


@plan
def accented_comparison(d):
    """Values with marked letters as the consistency rules compare them."""
    raw = "'É' || lower(surname) || 'çñ-ö' || given"
    cols = ", ".join(f"{S.comparable(d, f, 'raw', 'consistency')} as {f}" for f in ("passport_number", "surname", "sex", "date_of_birth"))
    return [*people(d), ("q", f"select k, {cols} from (select k, {raw} as raw from ident) as q")]


@plan
def box_geometry(d):
    """Boxes around two neighbours of which one may be missing, seen from a crop, and padded within an image."""
    box = d.struct(**{c: c for c in ("x1", "y1", "x2", "y2")})
    item = f"select sample_id, vi, pos, case when x1 is not null then {box} end as b, x1, y1, x2, y2 from items"
    named = lambda xs, p: ", ".join(f"{x} as {p}{c}" for x, c in zip(xs, ("x1", "y1", "x2", "y2")))
    w, h = d.num(300), d.num(200)
    cols = f"{named(S.union_box('a.b', 'n.b'), 'u_')}, {named(S.moved(d.num(12), d.num(7), 'a.'), 'm_')}, {named(S.padded(d, S.PAGE_PADDING, w, h, 'a.'), 'p_')}, {named(S.padded(d, S.ZONE_PADDING, w, h, 'a.'), 'z_')}"
    three = f"select * from sample{d.each('0', '2', 'vi')}"
    return [*scans(d), ("shots", three), ("items", synth.scan_items(d, "shots")), ("boxed", item), ("q", f"select a.sample_id, a.vi, a.pos, {cols} from boxed as a join boxed as n on a.sample_id = n.sample_id and a.vi = n.vi and n.pos = a.pos + 1")]


@plan
def quad_checks(d):
    """Corners of pages put in order, and what speaks against them."""
    corner = lambda i, x, y: f"select sample_id, cast({i} as bigint) as i, {d.num(x)} + cast(k * {i + 3} % {40 + 60 * i} as double) as x, {d.num(y)} + cast(k * {i + 5} % {30 + 50 * i} as double) as y from sample"
    points = " union all ".join([corner(0, 760, 20), corner(1, 5, 8), corner(2, 10, 480), corner(3, 640, 470)])
    crops = f"select sample_id, {d.num(800)} as width, {d.num(600)} as height, case when k % 3 <> 0 then {d.num(0.9)} + cast(k % 10 as double) / 100 end as inside, {d.num(500)} + cast(k % 90 as double) as zone_y2 from sample"
    return [*scans(d), ("points", points), ("corners", pages.ordered_corners.text(d, "points")), ("crops", crops), ("q", f"select v.*, {', '.join(f'c.{n}_{a}' for n in ('tl', 'tr', 'br', 'bl') for a in 'xy')} from ({pages.quad_verdicts.text(d, 'corners', 'crops')}) as v join corners as c on v.sample_id = c.sample_id")]


@plan
def page_variant_choice(d):
    """The page variant to read, with as many tried as needed."""
    rows = f"select sample_id, case vi when 0 then 'enhanced' when 1 then 'color' else 'grayscale' end as variant, case when (k + vi) % 7 = 0 then 'error' else 'success' end as status, cast((k * 3 + vi * 5) % 12 as bigint) as text_count, case when (k + vi) % 5 <> 0 then {d.num(0.6)} + cast((k + vi * 13) % 40 as double) / 100 end as mean_confidence from (select * from sample{d.each('0', '2', 'vi')}) as q where not (k % 11 = 3 and vi = 1)"
    return [*scans(d), ("results", rows), ("q", fields.page_variants.text(d, "results"))]


@plan
def page_gate(d):
    """Verdicts on pages, by geometry or by looking again at all turns."""

    def detections(angle: int, page: str, zone: str) -> str:
        x = lambda c, n: f"{d.num(n)} + cast((k + {angle}) % 9 as double) as {c}"
        part = lambda p, when, box: ", ".join(f"case when {when} then {d.num(n)} + cast((k * {i + 2} + {angle}) % {m} as double) end as {p}_{c}" for i, (c, n, m) in enumerate(zip(("x1", "y1", "x2", "y2"), box, (9, 7, 40, 60))))
        return f"select sample_id, cast({angle} as bigint) as angle, {d.num(800)} as width, {d.num(600)} as height, {part('p', page, (40, 30, 700, 420))}, {part('z', zone, (60, 330, 650, 380))}, case when {page} then {d.num(0.5)} + cast((k + {angle}) % 40 as double) / 100 end as pc, case when {zone} then {d.num(0.4)} + cast((k * 3 + {angle}) % 50 as double) / 100 end as zc from sample"

    more = " union all ".join(detections(a, f"(k + {i}) % 5 > 2", f"(k + {i}) % 7 = 0") for i, a in enumerate((90, 180, 270)))
    return [*scans(d), ("found", detections(0, "k % 3 > 0", "k % 4 > 0")), ("retried", more), ("q", pages.gate.text(d, "found", "retried"))]


@plan
def selected_recognitions(d):
    """The chosen variant of each sample joined with its recognised lines; samples without a choice stay."""
    return [*mrz_table(d), ("q", "select s.sample_id, c.selected_variant, c.candidate_score, l.line_1, l.line_2, l.confidence from sample as s left join chosen as c on s.sample_id = c.sample_id left join lines as l on l.sample_id = c.sample_id and l.variant = c.selected_variant")]


@plan
def anchor_reach(d):
    """How many rows each verified anchor reaches, one of them unknown."""
    more = f"select suggested_id from anchors union all select 'id_of_nobody' as suggested_id"
    return [*annotated(d), ("asked", more), ("q", identity.propagation_counts.text(d, "queue", "asked"))]


@plan
def unseen_expansion(d, dev=20, holdout=10):
    """New identities only: unseen groups, a stratified choice of as many as development and holdout need, the holdout, and the queue of both."""
    short = f"(select count(*) from picked_ids) < {dev + holdout}"
    return [
        *risky(d), *truth_rows(d), ("new_ids", identity.unseen.text(d, "risky", "truth")), ("fresh_rows", "select r.* from risky as r join new_ids as u on r.suggested_id = u.suggested_id"),
        ("groups_", identity.identity_groups.text(d, "fresh_rows")), ("picked_ids", identity.selected.text(d, "groups_", target=dev + holdout)), ("held", identity.holdout.text(d, "picked_ids", count=holdout)),
        ("queue", identity.annotation_queue.text(d, "picked_ids", "fresh_rows")),
        ("q", f"select q.sample_id, q.suggested_id, q.difficulty, q.is_anchor, q.position, case when h.in_holdout then 'holdout2' else 'dev2' end as split, case when {short} then 'too few unseen identities' end as error from queue as q join held as h on q.suggested_id = h.suggested_id"),
    ]


@plan
def benchmark_suite(d):
    """The whole evaluation as one table of metrics: fitness of the truth, accuracy by field and split, failures by category, size of the bundle."""
    rows = [
        ("truth_problem", f"select problem as name, cast(count(*) as double) as value from ({audit.truth_problems.text(d, 'truth')}) as q group by problem"),
        ("field_accuracy", f"select field as name, accuracy as value from ({evaluation.field_accuracy.text(d, 'compared')}) as q"),
        ("split", f"select split || ':' || level || ':' || metric as name, accuracy as value from ({evaluation.split_metrics.text(d, 'compared', 'votes')}) as q"),
        ("failure", f"select failure_category as name, cast(count(*) as double) as value from failed group by failure_category"),
        ("bundle", f"select 'samples' as name, cast(count(*) as double) as value from ({evaluation.review_bundle.text(d, 'failed', most=200)}) as q"),
    ]
    every = " union all ".join(f"select '{part}' as part, name, {d.rounded('value', 9)} as value from ({text}) as q" for part, text in rows)
    return [*failed(d), ("votes", evaluation.identity_votes.text(d, "compared")), ("q", every)]


def nested(d) -> str:
    """Results of a recogniser as JSON, nested in different ways, with scores or boxes missing here and there."""
    box = "'[' || k % 90 || ',' || v || ',' || (k % 90 + 50) || ',' || (v + 20) || ']'"
    poly = "'[[' || k % 90 || ',5],[120,' || v || '],[130,40],[' || k % 70 || ',44]]'"
    texts, scores = "'\"rec_texts\":[\"' || surname || '\",\"' || given || '\",\"é q\"]'", "case when k % 4 = 0 then '' else ',\"rec_scores\":[0.5,' || case when k % 3 = 0 then 'null' else '0.25' end || ']' end"
    boxes = f"case k % 3 when 0 then '' when 1 then ',\"rec_boxes\":[' || {box} || ',' || {box} || ']' else ',\"rec_polys\":[' || {poly} || ']' end"
    inner = f"'{{' || {texts} || {scores} || {boxes} || '}}'"
    text = f"select sample_id, case k % 5 when 0 then '{{\"res\":{{\"a\":[1,' || nest || ']}}}}' when 1 then nest when 2 then '[[' || nest || ']]' when 3 then '{{\"none\":1}}' else '{{\"x\":null,\"data\":{{\"y\":{{}},\"z\":' || nest || '}}}}' end as result from (select *, {inner} as nest from sample) as q"
    # braces name tables in a plan's text
    return text.replace("{", "' || chr(123) || '").replace("}", "' || chr(125) || '")


def ocr_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts, scores and boxes found at any depth of recogniser results."""
    from leafmill.operators.recognition import items_of

    return items_of(query(lambda d: [*scans(d), ("q", nested(d))])(spark, sf_dir))


QUERIES["ocr_items"] = ocr_items


def ocr_items_sql() -> str:
    """The same in SQL, by the paths at which the synthetic results hold their items."""
    from leafmill.functions.dialect import DUCK, chain

    at = lambda key: f"json_extract(j, '$.rec_{key}[' || i || ']')"
    corner = lambda f, n, axis: f"coalesce(cast(json_extract({at('boxes')}, '$[{n}]') as double), {f}([cast(x as double) for x in json_extract({at('polys')}, '$[*][{axis}]')]))"
    cols = ", ".join(f"{corner(f, n, axis)} as {c}" for c, f, n, axis in (("x1", "list_min", 0, 0), ("y1", "list_min", 1, 1), ("x2", "list_max", 2, 0), ("y2", "list_max", 3, 1)))
    place = "case when result like '{\"res\"%' then '$.res.a[1]' when result like '{\"rec%' then '$' when result like '[[%' then '$[0][0]' else '$.data.z' end"
    steps = [*scans(DUCK), ("raw", nested(DUCK)), ("tree", f"select sample_id, json_extract(result, {place}) as j from raw"), ("each", "select sample_id, j, i from tree, unnest(range(0, cast(json_array_length(j, '$.rec_texts') as bigint))) as u(i)")]
    return chain(DUCK, *steps, ("q", f"select sample_id, cast(i as bigint) as pos, json_extract_string(j, '$.rec_texts[' || i || ']') as text, try_cast(json_extract_string(j, '$.rec_scores[' || i || ']') as double) as confidence, {cols} from each"))


ORACLES["ocr_items"] = ocr_items_sql()
