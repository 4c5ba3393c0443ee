"""Geometry of page and zone detections: turns of a page and how upright each looks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F, types as T

from leafmill.functions import scalars as S
from leafmill.functions.dialect import operator

ANGLES = (0, 90, 180, 270)


def upright(d) -> str:
    """Score of page box p and zone box z of one turn, with confidences pc and zc; a zone may be missing, a page may not."""
    pw, ph, zw, zh = S.width("p"), S.height("p"), S.width("z"), S.height("z")
    ratio, flat = f"({pw} / {ph})", f"({zw} / {zh})"
    x, y = S.center("z", "x"), S.center("z", "y")
    page = f"case when {ratio} >= {d.num(1.1)} then {d.num(65)} else -{d.num(65)} end + {d.num(10)} * least({ratio}, {d.num(2.5)}) + {d.num(5)} * coalesce(pc, {d.num(0)})"
    zone = f"""case when {flat} >= {d.num(2)} then {d.num(65)} else -{d.num(65)} end + {d.num(4)} * least({flat}, {d.num(10)}) + {d.num(5)} * coalesce(zc, {d.num(0)})
        + case when {y} > {S.center('p', 'y')} then {d.num(70)} else -{d.num(70)} end + greatest(-{d.num(70)}, {d.num(70)} - {d.num(180)} * abs(({y} - p.y1) / {ph} - {d.num(0.82)}))
        + {d.num(35)} * least(greatest({zw} / {pw}, {d.num(0)}), {d.num(1)}) + greatest(-{d.num(25)}, {d.num(25)} - {d.num(70)} * abs(({x} - p.x1) / {pw} - {d.num(0.5)}))
        + case when {x} between p.x1 and p.x2 and {y} between p.y1 and p.y2 then {d.num(20)} else -{d.num(30)} end"""
    return f"case when p.x1 is null then -{d.num(10000)} else {page} + case when z.x1 is null then {d.num(0)} else {zone} end end"


@operator
def orientations(d, detections):
    """Score of each of four turns of a detected page: sample_id, angle, score. Detections: width, height, page and zone boxes (p_, z_), pc, zc."""
    def turn(angle: int) -> str:
        make = lambda p: d.struct(**dict(zip(("x1", "y1", "x2", "y2"), S.rotated(angle, "width", "height", p))))
        return f"select sample_id, cast({angle} as bigint) as angle, {make('p_')} as p, {make('z_')} as z, pc, zc from {detections}"

    return f"select sample_id, angle, {d.rounded(upright(d), 6)} as score, pc, zc from ({' union all '.join(turn(a) for a in ANGLES)}) as q"


@operator
def best_orientation(d, scores):
    """The best turn by score and confidences; the first wins ties."""
    ranked = f"select *, row_number() over (partition by sample_id order by score desc, pc desc, zc desc, angle) as r from {scores}"
    return f"select sample_id, angle, score from ({ranked}) as q where r = 1"


@operator
def gate(d, found, retried):
    """The verdict on a page: status, reason, turn and whether the page was looked at again. A page with page and zone is turned by geometry; else the detections of all
    turns are asked, those with both first, then those with a page only. Both tables: sample_id, angle, width, height, p_x1.., z_x1.., pc, zc; found has angle 0."""
    at0 = f"(select sample_id, width, height, {', '.join(f'{p}_{c}' for p in 'pz' for c in ('x1', 'y1', 'x2', 'y2'))}, pc, zc from {found} where p_x1 is not null and z_x1 is not null)"
    turned = f"select sample_id, angle, score, pc, zc from ({orientations.text(d, at0)}) as q"
    struct = lambda p: d.struct(**{c: f"{p}_{c}" for c in ("x1", "y1", "x2", "y2")})
    again = f"select *, p_x1 is not null and z_x1 is not null as both_found, p_x1 is not null as page_found from (select * from {found} union all select * from {retried}) as q"
    seen = f"select sample_id, angle, both_found, page_found, pc, zc, {d.rounded(upright(d), 6)} as score from (select *, {struct('p')} as p, {struct('z')} as z from ({again}) as q where sample_id not in (select sample_id from {at0} as a)) as q"
    first = "row_number() over (partition by sample_id order by {}) as r"
    fast = f"select sample_id, 'passport_confirmed' as status, 'mrz_geometry_orientation' as reason, angle, angle <> 0 as retried from (select *, {first.format(f'score desc, coalesce(pc, {d.num(0)}) desc, coalesce(zc, {d.num(0)}) desc, angle')} from ({turned}) as q) as q where r = 1"
    # without a zone its confidence tells nothing, and the first turn wins
    slow = f"select *, {first.format(f'both_found desc, page_found desc, case when page_found then score end desc, coalesce(pc, {d.num(0)}) desc, case when both_found then coalesce(zc, {d.num(0)}) else 0 end desc, angle')} from ({seen}) as q"
    told = """select sample_id, case when both_found then 'passport_confirmed' when page_found then 'passport_candidate' else 'no_passport_evidence' end as status,
        case when both_found then 'orientation_retry_mrz_geometry' when page_found then 'passport_detected_without_mrz' else 'no_passport_detected_any_orientation' end as reason,
        case when page_found then angle end as angle, both_found or not page_found or angle <> 0 as retried"""
    return f"select * from ({fast}) as a union all select * from ({told} from ({slow}) as q where r = 1) as b"


@operator
def ordered_corners(d, points):
    """Four points of a page as corners: least and largest sum of coordinates are top left and bottom right, least and largest y - x top right and bottom left; the first of equals. Points: sample_id, i, x, y."""
    rank = lambda by, name: f"row_number() over (partition by sample_id order by {by}, i) as {name}"
    ranked = f"select *, {rank('x + y', 'tl')}, {rank('y - x', 'tr')}, {rank('x + y desc', 'br')}, {rank('y - x desc', 'bl')} from {points}"
    return f"select sample_id, {', '.join(f'max(case when {c} = 1 then {a} end) as {c}_{a}' for c in ('tl', 'tr', 'br', 'bl') for a in 'xy')} from ({ranked}) as q group by sample_id"


#: Least part of a crop that a page fills, how far its edges may lie inside, and how much of a zone it holds; fixed values.
LEAST_AREA, EDGE, LEAST_INSIDE = 0.72, 0.18, 0.95


@operator
def quad_verdicts(d, corners, crops):
    """Why a page's corners are not to be trusted, or 'valid'. Crops: sample_id, width, height, inside (the part of the zone within the corners, null without a zone), zone_y2."""
    ring = ("tl", "tr", "br", "bl")
    area = f"abs({' + '.join(f'{a}_x * {b}_y - {b}_x * {a}_y' for a, b in zip(ring, ring[1:] + ring[:1]))}) / 2 / (width * height)"
    part = lambda x: d.text(d.rounded(x, 3))
    reason = f"""case when area < {d.num(LEAST_AREA)} then 'quad_area_too_small' when least(tl_x, bl_x) > width * {d.num(EDGE)} then 'left_edge_too_far_inside' when greatest(tr_x, br_x) < width * {d.num(1 - EDGE)} then 'right_edge_too_far_inside'
        when least(tl_y, tr_y) > height * {d.num(EDGE)} then 'top_edge_too_far_inside' when greatest(bl_y, br_y) < height * {d.num(1 - EDGE)} then 'bottom_edge_too_far_inside'
        when inside < {d.num(LEAST_INSIDE)} then 'mrz_not_fully_inside' when inside is not null and greatest(bl_y, br_y) < zone_y2 - height * {d.num(0.02)} then 'quad_ends_above_mrz' else 'valid' end"""
    return f"select sample_id, {d.rounded('area', 6)} as area_ratio, {reason} as verdict from (select q.*, c.width, c.height, c.inside, c.zone_y2, {area} as area from {corners} as q join {crops} as c on q.sample_id = c.sample_id) as q"


def clipped_area(corners: list[tuple[float, float]], box: tuple[float, float, float, float]) -> float:
    """Area of the part of a convex polygon within a box: the polygon is cut along the box's four lines."""
    ring = list(corners)
    for axis, line, side in ((0, box[0], 1), (0, box[2], -1), (1, box[1], 1), (1, box[3], -1)):
        out = []
        for a, b in zip(ring, ring[1:] + ring[:1]):
            u, v = side * (a[axis] - line), side * (b[axis] - line)
            if u >= 0:
                out.append(a)
            if u * v < 0:
                t = u / (u - v)
                out.append((a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))
        ring = out
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2


@F.pandas_udf(T.DoubleType())
def inside_ratio(corners: pd.Series, boxes: pd.Series) -> pd.Series:
    """The part of each box (x1, y1, x2, y2) that lies within a polygon (x and y by turns, in order); null without a box, 0 for an empty one."""

    def one(c, b):
        if b is None or c is None:
            return None
        size = (b[2] - b[0]) * (b[3] - b[1])
        return clipped_area(list(zip(c[::2], c[1::2])), tuple(b)) / size if b[2] > b[0] and b[3] > b[1] else 0.0

    return pd.Series([one(c, b) for c, b in zip(corners, boxes)], dtype="float64")
