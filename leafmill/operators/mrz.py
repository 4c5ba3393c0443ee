"""Machine-readable zones: cleaning, parsing, check digits, learnt repair, row assembly and choice of variants."""

from __future__ import annotations

from leafmill.functions import scalars as S
from leafmill.functions.dialect import operator

#: Character pairs that recognition confuses; fixed values.
CONFUSED = {"0": "O", "O": "0", "1": "I", "I": "1", "2": "Z", "Z": "2", "5": "S", "S": "5", "6": "G", "G": "6", "8": "B", "B": "8"}
#: check: text that it covers, its length, the digit's place (from 1) in line 2; fixed by the document standard.
CHECKS = {
    "passport_number": ("substr({l}, 1, 9)", 9, 10),
    "birth_date": ("substr({l}, 14, 6)", 6, 20),
    "expiry_date": ("substr({l}, 22, 6)", 6, 28),
    "personal_number": ("substr({l}, 29, 14)", 14, 43),
    "final": ("(substr({l}, 1, 10) || substr({l}, 14, 7) || substr({l}, 22, 22))", 39, 44),
}


def expected(d, name: str, line: str) -> str:
    text, n, at = CHECKS[name]
    value, digit = text.format(l=line), f"substr({line}, {at}, 1)"
    return f"case when {d.matches(digit, '^[0-9]$')} then {d.text(f'({d.weights(value, n)} % 10)')} end"


def illegal(d, line: str) -> str:
    """Whether a character that some check examines is none of the alphabet."""
    one = lambda t, at: f"({d.matches(f'substr({line}, {at}, 1)', '^[0-9]$')} and {d.matches(t.format(l=line), '[^0-9A-Z<]')})"
    return "(" + " or ".join(one(t, at) for t, _, at in CHECKS.values()) + ")"


def checked_columns(d, lines: str) -> str:
    """Text of the lines with expected digits, validity and status; what several columns need is computed once, in an inner select."""
    sized = f"select *, length(line_1) = 44 and length(line_2) = 44 as sized__, {illegal(d, 'line_2')} as illegal__ from {lines}"
    digits = ", ".join(f"case when sized__ and not illegal__ then {expected(d, name, 'line_2')} end as {name}_expected_digit" for name in CHECKS)
    valid = ", ".join(f"{name}_expected_digit = substr(line_2, {at}, 1) as {name}_check_valid" for name, (_, _, at) in CHECKS.items())
    status = "case when not coalesce(sized__, false) then 'skipped_invalid_length' when illegal__ then 'error' else 'success' end as validation_status"
    drop = "* exclude (sized__, illegal__)" if d.name == "duckdb" else "* except (sized__, illegal__)"
    return f"select {drop}, {valid}, {status} from (select *, {digits} from ({sized}) as q) as q"


#: All of the main checks; unknown as soon as one is.
MAIN = "case when passport_number_check_valid is null or birth_date_check_valid is null or expiry_date_check_valid is null or final_check_valid is null then null else passport_number_check_valid and birth_date_check_valid and expiry_date_check_valid and final_check_valid end"


@operator
def validated(d, lines):
    """Check digits of line_1 and line_2: expected digits, validity of five checks, status, and all_main_checks_valid."""
    return f"select *, {MAIN} as all_main_checks_valid from ({checked_columns(d, lines)}) as q"


@operator
def cleaned(d, lines):
    """Both lines cleaned, with the pieces that parsing and profiles use."""
    l1, l2 = S.clean_line(d, "line_1"), S.clean_line(d, "line_2")
    inner = f"select sample_id, variant, {l1} as line_1, {l2} as line_2, {S.clean_piece(d, 'line_2')} as piece from {lines}"
    ppn = "rtrim(substr(line_2, 1, 9), '<')" if d.name == "duckdb" else "rtrim('<', substr(line_2, 1, 9))"
    return f"""select *, {ppn} as passport_value, {S.pattern(d, ppn)} as passport_pattern, replace({S.alpha_corrected(d, 'substr(line_1, 3, 3)')}, '<', '') as issuer_code,
        replace({S.alpha_corrected(d, 'substr(line_2, 11, 3)')}, '<', '') as nationality_code from ({inner}) as q"""


@operator
def parsed(d, lines, *, strict=True, today="2026-01-01"):
    """Two lines of 44 characters to typed fields. Strict: other lengths are an error and blank the fields; else lines are cut or filled up."""
    ok = "(length(line_1) = 44 and length(line_2) = 44)" if strict else "(line_1 is not null and line_2 is not null)"
    a, b = "rpad(left(line_1, 44), 44, '<')", "rpad(left(line_2, 44), 44, '<')"
    fields = {
        "document_type": S.unfilled(d, "substr(a, 1, 2)"), "issuing_country": S.unfilled(d, S.alpha_corrected(d, "substr(a, 3, 3)")),
        "surname": S.surname_part(d, "substr(a, 6, 39)"), "given_names": S.given_part(d, "substr(a, 6, 39)"),
        "passport_number": S.unfilled(d, "substr(b, 1, 9)"), "nationality": S.unfilled(d, S.alpha_corrected(d, "substr(b, 11, 3)")),
        "birth_date_raw": "substr(b, 14, 6)", "date_of_birth": d.iso(S.birth_date(d, "b", today)), "sex": S.unfilled(d, "substr(b, 21, 1)"),
        "expiry_date_raw": "substr(b, 22, 6)", "date_of_expiry": d.iso(S.expiry_date(d, "e", today)), "personal_number": S.unfilled(d, "substr(b, 29, 14)"),
    }
    digits = {"passport_number_check_digit": 10, "birth_date_check_digit": 20, "expiry_date_check_digit": 28, "personal_number_check_digit": 43, "final_check_digit": 44}
    cols = [f"case when ok then {x} end as {k}" for k, x in fields.items()] + [f"case when ok then substr(b, {i}, 1) end as {k}" for k, i in digits.items()]
    status = "case when line_1 is null or line_2 is null then 'not_parsed' when ok then 'success' else 'error' end"
    mode = "case when line_1 is null or line_2 is null then null when length(line_1) = 44 and length(line_2) = 44 then 'strict_44_44' when ok then 'padded_or_truncated' end"
    return f"select sample_id, variant, {status} as parse_status, {mode} as parse_mode, {', '.join(cols)} from (select *, {S.centuries(d, 'substr(b, 14, 6)', 'b')}, {S.centuries(d, 'substr(b, 22, 6)', 'e')} from (select *, {a} as a, {b} as b, coalesce({ok}, false) as ok from {lines}) as q) as q"


#: Stray characters before the P< of line 1.
SHIFT = "case when length(line_1) = 44 and left(line_1, 1) = 'P' then 0 when substr(line_1, 2, 2) = 'P<' then 1 when substr(line_1, 3, 2) = 'P<' then 2 else 0 end"


@operator
def prefix_repaired(d, lines):
    """Line 1 with one or two stray characters before its P< cut off, and the name of the repair."""
    return f"""select sample_id, variant, case when cut > 0 then rpad(left(substr(line_1, cut + 1), 44), 44, '<') else line_1 end as line_1, line_2,
        case when cut > 0 then 'line1_prefix_trim_' || {d.text('cut')} end as prefix_repair from (select *, {SHIFT} as cut from {lines}) as q"""


@operator
def format_profiles(d, checked):
    """Verified records by issuer and pattern of the passport number: how often each occurs."""
    issuer = f"replace({S.alpha_corrected(d, 'substr(line_1, 3, 3)')}, '<', '')"
    value = "rtrim(substr(line_2, 1, 9), '<')" if d.name == "duckdb" else "rtrim('<', substr(line_2, 1, 9))"
    inner = f"select {issuer} as issuer, {S.pattern(d, value)} as pattern from {checked} where all_main_checks_valid"
    return f"select issuer, pattern, cast(count(*) as bigint) as n from ({inner}) as q where {d.matches('issuer', '^[A-Z][A-Z][A-Z]$')} and instr(pattern, '?') = 0 group by issuer, pattern"


@operator
def dominant_patterns(d, profiles, *, least=3, share=0.6):
    """The leading pattern of an issuer with enough verified records and a large enough share."""
    inner = f"select *, sum(n) over (partition by issuer) as total, row_number() over (partition by issuer order by n desc, pattern) as r from {profiles}"
    return f"select issuer, pattern, n, cast(total as bigint) as total from ({inner}) as q where r = 1 and total >= {least} and cast(n as double) / total >= {d.num(share)}"


@operator
def checksum_repaired(d, checked, patterns):
    """One confused character of a passport number put right, where check digits and the issuer's pattern allow one line only."""
    swap = f"translate(substr(line_2, i, 1), '{''.join(CONFUSED)}', '{''.join(CONFUSED.values())}')"
    issuer = f"replace({S.alpha_corrected(d, 'substr(line_1, 3, 3)')}, '<', '')"
    tried = f"""select sample_id, variant, i, substr(line_2, i, 1) as old, {swap} as new, pattern, line_1,
        substr(line_2, 1, i - 1) || {swap} || substr(line_2, i + 1) as fixed
        from (select c.*, p.pattern from {checked} as c join {patterns} as p on {issuer} = p.issuer where not c.passport_number_check_valid) as q{d.each('1', '9', 'i')}"""
    ok = lambda name: f"{expected(d, name, 'fixed')} = substr(fixed, {CHECKS[name][2]}, 1)"
    value = "rtrim(substr(fixed, 1, 9), '<')" if d.name == "duckdb" else "rtrim('<', substr(fixed, 1, 9))"
    good = f"select * from ({tried}) as q where old <> new and {ok('passport_number')} and {ok('final')} and {S.pattern(d, value)} = pattern"
    return f"""select sample_id, variant, min(fixed) as repaired_line_2, 'passport_checksum_pattern:' || {d.text('min(i) - 1')} || ':' || min(old) || '>' || min(new) as repair
        from ({good}) as q group by sample_id, variant having count(distinct fixed) = 1"""


@operator
def nationality_recovered(d, checked):
    """A damaged nationality taken from a variant that agrees with the issuer at one character's distance; the best supported one, no ties."""
    issuer = f"replace({S.alpha_corrected(d, 'substr(line_1, 3, 3)')}, '<', '')"
    nat = lambda t: f"replace({S.alpha_corrected(d, f'substr({t}.line_2, 11, 3)')}, '<', '')"
    seen = f"select {nat('c')} as code, cast(count(*) as bigint) as freq from {checked} as c where c.all_main_checks_valid group by 1"
    need = f"select c.sample_id, c.variant, {issuer} as issuer, substr(c.line_2, 11, 3) as raw from {checked} as c where not coalesce(c.all_main_checks_valid, false) and length(c.line_2) = 44 and length({issuer}) = 3 and {nat('c')} <> {issuer}"
    give = f"""select n.sample_id, n.variant, substr(o.line_2, 11, 3) as code, cast(count(*) as bigint) as supporters, max(s.freq) as freq
        from ({need}) as n join {checked} as o on n.sample_id = o.sample_id join ({seen}) as s on s.code = n.issuer
        where length(o.line_2) = 44 and {nat('o')} = n.issuer and {S.hamming3(d, 'n.raw', 'substr(o.line_2, 11, 3)')} <= 1 group by n.sample_id, n.variant, substr(o.line_2, 11, 3)"""
    ranked = f"select *, rank() over (partition by sample_id, variant order by supporters desc, freq desc) as r from ({give}) as q"
    return f"select sample_id, variant, min(code) as code, min(supporters) as supporters from ({ranked}) as q where r = 1 group by sample_id, variant having count(*) = 1"


@operator
def repaired(d, lines, fixes, codes):
    """Lines with their repairs applied, and the names of the repairs."""
    line = f"coalesce(f.repaired_line_2, case when c.code is not null then substr(l.line_2, 1, 10) || c.code || substr(l.line_2, 14) end, l.line_2)"
    names = d.joined(d.keep(d.array("l.prefix_repair", "f.repair", "case when f.repair is null and c.code is not null then 'nationality_variant:' || c.code end")), " | ")
    return f"""select l.sample_id, l.variant, l.line_1, {line} as line_2, {names} as repair_methods from {lines} as l
        left join {fixes} as f on l.sample_id = f.sample_id and l.variant = f.variant left join {codes} as c on l.sample_id = c.sample_id and l.variant = c.variant"""


@operator
def candidate_scores(d, checked):
    """Score of each recognised variant and whether it is strong."""
    valid = " + ".join(f"case when {c}_check_valid then 35 when not {c}_check_valid then -12 else 0 end" for c in CHECKS)
    n = "(case when coalesce(line_1, '') <> '' then 1 else 0 end + case when coalesce(line_2, '') <> '' then 1 else 0 end)"
    score = f"""case when {n} = 0 then cast(-1000 as double) else case when {n} = 2 then 100 else -30 * abs({n} - 2) end
        - 3 * abs(coalesce(length(line_1), 44) - 44) - 3 * abs(coalesce(length(line_2), 44) - 44) - {d.num(0.5)} * abs(coalesce(length(line_1), 0) + coalesce(length(line_2), 0) - 88)
        + case when length(line_1) = 44 and length(line_2) = 44 then 120 else 0 end + case when assembly_method = 'geometry_two_rows' then 12 else 0 end + 20 * confidence + {valid}
        + case when final_check_valid then 60 else 0 end + case when all_main_checks_valid then 180 else 0 end end"""
    strong = "coalesce(length(line_1) = 44 and length(line_2) = 44 and all_main_checks_valid, false)"
    return f"select sample_id, variant, vi, {d.rounded(score, 6)} as candidate_score, {strong} as strong from {checked}"


@operator
def best_variants(d, scores):
    """The best variant of a sample among those up to the first strong one; the first wins ties."""
    seen = f"select *, coalesce(max(case when strong then 1 else 0 end) over (partition by sample_id order by vi rows between unbounded preceding and 1 preceding), 0) as stopped from {scores}"
    ranked = f"select *, row_number() over (partition by sample_id order by candidate_score desc, vi) as r, cast(count(*) over (partition by sample_id) as bigint) as attempted from ({seen}) as q where stopped = 0"
    return f"select sample_id, variant as selected_variant, candidate_score, strong, attempted from ({ranked}) as q where r = 1"


@operator
def rows_from_items(d, items, *, gap=0.35, least=20):
    """Two rows of a zone from boxed fragments (sample_id, pos, text, x1, y1, x2, y2): cut at the largest gap of centres, joined from left to right;
    where that fails, fragments in text order: two as they are, else the joined text from 80 characters on, cut as near to 44 and 44 as can be."""
    base = f"select sample_id, pos, {S.clean_piece(d, 'text')} as piece, x1, (y1 + y2) / 2 as cy, greatest(y2 - y1, cast(1 as double)) as h from {items} where x1 is not null"
    gaps = f"select *, cy - lag(cy) over (partition by sample_id order by cy, pos) as gap, row_number() over (partition by sample_id order by cy, pos) as r from ({base}) as q where piece <> ''"
    cut = f"select sample_id, median(h) as h, max(gap) as gap from ({gaps}) as q group by sample_id"
    at = f"select g.sample_id, min(g.r) as at from ({gaps}) as g join ({cut}) as c on g.sample_id = c.sample_id and g.gap = c.gap where c.gap >= greatest(cast(2 as double), {d.num(gap)} * c.h) group by g.sample_id"
    side = f"select g.sample_id, case when g.r < a.at then 1 else 2 end as line, g.x1, g.pos, g.piece from ({gaps}) as g join ({at}) as a on g.sample_id = a.sample_id"
    key = "x1 * 1000 + pos"
    lines = f"select sample_id, {d.joined(d.collected('case when line = 1 then piece else ' + repr('') + ' end', key), '')} as line_1, {d.joined(d.collected('case when line = 2 then piece else ' + repr('') + ' end', key), '')} as line_2 from ({side}) as q group by sample_id"
    texts = f"select sample_id, {d.joined(d.collected('piece', 'pos'), '')} as joined, cast(count(*) as bigint) as n, min(case when pr = 1 then piece end) as first, min(case when pr = 2 then piece end) as second from (select *, row_number() over (partition by sample_id order by pos) as pr from ({base}) as q where piece <> '') as q group by sample_id"
    cut_at = "case when length(joined) >= 88 then 44 else length(joined) - 44 end"
    return f"""select t.sample_id, case when g then l.line_1 when t.n = 2 then t.first when length(joined) >= 80 then left(joined, {cut_at}) else t.first end as line_1,
        case when g then l.line_2 when t.n = 2 then t.second when length(joined) >= 80 then substr(joined, {cut_at} + 1) else t.second end as line_2,
        case when g then 'geometry_two_rows' else 'text_order_fallback' end as assembly_method
        from ({texts}) as t left join (select *, length(line_1) >= {least} and length(line_2) >= {least} as g from ({lines}) as q) as l on t.sample_id = l.sample_id"""
