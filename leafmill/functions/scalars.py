"""Scalar expressions: coercion, text, dates, boxes. Each takes the dialect first and gives SQL text."""

from __future__ import annotations

# --- coercion ---------------------------------------------------------------------------------------------------------


def empty_to_null(d, x):
    return f"case when lower(trim({x})) in ('', 'none', 'nan', 'null') then null else trim({x}) end"


def tri_state(d, x, yes=("true",), no=("false",)):
    """Fusion reads true and false; dates of issue and sampling pass their own words."""
    words = lambda v: ", ".join(f"'{w}'" for w in v)
    return f"case when lower(trim({x})) in ({words(yes)}) then true when lower(trim({x})) in ({words(no)}) then false end"


def as_double(d, x):
    return d.number(empty_to_null(d, x))


def as_whole(d, x):
    return d.whole(as_double(d, x))


# --- text -------------------------------------------------------------------------------------------------------------

#: A run of white space, of any script; the characters stand for themselves, so that both engines read them alike.
BLANKS = "[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def accented() -> tuple[str, str]:
    """Latin letters with marks, and the letters that decomposition leaves of them."""
    import unicodedata

    plain = {c: "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)])}
    pairs = [(c, x) for c, x in plain.items() if len(x) == 1 and x != c and x.isascii()]
    return "".join(c for c, _ in pairs), "".join(x for _, x in pairs)


MARKED, UNMARKED = accented()


def clean_line(d, x):
    """A recognised line for parsing: upper case, no spaces, quotation glyphs read as fillers."""
    return f"translate(replace(upper(trim({x})), ' ', ''), '«‹＜', '<<<')"


def clean_piece(d, x):
    """A recognised piece for row assembly: only characters of the alphabet stay."""
    return d.replaced(clean_line(d, x), "[^A-Z0-9<]", "")


def unfilled(d, x):
    return f"trim({d.replaced(x, '<+', ' ')})"


def alpha_corrected(d, x):
    return f"translate({x}, '012568', 'OIZSGB')"


def surname_part(d, x):
    return unfilled(d, alpha_corrected(d, f"case when instr({x}, '<<') > 0 then substr({x}, 1, instr({x}, '<<') - 1) else {x} end"))


def given_part(d, x):
    return unfilled(d, alpha_corrected(d, f"case when instr({x}, '<<') > 0 then substr({x}, instr({x}, '<<') + 2) else '' end"))


def squeezed(d, x):
    return f"trim({d.replaced(x, BLANKS, ' ')})"


def unaccented(d, x):
    return f"translate({x}, '{MARKED}', '{UNMARKED}')"


def value_trimmed(d, x):
    return d.replaced(squeezed(d, x), "^[ |/:;,-]+|[ |/:;,-]+$", "")


def short_hash(d, x, n=12):
    return f"left({d.sha256(x)}, {n})"


def pattern(d, x):
    return d.replaced(d.replaced(d.replaced(x, "[^A-Z0-9]", "?"), "[A-Z]", "A"), "[0-9]", "9")


def hamming(d, a, b):
    """Differing places of two texts of one length; 999 for other lengths."""
    return f"case when length({a}) = length({b}) then {d.differing(a, b)} else 999 end"


def hamming3(d, a, b):
    """Differing places of two codes of three characters; 999 for other lengths."""
    each = " + ".join(f"case when substr({a}, {i}, 1) <> substr({b}, {i}, 1) then 1 else 0 end" for i in (1, 2, 3))
    return f"case when length({a}) = length({b}) and length({a}) = 3 then {each} else 999 end"


def sex_normal(d, x):
    return f"case when lower(trim({x})) in ('m', 'male') then 'M' when lower(trim({x})) in ('f', 'female') then 'F' when lower(trim({x})) = 'x' then 'X' end"


def passport_normal(d, x):
    y = d.replaced(f"upper({x})", "[^A-Z0-9]", "")
    return f"case when length({y}) between 5 and 12 and {d.matches(y, '[0-9]')} then {y} end"


def name_valid(d, x):
    y = value_trimmed(d, x)
    return f"(length({y}) >= 2 and {d.letters(y)} >= 2 and {slash_date(d, y)} is null)"


def nationality_valid(d, x):
    y = value_trimmed(d, x)
    return f"(length({y}) >= 2 and {d.letters(y)} >= 1 and {slash_date(d, y)} is null)"


def comparable(d, field, x, family):
    """A field's value as its family of comparisons sees it: consistency, evaluation, sampling, audit or expansion."""
    up = squeezed(d, f"upper({x})")
    if family == "consistency":
        bare = unaccented(d, x)
        if field == "passport_number":
            return d.replaced(f"upper({bare})", "[^A-Z0-9]", "")
        if field in ("surname", "given_names", "nationality"):
            return squeezed(d, d.replaced(f"upper({bare})", "[^A-Z0-9]+", " "))
        return f"left(upper(trim({bare})), 1)" if field == "sex" else f"trim({x})"
    if family == "evaluation":
        return f"trim({x})" if field.startswith("date") else up
    if family == "sampling":
        keep = "[^A-Z0-9]" if field == "passport_number" else "[^0-9]" if field.startswith("date") else "[^A-Z]"
        return d.replaced(f"upper({x})", keep, "")
    return up if family == "audit" else d.replaced(f"upper({x})", "[^A-Z0-9]", "")


# --- dates ------------------------------------------------------------------------------------------------------------


def centuries(d, x, p):
    """Columns p19, p20 and p21: the days that six digits mean in each century, null where there is none."""
    six = f"({d.matches(x, '^[0-9]+$')} and length({x}) = 6)"
    return ", ".join(f"case when {six} then {d.date(chr(39) + c + chr(39) + ' || ' + x, 'yyyyMMdd')} end as {p}{c}" for c in ("19", "20", "21"))


def birth_date(d, p, today):
    """Of the columns of centuries() the latest real date up to today."""
    return "coalesce(" + ", ".join(f"case when {p}{c} <= date '{today}' then {p}{c} end" for c in ("21", "20", "19")) + ")"


def expiry_date(d, p, today):
    """Of the columns of centuries() the real date nearest to today; the earlier century wins ties."""
    off = lambda c: f"coalesce(abs({d.days(p + c, f'date {chr(39)}{today}{chr(39)}')}), 999999)"
    return f"case when {off('19')} <= {off('20')} and {off('19')} <= {off('21')} then {p}19 when {off('20')} <= {off('21')} then {p}20 else {p}21 end"


def slash_date(d, x):
    """The first day, month and year with . / or - between them; a year of two digits up to 40 is 20yy."""
    whole = "([0-9][0-9]?)[./-]([0-9][0-9]?)[./-]([0-9][0-9][0-9]?[0-9]?)"
    part = lambda i: f"regexp_extract({x}, '{whole}', {i})"
    y = f"cast({part(3)} as int)"
    year = f"case when length({part(3)}) = 2 then case when {y} <= 40 then 2000 + {y} else 1900 + {y} end else {y} end"
    return f"case when regexp_extract({x}, '{whole}', 0) <> '' then {d.made_date(year, part(2), part(1))} end"


def iso_date(d, x):
    return d.date(x, "yyyy-MM-dd")


def admissible(d, x, birth, expiry, today):
    return f"({d.days(x, f'date {chr(39)}{today}{chr(39)}')} <= 366 and coalesce({x} > {birth}, true) and coalesce({x} < {expiry}, true))"


def validity_bonus(d, x, expiry):
    """How near the years to expiry are to five or ten, with ten more for the same day and month."""
    years = f"(cast({d.days(expiry, x)} as double) / {d.num(365.2425)})"
    gap = f"least(abs({years} - 5), abs({years} - 10))"
    step = f"case when {gap} <= {d.num(0.03)} then 28 when {gap} <= {d.num(0.15)} then 20 when {gap} <= {d.num(0.5)} then 8 else 0 end"
    same = f"case when {gap} <= {d.num(0.15)} and day({x}) = day({expiry}) and month({x}) = month({expiry}) then 10 else 0 end"
    return f"cast(coalesce({step} + {same}, 0) as double)"


def swapped(d, x):
    return f"case when day({x}) <= 12 and day({x}) <> month({x}) then {d.made_date(f'year({x})', f'day({x})', f'month({x})')} end"


# --- boxes (x1, y1, x2, y2 by prefix) -----------------------------------------------------------------------------------


def width(a):
    return f"greatest({a}.x2 - {a}.x1, cast(1 as double))"


def height(a):
    return f"greatest({a}.y2 - {a}.y1, cast(1 as double))"


def center(a, axis):
    return f"(({a}.{axis}1 + {a}.{axis}2) / 2)"


def overlap(a, b):
    return f"(greatest(cast(0 as double), least({a}.x2, {b}.x2) - greatest({a}.x1, {b}.x1)) / least({width(a)}, {width(b)}))"


def field_score(d, a, b):
    """How well value b suits label a on a page: below it or to its right; -1000 elsewhere."""
    h, down, right = height(a), f"({b}.y1 - {a}.y2)", f"({b}.x1 - {a}.x2)"
    below = f"4 + 3 * {overlap(a, b)} - {d.num(0.45)} * greatest(cast(0 as double), {down}) / {h} - {d.num(0.9)} * abs({center(a, 'x')} - {center(b, 'x')}) / greatest({width(a)}, {width(b)})"
    beside = f"{d.num(3.3)} - {d.num(0.25)} * {right} / {h}"
    is_below = f"{down} between -{d.num(0.35)} * {h} and {d.num(4.2)} * {h}"
    is_beside = f"{right} between 0 and {d.num(3.5)} * {h} and abs({center(a, 'y')} - {center(b, 'y')}) <= greatest({h}, {height(b)})"
    none = "cast(-1000 as double)"
    return f"greatest(case when {is_below} then {below} else {none} end, case when {is_beside} then {beside} else {none} end)"


def issue_score(d, a, b):
    """How well date b suits an issue label a: to its right or below; null elsewhere."""
    h, down, right = height(a), f"({b}.y1 - {a}.y2)", f"({b}.x1 - {a}.x2)"
    is_right = f"{right} between -{d.num(0.5)} * {h} and 5 * {h} and abs({center(a, 'y')} - {center(b, 'y')}) <= {d.num(1.25)} * greatest({h}, {height(b)})"
    is_below = f"{down} between -{d.num(0.35)} * {h} and {d.num(4.5)} * {h} and ({overlap(a, b)} >= {d.num(0.1)} or abs({center(a, 'x')} - {center(b, 'x')}) <= greatest({width(a)}, cast(180 as double)))"
    right_score = f"34 - 3 * greatest(cast(0 as double), {right}) / {h}"
    below_score = f"31 - 4 * greatest(cast(0 as double), {down}) / {h} + least(cast(10 as double), 10 * {overlap(a, b)})"
    return f"case when {is_right} then {right_score} when {is_below} then {below_score} end"


def union_box(a, b):
    """x1, y1, x2, y2 around two boxes; of one that is missing, the other."""
    return tuple(f"{'least' if c in ('x1', 'y1') else 'greatest'}(coalesce({a}.{c}, {b}.{c}), coalesce({b}.{c}, {a}.{c}))" for c in ("x1", "y1", "x2", "y2"))


def moved(dx, dy, p=""):
    """x1, y1, x2, y2 of a box as seen from a crop whose corner is at dx, dy."""
    return tuple(f"{p}{c} - {dx if c[0] == 'x' else dy}" for c in ("x1", "y1", "x2", "y2"))


#: Padding of a page, and of a zone across and down, as parts of width and height; fixed values.
PAGE_PADDING, ZONE_PADDING = (0.03, 0.03), (0.015, 0.18)


def padded(d, share, w, h, p=""):
    """x1, y1, x2, y2 of a box with padding in proportion, within an image of width w and height h."""
    x, y = (d.rounded(f"cast(({p}{c}2 - {p}{c}1) * {d.num(s)} as double)", 0) for c, s in zip("xy", share))
    return f"greatest({d.num(0)}, {p}x1 - {x})", f"greatest({d.num(0)}, {p}y1 - {y})", f"least({w}, {p}x2 + {x})", f"least({h}, {p}y2 + {y})"


def rotated(angle, w, h, p=""):
    """x1, y1, x2, y2 of a box (columns with prefix p) after a turn of a page of width w and height h."""
    x1, y1, x2, y2 = (f"{p}{c}" for c in ("x1", "y1", "x2", "y2"))
    if angle == 90:
        return f"{h} - {y2}", x1, f"{h} - {y1}", x2
    if angle == 180:
        return f"{w} - {x2}", f"{h} - {y2}", f"{w} - {x1}", f"{h} - {y1}"
    return (y1, f"{w} - {x2}", y2, f"{w} - {x1}") if angle == 270 else (x1, y1, x2, y2)
