"""Dates and labels in recognised text, over Arrow batches: what needs similarity or matches with offsets."""

from __future__ import annotations

import re
from datetime import date
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F, types as T

from leafmill.functions.similarity import Labels, date_text, label_similarity, label_text, most_ratio, plain, ratio

#: Names of months; fixed values.
MONTHS = {
    1: ["jan", "january", "janvier", "januar"], 2: ["feb", "february", "fevrier", "februar"], 3: ["mar", "march", "mars", "marzo"], 4: ["apr", "april", "avr", "avril", "abril"],
    5: ["may", "mai", "mayo"], 6: ["jun", "june", "juin", "junio", "juni"], 7: ["jul", "july", "juillet", "julio", "juli"], 8: ["aug", "august", "aout", "agosto"],
    9: ["sep", "sept", "september", "septembre"], 10: ["oct", "october", "octobre", "octubre", "okt"], 11: ["nov", "november", "novembre", "noviembre"], 12: ["dec", "december", "decembre", "diciembre", "dez"],
}
#: Misread month names; fixed values.
MISREAD = {"0ct": "oct", "oet": "oct", "n0v": "nov", "noy": "nov", "nar": "mar"}
#: Labels of a date of issue and of other dates; fixed values.
ISSUE_LABELS = [
    "date of issue", "issue date", "date issued", "date of issuance", "issuing date", "iss date", "iss. date", "date de delivrance", "date de délivrance", "date d emission", "date d'émission", "fecha de expedicion",
    "fecha de expedición", "fecha de emision", "fecha de emisión", "data di rilascio", "data wydania", "ausstellungsdatum", "datum van afgifte", "isavimo data", "išdavimo data", "date of grant", "grant date",
]
OTHER_LABELS = [
    "date of birth", "birth date", "date de naissance", "fecha de nacimiento", "datum urodzenia", "geburtsdatum", "date of expiry", "expiry date", "expiration date", "date of expiration", "date d expiration",
    "fecha de expiracion", "fecha de caducidad", "valid until", "valid thru", "valid through",
]
#: Forms of dates in normal text: day, month and year (or day and month in one), in the order in which they are looked for; fixed values.
FORMS = {
    "marked": r"(?<!\d)(\d{1,2})[./\-](\d{1,2})[./\-](\d{2}|\d{4})(?!\d)",
    "spaced": r"(?<!\d)(\d{1,2})\s+(\d{1,2})\s+(\d{2}|\d{4})(?!\d)",
    "glued": r"(?<!\d)(\d{3,4})\s*/\s*([a-z0-9]{2,10})\s+(\d{2}|\d{4})(?!\d)",
    "named": r"(?<![a-z0-9])(\d{1,2})\s*([a-z0-9]{2,10}(?:\s*/\s*[a-z0-9]{2,10})?)\s*(\d{2}|\d{4})(?!\d)",
    "compact": r"(?<!\d)(\d{2})(\d{2})(\d{2}|\d{4})(?!\d)",
}
PATTERNS = {k: re.compile(v) for k, v in FORMS.items()}
FIELD_MARKED = re.compile(r"\b(\d{1,2})[./\-](\d{1,2})[./\-](\d{2,4})\b")
FIELD_NAMED = re.compile(r"\b(\d{1,2})\s+([a-z]{3,12})\s+(\d{2,4})\b")
#: Least similarity of a month's name, and of an issue label.
LIKE_MONTH, LIKE_ISSUE = 0.72, 0.70
#: The year up to which two digits are of this century on a page.
PIVOT = 40

BY_NAME = {name: m for m, names in MONTHS.items() for name in names}
ISSUE = [date_text(x) for x in ISSUE_LABELS]
OTHER = [date_text(x) for x in OTHER_LABELS]


def real(year: int, month: int, day: int) -> str | None:
    try:
        return date(year, month, day).isoformat()
    except ValueError:
        return None


def like_month(token: str) -> int | None:
    """The month whose name resembles a token most, if enough; of equals the first."""
    able = [name for name in BY_NAME if most_ratio(token, name) >= LIKE_MONTH]
    best = max(able, key=lambda name: ratio(token, name), default=None)
    return BY_NAME[best] if able and ratio(token, best) >= LIKE_MONTH else None


@cache
def month_of(token: str) -> int | None:
    """Month of a token that may be misread, or name it in two languages."""
    t = date_text(token).replace(" ", "")
    known = (BY_NAME.get(MISREAD.get(x, x)) for x in [t, *t.split("/")])
    return next((m for m in known if m), None) or (like_month(t) if t else None)


def full_year(digits: str, birth: str | None, expiry: str | None, today: str) -> int:
    """Four digits as they are; two in the later century that birth, expiry and next year allow, else in the one nearer to today."""
    if len(digits) == 4:
        return int(digits)
    this, both = int(today[:4]), [1900 + int(digits), 2000 + int(digits)]
    low, high = int((birth or "0000")[:4]), min(int((expiry or "9999")[:4]), this + 1)
    return max([y for y in both if low <= y <= high], default=None) or min(both, key=lambda y: abs(y - this))


def dates_in(text: str | None, birth: str | None, expiry: str | None, today: str) -> list[tuple[str, str, int, int]]:
    """(iso, raw, start, end) of the dates in a text: a later match of the same day replaces offsets but keeps the place."""
    return dates_of(date_text(text or ""), birth, expiry, today)


def dates_of(normal: str, birth: str | None, expiry: str | None, today: str) -> list[tuple[str, str, int, int]]:
    """dates_in() of a text in normal form."""
    found: dict[str, tuple] = {}
    for form, pattern in PATTERNS.items():
        for m in pattern.finditer(normal):
            day, month, digits = m.groups()
            if form == "glued":  # day and month number in one, told by the month's name
                day, number = day[:2], int(day[2:])
                month = month_of(month)
                if not 1 <= int(day) <= 31 or number != month:
                    continue
            elif form == "named":
                month = month_of(month)
            if month and 1900 <= (year := full_year(digits, birth, expiry, today)) <= int(today[:4]) + 1:
                iso = real(year, int(month), int(day))
                if iso:
                    found[iso] = (iso, m.group(), m.start(), m.end())
    return list(found.values())


def field_date(text: str | None) -> str | None:
    """The first date of a page field: with marks between, or with a month's name (after zero is read as o, as in labels)."""
    raw = plain(text or "").strip()
    if m := FIELD_MARKED.search(raw):
        day, month, digits = m.groups()
        month = int(month)
    elif m := FIELD_NAMED.search(label_text(raw)):
        day, name, digits = m.groups()
        month = BY_NAME.get(name) or like_month(name)
    else:
        return None
    year = int(digits) + (0 if len(digits) != 2 else 2000 if int(digits) <= PIVOT else 1900)
    return real(year, month, int(day)) if month else None


def holds(normal: str, labels: list[str]) -> bool:
    """Whether a label is in a text, with its spaces or without any."""
    close = normal.replace(" ", "")
    return any(x in normal or x.replace(" ", "") in close for x in labels)


def issue_signal(text: str) -> bool:
    t = date_text(text)
    word = "date" in t and any(x in t for x in ("issue", "issu", "iss "))
    return holds(t, ISSUE) or word or max(ratio(t, x) for x in ISSUE) >= LIKE_ISSUE


def issue_similarity(text: str) -> float:
    t = date_text(text)
    return 0.0 if len(t) < 4 else max(1.0 if x in t or t in x else ratio(t, x) for x in ISSUE)


SIGNALS = T.StructType([T.StructField("issue", T.BooleanType()), T.StructField("negative", T.BooleanType()), T.StructField("similarity", T.DoubleType()), T.StructField("at", T.IntegerType())])


ISSUE_FORMS = Labels(ISSUE)


def signals(texts: pd.Series, least: float) -> pd.DataFrame:
    """SIGNALS of texts; a similarity may be too small where no ratio reaches least, and then the text is no issue label by similarity either."""
    different = texts.unique()
    normals = [date_text(x or "") for x in different]
    told = {}
    for x, t, top in zip(different, normals, ISSUE_FORMS.best(normals, least)):
        word = "date" in t and any(y in t for y in ("issue", "issu", "iss "))
        similar = 0.0 if len(t) < 4 else 1.0 if any(i in t or t in i for i in ISSUE) else top
        told[x] = (holds(t, ISSUE) or word or top >= LIKE_ISSUE, holds(t, OTHER), similar, min((t.find(i) for i in ISSUE if i in t), default=-1))
    return pd.DataFrame([told[x] for x in texts], columns=["issue", "negative", "similarity", "at"])


@F.pandas_udf(SIGNALS)
def label_signals(texts: pd.Series) -> pd.DataFrame:
    """Whether a text labels a date of issue, or another date; how well; and where in the normal text the first issue label stands (-1: nowhere)."""
    return signals(texts, 0.0)


@F.pandas_udf(SIGNALS)
def issue_signals(texts: pd.Series) -> pd.DataFrame:
    """label_signals() for who reads the issue labels only: no similarity is worked out that cannot make one."""
    return signals(texts, LIKE_ISSUE)


FOUND = "array<struct<first: int, n: int, iso: string, raw: string, start: int, end: int, place: int>>"


def mined(today: str, most: int = 3):
    """A function of a page's texts in order, birth and expiry (texts) to the dates in all windows of up to `most` neighbours: first item (from 0), items and place in the window.

    The normal form of a window is that of its items with a space between, and texts without digits hold no dates.
    """

    @F.arrow_udf(FOUND)
    def dates(pages: pa.Array, births: pa.Array, expiries: pa.Array) -> pa.Array:
        normal, known = {}, {}
        rows = [(p, b, e) for p, b, e in zip(pages.to_pylist(), births.to_pylist(), expiries.to_pylist())]
        out, ends = [], [0]
        for page, birth, expiry in rows:
            own = []
            for t in page or []:
                if t not in normal:
                    x = date_text(t or "")
                    normal[t] = (x, any(c.isdigit() for c in x))
                own.append(normal[t])
            for first in range(len(own)):
                text, digits = "", False
                for n, (x, has) in enumerate(own[first : first + most], 1):
                    text, digits = f"{text} {x}" if text and x else text or x, digits or has
                    if digits:
                        key = (text, birth, expiry)
                        found = known.get(key)
                        if found is None:
                            found = known[key] = dates_of(text, birth, expiry, today)
                        out += [(first, n, *d, place) for place, d in enumerate(found)]
            ends.append(len(out))
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32()]
        columns = zip(*out) if out else [[]] * 7
        names = ["first", "n", "iso", "raw", "start", "end", "place"]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names))

    return dates


@F.pandas_udf(T.StringType())
def page_date(texts: pd.Series) -> pd.Series:
    known = {t: field_date(t) for t in texts.unique()}
    return texts.map(lambda t: known[t]).astype(object).where(lambda x: x.notna(), None)


@F.pandas_udf(T.StringType())
def normal_date_text(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: date_text(t or ""))


def label_table(labels: dict[str, list[str]], least: float):
    """A function of texts to the fields that they label, with similarity."""
    pairs = [(f, label_text(x)) for f, xs in labels.items() for x in xs]
    forms, words = Labels([x for _, x in pairs]), {w for _, x in pairs for w in x.split()}

    @F.pandas_udf("map<string, double>")
    def fields(texts: pd.Series) -> pd.Series:
        different = texts.unique()
        normals = [label_text(x or "") for x in different]
        common, bound = forms.bounds(normals)
        length = np.array([len(t) for t in normals])[:, None]
        shares = np.array([not words.isdisjoint(t.split()) for t in normals], bool)[:, None]
        told: dict = {x: {} for x in different}
        # what no ratio, no common word and no text within the other can bring to the least is not worked out
        for i, j in np.argwhere((bound >= least) | shares | (common == forms.lengths) | (common == length)).tolist():
            s, own = label_similarity(normals[i], pairs[j][1]), told[different[i]]
            if s >= max(least, own.get(pairs[j][0], 0.0)):
                own[pairs[j][0]] = s
        return texts.map(lambda x: told[x])

    return fields


def inline_values(labels: dict[str, list[str]]):
    """A function of text and field to the value that stands in an item beside its own label: numbers, dates and sex only, whose form is strong."""
    known = {f: [label_text(x) for x in xs] for f, xs in labels.items()}

    def value(text: str, field: str) -> str | None:
        normal = label_text(text)
        if not any(x in normal for x in known[field]):
            return None
        if field == "passport_number":
            return next((x for x in re.findall(r"\b[A-Z0-9]{5,12}\b", text.upper()) if re.search(r"\d", x)), None)
        if field.startswith("date"):
            return field_date(text)
        if field == "sex" and (m := re.search(r"\b[MFX]\b", text, re.I)):
            return m.group().upper()
        return None

    @F.pandas_udf("string")
    def values(texts: pd.Series, fields: pd.Series) -> pd.Series:
        return pd.Series([value(t or "", f) for t, f in zip(texts, fields)], dtype=object)

    return values
