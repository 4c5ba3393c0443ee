"""SQL expressions that Spark and DuckDB spell differently.

Operators are written once as relational text over these, run by Catalyst through spark.sql, and checked in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame

ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Spark:
    name = "spark"

    def table(self, name: str) -> str:
        return "{" + name + "}"

    def text(self, x: str) -> str:
        return f"cast({x} as string)"

    def num(self, x: float) -> str:
        return f"{float(x)!r}D"

    def array(self, *xs: str) -> str:
        return f"array({', '.join(xs)})"

    def struct(self, **fields: str) -> str:
        return f"named_struct({', '.join(f'{chr(39)}{k}{chr(39)}, {x}' for k, x in fields.items())})"

    def keep(self, array: str) -> str:
        """The elements that are not null."""
        return f"filter({array}, x -> x is not null)"

    def joined(self, array: str, by: str) -> str:
        return f"array_join({array}, '{by}')"

    def distinct(self, array: str) -> str:
        return f"array_distinct({array})"

    def size(self, array: str) -> str:
        return f"cast(size({array}) as bigint)"

    def contains(self, array: str, x: str) -> str:
        return f"array_contains({array}, {x})"

    def matches(self, x: str, pattern: str) -> str:
        return f"({x} rlike '{pattern}')"

    def replaced(self, x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, '{pattern}', '{by}')"

    def letters(self, x: str) -> str:
        """How many letters, of any script, a text has."""
        return f"regexp_count({x}, r'\\pL')"

    def differing(self, a: str, b: str) -> str:
        """Places at which two texts of one length differ."""
        return f"size(filter(sequence(1, greatest(length({a}), 1)), i -> substr({a}, i, 1) <> substr({b}, i, 1)))"

    def sha1(self, x: str) -> str:
        return f"sha1({x})"

    def sha256(self, x: str) -> str:
        return f"sha2({x}, 256)"

    def fraction(self, x: str) -> str:
        """First 12 hex digits as a fraction of one."""
        return f"(cast(conv(left({x}, 12), 16, 10) as double) / pow(16, 12))"

    def date(self, x: str, form: str) -> str:
        return f"try_to_date({x}, '{form}')"

    def days(self, a: str, b: str) -> str:
        """Days from b to a."""
        return f"cast(datediff({a}, {b}) as bigint)"

    def plus_days(self, x: str, n: str) -> str:
        return f"date_add({x}, cast({n} as int))"

    def plus_years(self, x: str, n: int) -> str:
        return f"add_months({x}, {12 * n})"

    def iso(self, x: str) -> str:
        return f"date_format({x}, 'yyyy-MM-dd')"

    def ymd(self, x: str) -> str:
        return f"date_format({x}, 'yyMMdd')"

    def dmy(self, x: str) -> str:
        return f"date_format({x}, 'dd/MM/yyyy')"

    def made_date(self, y: str, m: str, d: str) -> str:
        return f"try_to_date(concat_ws('-', lpad(cast({y} as string), 4, '0'), lpad(cast({m} as string), 2, '0'), lpad(cast({d} as string), 2, '0')), 'yyyy-MM-dd')"

    def rounded(self, x: str, n: int) -> str:
        """Half to even."""
        return f"bround({x}, {n})"

    def number(self, x: str) -> str:
        return f"try_cast({x} as double)"

    def whole(self, x: str) -> str:
        """A double cut off to a whole number."""
        return f"cast({x} as bigint)"

    def each(self, low: str, high: str, name: str) -> str:
        """To follow a FROM item: a row for each whole number."""
        return f" lateral view explode(sequence(cast({low} as int), cast({high} as int))) as {name}"

    def unnest(self, array: str, name: str) -> str:
        return f" lateral view explode({array}) as {name}"

    def stacked(self, keys: str, rows: list[str], source: str) -> str:
        """A row for each list of named columns, with the keys, of every row of the source; read in one pass, where a union would plan and read the source for each."""
        return f"select {keys}, r.* from {source} lateral view inline(array({', '.join(f'struct({x})' for x in rows)})) r"

    def parts(self, x: str, by: str) -> str:
        return f"split({x}, '{by}')"

    def weights(self, x: str, n: int) -> str:
        """Sum of 7-3-1 weighted character values of a text of n characters, or what leaves the same rest by 10 (values count by their last digit); x is computed once."""
        digits = "".join(str(i % 10) for i in range(10, 36)) + "0"
        moved = f"regexp_replace(translate({x}, '{ALPHABET[10:]}<', '{digits}'), '[^0-9]', '0')"
        weights = f"array({', '.join(str((7, 3, 1)[i % 3]) for i in range(n))})"
        return f"aggregate(zip_with(split({moved}, ''), {weights}, (c, w) -> try_cast(c as int) * w), 0, (a, v) -> a + coalesce(v, 0))"

    def collected(self, x: str, order: str) -> str:
        """The values in ascending order of a key, which is unique in its group."""
        return f"transform(array_sort(collect_list(struct({order} as o, {x} as x))), y -> y.x)"

    def collected_set(self, x: str) -> str:
        return f"array_sort(collect_set({x}))"

    def count_if(self, x: str) -> str:
        return f"cast(count_if({x}) as bigint)"

    def best(self, x: str, by: str) -> str:
        return f"max_by({x}, {by})"

    def json(self, x: str, key: str) -> str:
        return f"get_json_object({x}, '$.{key}')"


class Duck(Spark):
    name = "duckdb"

    def table(self, name: str) -> str:
        return name

    def text(self, x):
        return f"cast({x} as varchar)"

    def num(self, x):
        return f"cast({float(x)!r} as double)"

    def array(self, *xs):
        return f"[{', '.join(xs)}]"

    def struct(self, **fields):
        return "{" + ", ".join(f"'{k}': {x}" for k, x in fields.items()) + "}"

    def keep(self, array):
        return f"[x for x in {array} if x is not null]"

    def joined(self, array, by):
        return f"array_to_string({array}, '{by}')"

    def distinct(self, array):
        # the first of equal elements stays in its place
        return f"list_transform(list_filter(list_zip({array}, range(len({array}))), lambda z: list_position({array}, z[1]) = z[2] + 1), lambda z: z[1])"

    def size(self, array):
        return f"cast(len({array}) as bigint)"

    def contains(self, array, x):
        return f"list_contains({array}, {x})"

    def matches(self, x, pattern):
        return f"regexp_matches({x}, '{pattern}')"

    def replaced(self, x, pattern, by):
        return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"

    def letters(self, x):
        return f"length(regexp_replace({x}, '[^\\pL]', '', 'g'))"

    def differing(self, a, b):
        return f"cast(len([i for i in range(1, length({a}) + 1) if substr({a}, i, 1) <> substr({b}, i, 1)]) as int)"

    def sha256(self, x):
        return f"sha256({x})"

    def fraction(self, x):
        return f"(cast(cast('0x' || left({x}, 12) as bigint) as double) / pow(16, 12))"

    def date(self, x, form):
        form = form.replace("yyyy", "%Y").replace("yy", "%y").replace("MM", "%m").replace("dd", "%d")
        return f"cast(try_strptime({x}, '{form}') as date)"

    def days(self, a, b):
        return f"cast(date_diff('day', cast({b} as date), cast({a} as date)) as bigint)"

    def plus_days(self, x, n):
        return f"({x} + cast({n} as int))"

    def plus_years(self, x, n):
        return f"cast({x} + interval ({n}) year as date)"

    def iso(self, x):
        return f"strftime({x}, '%Y-%m-%d')"

    def ymd(self, x):
        return f"strftime({x}, '%y%m%d')"

    def dmy(self, x):
        return f"strftime({x}, '%d/%m/%Y')"

    def made_date(self, y, m, d):
        return f"try_cast(concat_ws('-', lpad(cast({y} as varchar), 4, '0'), lpad(cast({m} as varchar), 2, '0'), lpad(cast({d} as varchar), 2, '0')) as date)"

    def rounded(self, x, n):
        return f"round_even({x}, {n})"

    def whole(self, x):
        return f"cast(trunc({x}) as bigint)"

    def each(self, low, high, name):
        return f", unnest(range({low}, {high} + 1)) as u_{name}({name})"

    def unnest(self, array, name):
        return f", unnest({array}) as u_{name}({name})"

    def stacked(self, keys, rows, source):
        return " union all ".join(f"select {keys}, {x} from {source}" for x in rows)

    def parts(self, x, by):
        return f"regexp_split_to_array({x}, '{by}')"

    def weights(self, x, n):
        return f"list_sum([greatest(instr('{ALPHABET}', substr({x}, i, 1)) - 1, 0) * [7, 3, 1][(i - 1) % 3 + 1] for i in range(1, {n} + 1)])"

    def collected(self, x, order):
        return f"list({x} order by {order})"

    def collected_set(self, x):
        return f"list_sort(list(distinct {x}) filter ({x} is not null))"

    def count_if(self, x):
        return f"cast(count(*) filter ({x}) as bigint)"

    def best(self, x, by):
        return f"arg_max({x}, {by})"

    def json(self, x, key):
        return f"json_extract_string({x}, '$.{key}')"


SPARK, DUCK = Spark(), Duck()


def operator(text: Callable[..., str]) -> Callable[..., DataFrame]:
    """From the relational text of an operator over named relations, text(d, a, b, ..., **options), an operator on DataFrames.

    Call it with a DataFrame for each relation; `.text` gives the text over relation names.
    """
    import inspect

    relations = [p.name for p in inspect.signature(text).parameters.values() if p.kind is p.POSITIONAL_OR_KEYWORD][1:]

    @wraps(text)
    def run(*frames: DataFrame, **options) -> DataFrame:
        named = dict(zip(relations, frames))
        return frames[0].sparkSession.sql(text(SPARK, *[SPARK.table(r) for r in relations], **options), **named)

    run.text, run.relations = text, relations
    return run


def chain(d: Spark, *steps: tuple[str, str], last: str | None = None) -> str:
    """WITH text of named steps; the result is the last step, or the text in last."""
    return f"with {', '.join(f'{n} as ({t})' for n, t in steps)} " + (last or f"select * from {steps[-1][0]}")
