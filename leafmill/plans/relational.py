"""From the named steps of a plan to a query: steps that several others read are written once."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafmill.functions.dialect import SPARK, chain
from leafmill.sources.tables import written

TABLE = re.compile(r"\{(\w+)\}")


#: Steps that are cheaper to compute again than to write: projections of the source tables.
NARROW = {"ident", "sample"}
#: Steps that are written for one reader too: the plans before and behind them are large, and the driver need not hold both at once.
WIDE = {"mrz", "final"}
#: HotSpot never compiles a method of more bytes; Spark's own bound lets whole stages of up to 65,535 run interpreted.
METHOD_BYTES = 8000


def uses(name: str, text: str) -> int:
    """How often a text reads the relation of that name."""
    return len(re.findall(rf"\b(?:from|join)\s+{name}\b", text))


def needed(steps: list[tuple[str, str]], given: set[str]) -> list[tuple[str, str]]:
    """The steps that the last one rests on, but for those that are given."""
    wanted, out = {steps[-1][0]}, []
    for name, text in reversed(steps):
        if name in wanted and name not in given:
            out.append((name, text))
            wanted |= {n for n, _ in steps if uses(n, text)}
    return out[::-1]


def spread(table: DataFrame) -> DataFrame:
    """A source table over all tasks: one small file is one task, and so is all that is made of its rows before the first shuffle."""
    return table.repartition(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def query(plan: Callable) -> Callable[[SparkSession, str], DataFrame]:
    """A plan as a query over the Parquet tables of a folder.

    Steps that several later steps read are written once and read back; else each reader would plan and compute them again.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        steps, given = plan(SPARK), set()
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", METHOD_BYTES)

        def frame(upto: int) -> DataFrame:
            text = chain(SPARK, *needed(steps[: upto + 1], given))
            return spark.sql(text, **{t: spread(spark.read.parquet(f"{sf_dir}/{t}.parquet")) for t in set(TABLE.findall(text))})

        try:
            for i, (name, _) in enumerate(steps[:-1]):
                live = needed(steps, given)
                readers = sum(uses(name, text) for _, text in live)
                if name not in NARROW and readers > (0 if name in WIDE else 1):
                    written(frame(i), name).createOrReplaceTempView(name)
                    given.add(name)
            return frame(len(steps) - 1)
        finally:
            for name in given:
                spark.catalog.dropTempView(name)

    run.__doc__ = plan.__doc__
    return run
