"""The extraction as ordered stages, each written and read by the next ones, so that a run can start and end at any of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from leafmill.functions.dialect import SPARK, chain
from leafmill.plans import records
from leafmill.plans.relational import TABLE, needed
from leafmill.streaming.incremental import _path

#: Stage, and the step of the plan that it ends with.
STAGES = [
    ("manifest", "sample"), ("recognised_zones", "lines"), ("checked_zones", "checked"), ("repaired_zones", "repaired"), ("chosen_variants", "chosen"), ("parsed_zones", "mrz"),
    ("page_fields", "wide"), ("dates_of_issue", "issue"), ("fused_records", "final"), ("page_statuses", "pages_"), ("assessed_records", "assessed"),
]


def listed() -> list[str]:
    return [f"{i:2d} {name}" for i, (name, _) in enumerate(STAGES, 1)]


def run_stages(spark: SparkSession, sf_dir: str, folder: str, start: int = 1, end: int | None = None, fresh: bool = False) -> DataFrame:
    """Run the stages start..end into a folder of tables and return the last one's. Earlier stages are read from the folder and must be there; fresh, which
    deletes what all stages left there, needs start 1. A stage before the end that is there already and whose inputs were not run again is not run again."""
    end = end or len(STAGES)
    if not 1 <= start <= end <= len(STAGES):
        raise ValueError(f"stages are 1 to {len(STAGES)}, in order")
    if fresh and start != 1:
        raise ValueError("a fresh run starts at stage 1")
    steps, given = records.assessed(SPARK), []
    at = lambda i: f"{folder}/{i:02d}-{STAGES[i - 1][0]}.parquet"
    if fresh:
        for i in range(1, len(STAGES) + 1):
            path, files = _path(spark, at(i))
            files.delete(path, True)
    try:
        again = False
        for i, (name, step) in enumerate(STAGES[:end], 1):
            path, files = _path(spark, f"{at(i)}/_SUCCESS")
            if i < start and not files.exists(path):
                raise FileNotFoundError(f"stage {i} ({name}) has not been run")
            if i >= start and (again or i == start or not files.exists(path)):
                upto = next(k for k, (n, _) in enumerate(steps) if n == step)
                text = chain(SPARK, *needed(steps[: upto + 1], set(given)))
                spark.sql(text, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(TABLE.findall(text))}).write.mode("overwrite").parquet(at(i))
                again = True
            spark.read.parquet(at(i)).createOrReplaceTempView(step)
            given.append(step)
        return spark.read.parquet(at(end))
    finally:
        for step in given:
            spark.catalog.dropTempView(step)
