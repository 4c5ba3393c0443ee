"""All queries of the reference's operators: the same plan of operators over synthetic documents, as Spark queries and as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leafmill.functions.dialect import DUCK, chain
from leafmill.operators import matching
from leafmill.plans import extraction, pages, records, suite, synth
from leafmill.plans.relational import query

PLANS: dict[str, Callable] = {**extraction.PLANS, **records.PLANS, **suite.PLANS}


def near_duplicate_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of samples of different suggested identities that look alike."""
    return matching.near_duplicate_identities(query(records.identified)(spark, sf_dir))


def fuzzy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page items with the field that their text labels."""
    return matching.labelled_items(query(lambda d: [*extraction.scans(d), ("items", synth.page_items(d, "sample"))])(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: query(plan) for name, plan in PLANS.items()}
#: Gestalt similarity has no SQL; tests hold these two against the standard library.
QUERIES |= {f.__name__: f for f in (near_duplicate_identities, fuzzy_labels)} | pages.QUERIES | suite.QUERIES
ORACLES: dict[str, str] = {name: chain(DUCK, *plan(DUCK)) for name, plan in PLANS.items()} | suite.ORACLES
