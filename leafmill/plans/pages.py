"""Queries of what needs similarity or mined dates: Spark only, over the synthetic pages."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.functions.mining import field_date, label_signals
from leafmill.operators import fields, issue
from leafmill.plans import synth
from leafmill.plans.extraction import mrz_table, scans
from leafmill.plans.relational import query
from leafmill.sources.tables import written

QUERIES: dict = {}


def page_query(f):
    QUERIES[f.__name__] = f
    return f


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' items, written once: three variants of each sample."""
    three = lambda d: [*scans(d), ("shots", f"select * from sample{d.each('0', '2', 'vi')}"), ("q", synth.scan_items(d, "shots"))]
    return written(query(three)(spark, sf_dir), "items")


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query(lambda d: [*scans(d), ("q", "select sample_id, k, v, relative_path as filename from sample")])(spark, sf_dir)


def context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Birth and expiry by zone and page; tables name the same scan in different ways."""
    name = "case k % 3 when 0 then 'c' || k || '_' || v || '.png' when 1 then 'c' || k || '_' || v else 'c' || k || '_' || v || '.jpg' end"
    zones = written(query(lambda d: [*mrz_table(d), ("q", f"select {name} as filename, m.sample_id as pos, m.date_of_birth as birth_date, m.date_of_expiry as expiry_date, m.parse_mode, m.all_main_checks_valid from mrz as m join sample as s on m.sample_id = s.sample_id")])(spark, sf_dir), "zones")
    parsed, valid = zones.drop("all_main_checks_valid"), zones.select("filename", "pos", "all_main_checks_valid")
    page = lambda d: [*scans(d), ("q", f"select {name} as filename, sample_id as pos, {d.iso('birth')} as date_of_birth, case when k % 4 = 0 then null else {d.iso('expiry')} end as date_of_expiry from sample where k % 5 <> 0")]
    return written(issue.temporal_context(manifest(spark, sf_dir), parsed, valid, query(page)(spark, sf_dir)), "context")


@page_query
def doi_temporal_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Birth, expiry and their source for each scan, looked up by the variants of its file name."""
    return context(spark, sf_dir)


@page_query
def doi_mined_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All dates in windows of one to three items, of five forms, with two-digit years resolved by birth and expiry."""
    return issue.dated(items(spark, sf_dir), context(spark, sf_dir), synth.TODAY).select("sample_id", "variant", "pos", "n", "iso", "raw", "start", "end", "x1", "y1", "x2", "y2", "confidence")


@page_query
def doi_label_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each text says about dates of issue and others."""
    texts = items(spark, sf_dir).groupBy("text").agg(F.count("*").alias("n"))
    return texts.withColumn("s", label_signals("text")).select("text", "n", "s.*")


@page_query
def doi_mined_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled, rescued, eliminated and backed-off dates."""
    return issue.candidates(items(spark, sf_dir), context(spark, sf_dir), synth.TODAY).withColumn("seq", F.to_json("seq"))


@page_query
def doi_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issue.ranked(issue.candidates(items(spark, sf_dir), context(spark, sf_dir), synth.TODAY))


@page_query
def doi_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date of issue of each scan, from items to decision."""
    own, known = items(spark, sf_dir), context(spark, sf_dir)
    return issue.decided(issue.candidates(own, known, synth.TODAY), own, manifest(spark, sf_dir), known)


@page_query
def viz_field_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best value of each field in each variant of a page, beside its label or in the same item."""
    return fields.field_candidates(items(spark, sf_dir))


@page_query
def viz_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per page: a value by field, agreed among its variants, the number of fields and the status."""
    from leafmill.operators.candidates import consensus, field_records

    chosen = written(consensus(written(fields.field_candidates(items(spark, sf_dir)), "candidates")), "chosen")
    wide = chosen.groupBy("sample_id").pivot("field", list(fields.FIELD_LABELS)).agg(F.first("value"))
    return wide.join(field_records(chosen), "sample_id")
