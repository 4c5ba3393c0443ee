"""A training corpus in five stages: each takes (spark, docs, sf_dir), and its result is written as Parquet and read as the next one's docs."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from leafmill.llm import bpe, decontaminate, secrets, simhash, toxicity
from leafmill.llm.common import materialise, read
from leafmill.llm.queries import RANKS


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return toxicity.civil(docs, read(spark, sf_dir, "labels"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.deduplicate(docs)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark windows go."""
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def redacted_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark."""
    return secrets.redacted(docs)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with digests of the ids and of what they decode to."""
    return bpe.encoded(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("toxicity", civil_documents),
    ("simhash", distinct_documents),
    ("decontamination", uncontaminated_documents),
    ("secrets", redacted_documents),
    ("bpe", encoded_documents),
]

#: SQL cannot express fingerprints, learnt scores or BPE; tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
