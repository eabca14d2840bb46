"""The corpus pipeline: five stages over the documents.

Toxic documents go, one row of each group of near duplicates stays (also of rows without an id),
documents that hold a benchmark item go, the sources are mixed to their target
weights, and the result is shuffled into shards.  Each stage works on all that
the one before it kept; ``run`` writes each stage's result to the shared folder
and reads it again.

A document's columns pass through unchanged until the last stage, which adds
its shard and slot.  Mixing repeats the rows of a source that is taken more
than once.  Nulls, empty texts, repeated rows and empty tables have the results
that the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import decontamination, mixing, sharding, simhash, toxicity
from salesmart.llm.common import table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each(docs, unnamed_stay=False)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, table(spark, sf_dir, "labels"))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_records(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: No stage but the last could be said in SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
