"""The corpus pipeline: five stages, each over all rows that its predecessor kept.

The first four return the columns of `documents`; the last gives each remaining document's share of the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.exact import drop_exact_copies
from millrace.llm.mixing import mix_sources
from millrace.llm.simhash import drop_near_copies
from millrace.llm.toxicity import drop_toxic
from millrace.plans.scratch import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("simhash near-dedup", near_dedup), ("benchmark decontamination", decontamination), ("mixing", mixing)]

#: Fitted probabilities, 64-bit fingerprints and reachability have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
