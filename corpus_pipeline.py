"""The training-data pipeline: five stages from raw documents to shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes a stage's rows to the shared folder and reads them back as the next
one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridcast.llm import decontam, minhash, mixing, quality, shard
from gridcast.llm.common import load, staged

#: A line in ten texts of a host goes, however large the host is.
LINE_RULES = quality.QualityRules(max_docs=10)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits leave the others."""
    return quality.clean(docs, LINE_RULES)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.decontaminate(docs, load(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat by their source's rate, shuffled globally."""
    return mixing.mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return shard.assign(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("sharding", sharding),
]

#: MinHash signatures, hash bitmaps and binary search are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
