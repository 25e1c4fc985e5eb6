"""A training corpus from raw documents: five stages, each a function of (spark, docs, sf_dir).

Stages, in order: quality rules (rejected documents go), near duplicates (one document of each group
stays), benchmark decontamination (affected documents go), mixing (sources at their target weights;
documents are repeated or cut as the schedule says) and sharding (a shard and a slot for every row).
All but the last return the columns of ``docs``; the last adds size, law, shard and slot.

``ORACLE_SQL`` is None: robust estimates and the sampled quantiles behind them have no SQL form.  The
tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowmart.llm import common, decontaminate, mixing, near_dedup, quality_rules, sharding


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that neither the base rules nor the robust distance rejects."""
    return quality_rules.stage(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4, five-word shingles, similarity 0.8 or more: one document of each group."""
    return near_dedup.stage(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents without any benchmark window."""
    return decontaminate.stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: the mix of the sources, one row per copy of a document."""
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: every row with its shard (of 8) and slot."""
    return sharding.shard(docs, 8)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage but the last is written to the shared folder."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
