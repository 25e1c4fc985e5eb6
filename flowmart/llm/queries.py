"""Registered queries of this subpackage: ``opN_<name>`` over whole tables, and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm import common as C
from flowmart.llm import (centroids, collocations, decontaminate, mixing, near_dedup, oracle, pii, quality_model,
                          quality_rules, reply_trees, secret_scan, sharding, substring_dedup, token_output)

#: the tokenizer file of op3, by the name that the public tokenizer package knows it by
TOKENIZER = "byte_bpe_50k.json"


def op1_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 1 over all documents, fitted on a bounded sample of ``labels``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_model.grade(C.documents(spark, sf_dir, "doc_id", "text"), labels)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 2 over all documents."""
    return secret_scan.digest(secret_scan.find(C.documents(spark, sf_dir, "doc_id", "text")))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 3 over all documents: write, read back, digest."""
    import public_tokenizers

    return token_output.digests(C.documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path(TOKENIZER))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 4 over all documents: four-word shingles."""
    return near_dedup.near_duplicates(C.documents(spark, sf_dir, "doc_id", "text"), k=4)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 6 over all documents and benchmark items."""
    found = decontaminate.contamination(C.documents(spark, sf_dir, "doc_id", "text"),
                                        spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    items = F.array_sort(F.array_distinct("items"))
    return found.select("doc_id", "n_words", F.size("hits").cast("bigint").alias("n_hit"),
                        F.size(items).cast("bigint").alias("n_items"),
                        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 10 over all documents."""
    return substring_dedup.remove_repeats(C.documents(spark, sf_dir, "doc_id", "text")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 over all documents (law: bytes)."""
    docs = C.documents(spark, sf_dir, "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return sharding.shard(docs.withColumn("text_crc32", F.crc32(text.cast("binary")))).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 7 over all documents."""
    return pii.digest(pii.find(C.documents(spark, sf_dir, "doc_id", "text")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 8 over all documents."""
    return quality_rules.outliers(C.documents(spark, sf_dir)).drop("d2", "cut")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 9 over all documents: what the mix takes of each."""
    return mixing.takings(C.documents(spark, sf_dir, "doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 11 over all embeddings."""
    return centroids.digest(*centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 12 over all conversations and one that holds the template's own control strings."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    return reply_trees.digest(reply_trees.conversations(reply_trees.of_turns(rows.unionByName(probe))))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 13 over all documents: phrases of two and three words."""
    return collocations.collocations(C.documents(spark, sf_dir, "lang", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_model": op1_quality_model,
        "op2_secret_scan": op2_secret_scan,
        "op3_token_output": op3_token_output,
        "op4_near_dedup": op4_near_dedup,
        "op5_sharding": op5_sharding,
        "op6_decontaminate": op6_decontaminate,
        "op7_pii": op7_pii,
        "op8_quality_rules": op8_quality_rules,
        "op9_mixing": op9_mixing,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_centroids": op11_centroids,
        "op12_chat_format": op12_chat_format,
        "op13_collocations": op13_collocations,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express; the others are tested by brute force."""
    return oracle.oracle_sql()
