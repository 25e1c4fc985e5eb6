"""Lazy access to the parquet tables of one scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """``Tables(spark, "/root/testdata/sf0.01")("events")`` -> DataFrame.

    Reads are lazy: Catalyst prunes columns and pushes filters into each scan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
