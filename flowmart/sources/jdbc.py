"""JDBC readers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.operators.lookup import Dimension


def snake_to_camel(name: str) -> str:
    """``sink_table`` -> ``sinkTable``."""
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def read_jdbc(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None,
              camel_case: bool = False, num_partitions: int | None = None,
              partition_column: str | None = None, bounds: tuple[int, int] | None = None,
              ) -> DataFrame:
    """Rows of a SQL query.  For large tables give a numeric
    ``partition_column`` and ``bounds`` so the read is split over tasks."""
    r = spark.read.format("jdbc").option("url", url)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column and bounds and num_partitions:
        r = (r.option("dbtable", f"({query}) q").option("partitionColumn", partition_column)
             .option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1]))
             .option("numPartitions", str(num_partitions)))
    else:
        r = r.option("query", query)
    df = r.load()
    if camel_case:
        df = df.select(*[F.col(c).alias(snake_to_camel(c)) for c in df.columns])
    return df


def read_dim(spark: SparkSession, url: str, table: str,
             properties: dict[str, str] | None = None) -> DataFrame:
    """A lookup dimension (e.g. ``base_dic``) read whole."""
    if not re.fullmatch(r"[A-Za-z0-9_.]+", table):
        raise ValueError(f"bad table name: {table!r}")
    return read_jdbc(spark, url, f"select * from {table}", properties)


def jdbc_dimension(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None,
                   every_s: float = 3600) -> Dimension:
    """A database table as the dictionary of a running job, queried again every ``every_s``
    seconds (the reference's lookup cache: one hour)."""
    return Dimension(lambda: read_dim(spark, url, table, properties), every_s)
