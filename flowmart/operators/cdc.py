"""Slicing the database change feed into typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# default name of the source database in the change feed (a parameter of cdc_slice)
DATABASE = "shop"


def cdc_slice(
    feed: DataFrame,
    table: str,
    columns: Sequence[str],
    types: Sequence[str] = ("insert",),
    database: str = DATABASE,
    keep: Sequence[str] = ("ts",),
) -> DataFrame:
    """P4 + P3: rows of one table and change type, ``data['k'] AS k`` per column.

    A key missing from ``data`` gives null.  The filter is three equalities on
    plain columns, so it reaches the source scan.
    """
    cond = (F.col("database") == database) & (F.col("table") == table)
    cond = cond & (F.col("type") == types[0] if len(types) == 1 else F.col("type").isin(*types))
    return feed.where(cond).select(*[F.col("data")[c].alias(c) for c in columns],
                                   *[F.col(k) for k in keep])


def with_proc_time(df: DataFrame, name: str = "pt") -> DataFrame:
    """Processing-time attribute."""
    return df.withColumn(name, F.current_timestamp())
