"""Dimension lookups.

No broadcast hints: Spark broadcasts a side whose size in bytes it knows to be
under its threshold (a fixed dictionary, or a shuffle output that AQE has
measured) and joins larger dimensions by a shuffle, with hot partitions split.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.functions.timefn import DAY_MS
from flowmart.operators.asof import asof_join


def lookup_join(df: DataFrame, dim: DataFrame, left_key: str, right_key: str,
                how: str = "inner") -> DataFrame:
    """Join each row with its dimension row; inner drops unmatched rows.

    The reference probes the dimension per row at processing time; here the
    dimension is read when the plan (or micro-batch) is built, which is the
    same table state for a static dimension.
    """
    return df.join(dim, df[left_key] == dim[right_key], how)


class Dimension:
    """J3, S8 in a stream: a dimension that is read again while the job runs.

    ``read`` makes the dimension's DataFrame anew (a file source lists its files again, a JDBC source
    queries again).  :meth:`now` is called inside each micro-batch; a copy is used for ``every_s``
    seconds (the reference's cache holds rows for an hour; 0 reads for every batch).
    """

    def __init__(self, read: Callable[[], DataFrame], every_s: float = 0):
        self.read, self.every_s = read, every_s
        self.copy: DataFrame | None = None
        self.until = 0.0

    @classmethod
    def of(cls, dim: DataFrame | Dimension) -> Dimension:
        """A plain DataFrame is a dimension that never changes."""
        return dim if isinstance(dim, Dimension) else cls(lambda: dim)

    def now(self) -> DataFrame:
        if self.copy is None or time.monotonic() >= self.until:
            self.copy, self.until = self.read(), time.monotonic() + self.every_s
        return self.copy


def dim_versions(changes: DataFrame, key: str, at: str, columns: Sequence[str], deleted: Column,
                 seq: str | None = None) -> DataFrame:
    """The history of a dimension for :func:`lookup_asof`: one row per key and time (the last change
    of it by ``seq``), with the ``columns`` and whether the row was there."""
    value = F.struct((~deleted).alias("there"), F.struct(*columns).alias("row"))
    order = F.col(seq) if seq else F.lit(0)
    return (changes.where(F.col(key).isNotNull() & F.col(at).isNotNull())
            .groupBy(F.col(key).alias("key"), F.col(at).alias("at")).agg(F.max_by(value, order).alias("value")))


def lookup_asof(df: DataFrame, versions: DataFrame, key: str, at: Column, bucket: int = DAY_MS) -> DataFrame:
    """J3 as of time: each row with its dimension row as it was at ``at`` (ms), as the reference
    probes the dimension when the row arrives; rows without one are dropped."""
    found = asof_join(df.withColumn("_at", at), key, "_at", versions, bucket, "_dim").where("_dim.there")
    return found.select(*df.columns, "_dim.row.*")
