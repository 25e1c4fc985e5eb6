"""As-of joins: each row meets the newest version of its key that was valid at the row's time.

The answer depends on nothing but the key and the time, so it is found once for each distinct
(key, time) and joined back to the rows, however many there are; a key or a time that a third of all
rows share is combined before any shuffle, and AQE splits it in the join back.

For the distinct times, time is cut into buckets of ``bucket`` units.  A bucket starts with the last
version of the buckets before it (one row per key and bucket is looked at, not the versions), and
inside a bucket versions and times are sorted together.  So no task sorts a key's whole history, and
no row is paired with any version but its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def versions_at(times: DataFrame, versions: DataFrame, bucket: int) -> DataFrame:
    """``key``, ``at`` -> ``value``, the value of the newest of ``versions`` (``key``, ``at``, unique,
    and ``value``, not null) up to that time; times before the first version are left out.

    ``at`` is a bigint.  A null key or time has no version.
    """
    known = versions.select("key", "at", F.lit(0).alias("side"), "value").where("key is not null and at is not null")
    asked = times.select("key", "at").where("key is not null and at is not null").distinct().select(
        "key", "at", F.lit(1).alias("side"), F.lit(None).cast(known.schema["value"].dataType).alias("value"))
    rows = (asked.unionByName(known).withColumn("b", F.expr(f"(at - pmod(at, {int(bucket)}L)) div {int(bucket)}L"))
            .where("key is not null and b is not null"))  # here for both sides of the join, which then share a shuffle
    # inside a bucket: versions and times in one order, versions first
    upto = Window.partitionBy("key", "b").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("inside", F.last("value", ignorenulls=True).over(upto))
    # what holds when a bucket starts: the last version of the nearest earlier bucket that has one.
    # Taken from the same shuffled rows, so that the times are looked for once
    ends = inside.groupBy("key", "b").agg(F.max_by("inside", F.struct("at", "side")).alias("end"))
    before = Window.partitionBy("key").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select("key", "b", F.last("end", ignorenulls=True).over(before).alias("carry"))
    return (inside.where("side = 1").join(carry, ["key", "b"])
            .select("key", "at", F.coalesce("inside", "carry").alias("value")).where("value is not null"))


def asof_join(rows: DataFrame, key: str, at: str, versions: DataFrame, bucket: int, value: str = "value") -> DataFrame:
    """``rows`` with ``value``: inner join with the version valid at ``at``."""
    found = versions_at(rows.select(F.col(key).alias("key"), F.col(at).alias("at")), versions, bucket)
    found = found.select(F.col("key").alias("__key"), F.col("at").alias("__at"), F.col("value").alias(value))
    # the time first: as a number it tells most rows apart when they are sorted, without looking at the key
    return (rows.join(found, (rows[at] == F.col("__at")) & (rows[key] == F.col("__key")))
            .drop("__key", "__at"))
