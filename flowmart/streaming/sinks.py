"""Sinks (K1-K10): Kafka records, per-topic files, JDBC batches, keyed upserts.

File sinks own one partition per micro-batch and overwrite it: a replayed batch puts
the same rows in the same place.  Kafka and JDBC appends are at-least-once; their rows
carry a key (or the batch id) to dedupe by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.operators import dim
from flowmart.sources import files

BATCH = "batch_id"


def kafka_value(df: DataFrame, drop: Sequence[str] = (), key: Sequence[str] = ()) -> DataFrame:
    """Each row as JSON text in ``value`` (null fields left out).  ``key``
    (K4) adds the message key, the JSON text of these fields: an upsert topic keeps
    the last message of each."""
    cols = [c for c in df.columns if c not in set(drop) | {"topic"}]
    out = [F.to_json(F.struct(*cols), {"ignoreNullFields": "true"}).alias("value")]
    if key:
        out.insert(0, F.to_json(F.struct(*key)).alias("key"))
    if "topic" in df.columns:
        out.insert(0, F.col("topic"))
    return df.select(*out)


def write_kafka(batch: DataFrame, bootstrap: str, topic: str | None = None) -> None:
    """K1 (fixed topic) / K2 (``topic`` column per row): ``[topic,] [key,] value`` rows of a
    micro-batch.  At-least-once: consumers dedupe on the key."""
    w = batch.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    (w.option("topic", topic) if topic else w).save()


def write_batch_files(batch: DataFrame, batch_id: int, path: str, by: Sequence[str] = ()) -> None:
    """Rows of one micro-batch as Parquet, in partitions ``by`` and the batch id; a replayed batch
    replaces its own rows."""
    (batch.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by, BATCH).parquet(path))


def write_routed_files(batch: DataFrame, path: str, batch_id: int, topic_col: str = "topic") -> None:
    """K2, file form: one folder per topic (``topic=<name>``)."""
    write_batch_files(batch, batch_id, path, [topic_col])


def write_jdbc(batch: DataFrame, url: str, table: str, columns: Sequence[str] | None = None,
               transient: Sequence[str] = (), batch_size: int = 1000, batch_id: int | None = None,
               properties: dict[str, str] | None = None) -> None:
    """K7 + K8 + K10: append rows to a JDBC table, fields bound by position (``columns`` order),
    transient fields left out.  With ``batch_id`` the rows carry it in a last column, so that a
    replayed batch can be told apart (an append itself is at-least-once)."""
    cols = [c for c in (columns or batch.columns) if c not in set(transient)]
    rows = batch.select(*cols)
    if batch_id is not None:
        rows = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    w = (rows.write.format("jdbc").option("url", url).option("dbtable", table)
         .option("batchsize", str(batch_size)))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("append").save()


def latest_per_key(batch: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by the order columns: a partial aggregate, so a hot key is combined
    before the shuffle."""
    row = F.struct(*batch.columns)
    return (batch.groupBy(*key).agg(F.max_by(row, F.struct(*order)).alias("_r"))
            .select("_r.*").select(*batch.columns))


# ---- dimension tables (K5, K6)

BUCKET = "bucket"
BUCKETS = 64


def create_wide(spark: SparkSession, path: str, sink_columns: str, sink_pk: str | None) -> None:
    """K5: an empty dimension table at ``path``, all strings, if there is none yet."""
    if not files.exists(spark, path):
        schema, _ = dim.table_schema(sink_columns, sink_pk)
        # the first bucket, without rows: its files give the table its columns
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/{BUCKET}=0")


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """A dimension table: one row per key."""
    return spark.read.option("mergeSchema", "true").parquet(path).drop(BUCKET)


def upsert_wide(cells: DataFrame, path: str, sink_columns: str, sink_pk: str | None, batch_id: int,
                buckets: int = BUCKETS) -> None:
    """K6: one micro-batch's cells (``pk``, ``column``, ``value``, one per cell) into the dimension
    table at ``path``.  Named columns get their new value, all others keep theirs.

    Rows lie in buckets by key.  Only the buckets that the batch touches are read; they are written
    whole beside the table first and then put in place of the old ones (dynamic partition overwrite).
    If the job is stopped while they are being put in place, the replayed batch finds them written and
    puts them there again, so no bucket is lost or merged twice.
    """
    spark = cells.sparkSession
    pk = sink_pk or "id"
    create_wide(spark, path, sink_columns, pk)
    next_ = f"{path}.next/{BATCH}={batch_id}"
    if not files.exists(spark, f"{next_}/_SUCCESS"):
        bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")
        touched = [r[0] for r in cells.select(bucket("pk")).distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        table = spark.read.option("mergeSchema", "true").parquet(path)
        columns = [c for c in table.columns if c != BUCKET]
        columns += [c for c in sink_columns.split(",") if c not in columns]
        now = table.where(F.col(BUCKET).isin(touched))
        now = now.select(*[F.col(c) if c in now.columns else F.lit(None).cast("string").alias(c) for c in columns])
        merged = dim.merge_into(now, cells, columns, pk)
        merged.withColumn(BUCKET, bucket(pk)).write.mode("overwrite").parquet(next_)
    new = spark.read.parquet(next_)
    (new.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(path))
    if batch_id:
        files.remove(spark, f"{path}.next/{BATCH}={batch_id - 1}")


def insert_into(df: DataFrame, columns: Sequence[str], path: str, fmt: str = "parquet",
                mode: str = "append") -> None:
    """``insert into T select * from V`` -- rows in the target's column
    order (a missing column fails, as a mismatched insert would)."""
    df.select(*columns).write.mode(mode).format(fmt).save(path)
