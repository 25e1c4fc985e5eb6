"""Stream readers.

Kafka is the production source (``format("kafka")``; offsets live in the
query checkpoint, so a restarted job resumes exactly where it stopped).  A
folder of text files is the stand-in used by tests and by deployments
without Kafka: each line is one record, exactly like a Kafka value.

No line is dropped silently: by default a reader fails on a malformed line, as
the reference's jobs do (P2).  With ``strict=False`` it passes the good lines, and
:func:`dirty_lines` gives the others, to be written by a query of their own.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart import schemas
from flowmart.functions.timefn import event_time
from flowmart.operators import parse
from flowmart.operators.cdc import with_proc_time
from flowmart.session import WATERMARK_DELAY, checkpoint_dir
from flowmart.sources import files


def kafka_options(bootstrap: str, topic: str, group_id: str | None = None,
                  starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of a Kafka source (S1).  ``group_id`` names the consumer group
    as the reference does; Spark itself tracks offsets in the checkpoint, and a
    first run reads the topic from its start, so no backlog is skipped.  Expired
    offsets fail the query.  ``max_offsets_per_trigger`` bounds a micro-batch, and
    with it the rows one hot key can bring to its keyed-state task per batch."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def read_text_stream(spark: SparkSession, path: str | None = None,
                     kafka: dict[str, str] | None = None,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of text records in column ``value``; null values dropped."""
    if kafka is not None:
        df = spark.readStream.format("kafka").options(**kafka).load()
        return df.select(F.col("value").cast("string").alias("value")).where(
            F.col("value").isNotNull())
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path).where(F.col("value").isNotNull())


def _records(raw: DataFrame, strict: bool) -> DataFrame:
    p = parse.with_record(raw, strict=strict, blank=False)
    return p.where(F.col(parse.RECORD).isNotNull())


def dirty_lines(raw: DataFrame) -> DataFrame:
    """The lines that are not exactly one JSON object."""
    p = parse.with_record(raw, blank=False)
    return p.where(F.col(parse.RECORD).isNull()).select("value")


def read_cdc(spark: SparkSession, strict: bool = True, **kw) -> DataFrame:
    """S3: the change feed (database, table, type, ts, xid, xoffset, data, old) + ``pt``."""
    r = F.col(parse.RECORD)
    return with_proc_time(_records(read_text_stream(spark, **kw), strict).select(
        *[parse.field(r, f.name, f.dataType.simpleString()).alias(f.name) for f in schemas.CDC]))


def read_page_log(spark: SparkSession, delay: str = WATERMARK_DELAY, strict: bool = True, **kw) -> DataFrame:
    """The page log with event time ``rt`` and a watermark of ``delay``."""
    df = _records(read_text_stream(spark, **kw), strict).select(*parse.log_fields(F.col(parse.RECORD)))
    return df.withColumn("rt", event_time("ts")).withWatermark("rt", delay)


def read_config_changes(spark: SparkSession, startup: str = "initial", strict: bool = True,
                        since_ms: int | None = None, name: str = "config_changes", **kw) -> DataFrame:
    """Configuration changes.  ``initial`` keeps the snapshot rows (op 'r') then the
    changes; ``latest`` keeps what has changed since the job was first started: no snapshot row and
    no older change still in the feed.  That moment is ``since_ms``, or the time of the first call with
    this ``name``, which is kept in the shared checkpoint folder, so a restarted job misses nothing.
    A Kafka source also starts at the latest offsets (and later at those of its checkpoint)."""
    if startup == "latest":
        if since_ms is None:
            since_ms = files.first_time(spark, checkpoint_dir(spark, f"streams/{name}.started"),
                                        round(time.time() * 1000))
        if kw.get("kafka") is not None:
            kw["kafka"] = {**kw["kafka"], "startingOffsets": "latest"}
    r = F.col(parse.RECORD)
    df = _records(read_text_stream(spark, **kw), strict).select(
        *[parse.field(r, f.name, f.dataType.simpleString()).alias(f.name) for f in schemas.CONFIG_CHANGE])
    return df.where((F.col("op") != "r") & (F.col("ts_ms") >= since_ms)) if startup == "latest" else df


def read_records_once(spark: SparkSession, path: str | None = None, kafka: dict[str, str] | None = None,
                      delay: str = "1 hour", max_files_per_trigger: int | None = None) -> DataFrame:
    """K2 downstream: routed records (``record_id``, ``value``, event time ``rt``), each once.

    A sink that is restarted may write a batch again.  Records of one id that arrive within ``delay``
    of each other count once; ids older than that are dropped from the state.  Kafka records carry
    their id as the key and their time of writing; files have the columns of
    ``dwd.to_topic_records``, with the change's own time.
    """
    if kafka is not None:
        df = spark.readStream.format("kafka").options(**kafka).load().select(
            F.col("key").cast("string").alias("record_id"), F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("rt"))
    else:
        r = spark.readStream.schema("record_id string, ts bigint, value string, topic string")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        df = r.parquet(path).select("topic", "record_id", "value", F.timestamp_seconds("ts").alias("rt"))
    return df.withWatermark("rt", delay).dropDuplicatesWithinWatermark(["record_id"])
