"""Runnable streaming jobs (T13 and the nine jobs' stream forms).

Every job takes its checkpoint folder from the session's shared checkpoint
directory (``spark.checkpoint.dir``), so a restarted or relocated driver
resumes from the last committed micro-batch: source offsets, keyed state
(RocksDB) and sink progress are all in the checkpoint.  The reference
checkpoints every 5 s; here that is the default trigger interval.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from flowmart import schemas
from flowmart.operators import config, dim, dwd, dws, logsplit, parse, trade
from flowmart.operators.lookup import Dimension, lookup_join
from flowmart.session import CHECKPOINT_INTERVAL, DEFAULT_TZ, checkpoint_dir
from flowmart.streaming import order_state, rule_state, sinks
from flowmart.streaming.processors import fix_is_new_stream

# The topics of the log split.
LOG_TOPICS = {k: f"dwd_traffic_{k}_log" for k in logsplit.OUTPUTS}


def start(df: DataFrame, name: str, sink: Callable[[DataFrame, int], None] | None = None,
          fmt: str | None = None, path: str | None = None, output_mode: str = "append",
          trigger: str | None = CHECKPOINT_INTERVAL, available_now: bool = False,
          checkpoint: str | None = None, options: dict[str, str] | None = None,
          partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Start a query with a checkpoint under the shared checkpoint dir.

    ``sink`` is a ``foreachBatch`` function; else ``fmt``/``path`` name a
    built-in sink (parquet, kafka, memory...).
    """
    spark = df.sparkSession
    ckpt = checkpoint or checkpoint_dir(spark, os.path.join("streams", name))
    w = df.writeStream.queryName(name).outputMode(output_mode).option("checkpointLocation", ckpt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    if sink is not None:
        w = w.foreachBatch(sink)
    elif fmt:
        w = w.format(fmt)
    return w.start(path) if path else w.start()


def _to(df: DataFrame, name: str, path: str | None, bootstrap: str | None,
        partition_by: tuple[str, ...] = (), **start_kw) -> StreamingQuery:
    """Stream rows to Kafka or to files: Spark's file sink commits each batch once, in its own
    log, so a replay adds nothing."""
    if bootstrap:
        return start(df, name, fmt="kafka", options={"kafka.bootstrap.servers": bootstrap}, **start_kw)
    return start(df, name, fmt="parquet", path=path, partition_by=partition_by, **start_kw)


# ---- log split

def log_layer_stream(raw: DataFrame, value: str = "value", tiebreak: str | None = None,
                     tz: str = DEFAULT_TZ, delay: str = "2 seconds",
                     ) -> tuple[DataFrame, DataFrame]:
    """The log-split job on a stream: (repaired records, dirty lines).

    is_new is repaired by mid with keyed state (T5); a row keeps its raw text
    beside the few fields the state needs, and :func:`log_lines` makes the outputs
    of it.  Dirty lines (malformed, or missing a required field) bypass the state.
    """
    keep = [c for c in raw.columns if c != value]
    r = F.col(parse.RECORD)
    good, dirty = parse.split_valid(raw, parse.log_complete(r), value)
    rows = good.select(
        *keep, F.col(value), parse.field(r, "common", path="$.mid").alias("mid_key"),
        parse.field(r, "common", path="$.is_new").alias("is_new_raw"),
        parse.field(r, "ts", "bigint").alias("ts"))
    rows = rows.withColumn("rt", F.timestamp_millis("ts")).withWatermark("rt", delay)
    return fix_is_new_stream(rows, "mid_key", "is_new_raw", "ts", tz, tiebreak), dirty.select(*keep, value)


def log_lines(records: DataFrame, value: str = "value") -> DataFrame:
    """The five outputs of repaired records in one pass: ``topic``, ``kind``, ``value`` (JSON).  One
    parse per record; each record gives its lines as one array."""
    p = parse.with_record(records, value)
    r = F.col(parse.RECORD)
    p = p.select("fm_fixed", parse.fields(r).alias(parse.RECORD), *parse.log_fields(r))
    p = logsplit.with_flag(p.withColumn("common", F.col("common").withField("is_new", F.col("fm_fixed"))))

    def line(kind: str, text: Column) -> Column:
        return F.struct(F.lit(LOG_TOPICS[kind]).alias("topic"), F.lit(kind).alias("kind"), text.alias("value"))

    def without(*names: str) -> Column:
        return parse.json_text(F.map_filter(r, lambda k, v: ~k.isin(*names)))

    page_id, none = F.col("page.page_id"), F.array().cast("array<struct<topic:string,kind:string,value:string>>")
    display = F.transform("displays", lambda x: line("display", parse.json_text(
        parse.put(x, page_id=page_id, ts=F.col("ts")))))
    action = F.transform("actions", lambda x: line("action", parse.json_text(parse.put(x, page_id=page_id))))
    error = F.when(F.col("err").isNotNull(), F.array(line("error", parse.json_text(r)))).otherwise(none)
    start_ = F.array(line("start", without("err")))
    page = F.concat(F.array(line("page", without("err", "displays", "actions"))),
                    F.coalesce(display, none), F.coalesce(action, none))
    lines = F.concat(error, F.when(F.col("start").isNotNull(), start_).otherwise(page))
    return p.select(F.inline(lines))


def run_log_split(raw: DataFrame, out_dir: str | None = None, name: str = "base_log",
                  bootstrap: str | None = None, tiebreak: str | None = None,
                  checkpoint: str | None = None, **start_kw) -> list[StreamingQuery]:
    """R1 as a job: the five outputs as JSON lines, to Kafka topics (``bootstrap``) or to files
    under ``out_dir`` (one ``kind=`` folder each), from one query that parses each record once
    for its state and once for its lines; dirty lines by a second, stateless query."""
    records, dirty = log_layer_stream(raw, tiebreak=tiebreak)
    base = checkpoint or checkpoint_dir(raw.sparkSession, os.path.join("streams", name))
    lines = log_lines(records)
    q1 = _to(lines.drop("kind") if bootstrap else lines, name,
             f"{out_dir}/lines", bootstrap, ("kind",), checkpoint=os.path.join(base, "records"), **start_kw)
    q2 = start(dirty, f"{name}_dirty", fmt="parquet", path=f"{out_dir or base}/dirty",
               checkpoint=os.path.join(base, "dirty"), **start_kw)
    return [q1, q2]


# ---- change feed jobs

def run_dim_app(feed: DataFrame, changes: DataFrame, tables: str, snapshot: DataFrame | None = None,
                name: str = "dim_app", evict_moved: bool = False, buckets: int = sinks.BUCKETS,
                **start_kw) -> StreamingQuery:
    """The dimension job (R7, R9, R10, K5, K6): each change is routed by the rule in force
    (:mod:`flowmart.streaming.rule_state`) and written to its dimension table under ``tables``.

    A table is created when its rule arrives (those of ``snapshot`` at the start), and every
    micro-batch upserts the columns that its changes name.  The loop goes over the tables of a
    batch, which are as many as it has rules, never over rows.
    """
    spark = feed.sparkSession
    if snapshot is not None:
        for r in config.snapshot(snapshot, "dim").toLocalIterator():  # one row per configured table
            sinks.create_wide(spark, f"{tables}/{r.sink_table}", r.sink_columns, r.sink_pk)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            target = ["sink_table", "sink_columns", "sink_pk"]
            for r in batch.where(F.col("kind") == rule_state.RULE).select(*target).distinct().collect():
                sinks.create_wide(spark, f"{tables}/{r.sink_table}", r.sink_columns, r.sink_pk)
            rows = batch.where(F.col("kind") == rule_state.ROW)
            cells = dim.plain_cells(dim.last_cells(dim.cells_of(dim.routed(rows)))).persist()
            names: dict[tuple, list[str]] = {}
            for r in rows.select(*target).distinct().collect():
                names.setdefault((r.sink_table, r.sink_pk), []).append(r.sink_columns)
            for (table, pk), columns in names.items():
                own = cells.where(F.col("sink_table") == table).drop("sink_table")
                sinks.upsert_wide(own, f"{tables}/{table}", ",".join(dict.fromkeys(",".join(columns).split(","))),
                                  pk, batch_id, buckets)
            cells.unpersist()
        finally:
            batch.unpersist()

    routed = rule_state.with_rules(feed, changes, "dim", snapshot, dim.ROUTED_TYPES, evict_moved)
    return start(routed, name, sink=upsert, **start_kw)


def run_fact_routing(feed: DataFrame, changes: DataFrame, path: str | None = None, bootstrap: str | None = None,
                     snapshot: DataFrame | None = None, name: str = "fact_routing",
                     **start_kw) -> StreamingQuery:
    """The fact-routing job (R8, K2): every configured change as a JSON record of its own topic, to
    Kafka (keyed by its record id) or to files (one folder per topic, each batch committed once)."""
    rows = rule_state.with_rules(feed, changes, "dwd", snapshot).where(F.col("kind") == rule_state.ROW)
    records = dwd.to_topic_records(dwd.routed(rows))
    if bootstrap:
        records = records.select("topic", F.col("record_id").alias("key"), "value")
    return _to(records, name, path, bootstrap, ("topic",), **start_kw)


def run_cart_add(feed: DataFrame, dic: DataFrame | Dimension, path: str | None = None,
                 bootstrap: str | None = None, name: str = "cart_add", topic: str = "dwd_trade_cart_add",
                 **start_kw) -> StreamingQuery:
    """The cart-add job: cart additions with their source name, as JSON lines.  The dictionary is
    looked up inside each micro-batch, as it is then."""
    names = Dimension.of(dic)

    def look_up(batch: DataFrame, batch_id: int) -> None:
        rows = sinks.kafka_value(trade.cart_add(batch, names.now())).withColumn("topic", F.lit(topic))
        if bootstrap:
            sinks.write_kafka(rows, bootstrap)
        else:
            sinks.write_batch_files(rows, batch_id, path)

    return start(feed, name, sink=look_up, **start_kw)


def run_order_detail(feed: DataFrame, dic: DataFrame | Dimension, path: str | None = None,
                     name: str = "order_detail", bootstrap: str | None = None,
                     topic: str = "dwd_trade_order_detail", ttl_ms: int | None = None,
                     **start_kw) -> StreamingQuery:
    """The order-detail job (J1-J3, T15): the joins run in keyed state
    (:mod:`flowmart.streaming.order_state`), and each change of a wide row is looked up in the
    dictionary as it is when the change is emitted, like the reference's last join.

    To an upsert topic (``bootstrap``) go the rows put in, keyed by detail id; files get the whole
    changelog, one partition per micro-batch (a replayed batch writes its own again), read by
    :func:`order_details`.
    """
    names = Dimension.of(dic)

    def look_up(batch: DataFrame, batch_id: int) -> None:
        log = lookup_join(batch, names.now().select("dic_code", "dic_name"), "source_type", "dic_code")
        if bootstrap:
            wide = log.where(F.col("op") != trade.BEFORE).select(*schemas.ORDER_DETAIL_OUT)
            sinks.write_kafka(sinks.kafka_value(wide, key=["id"]), bootstrap, topic)
        else:
            sinks.write_batch_files(log.select("op", "seq", *order_state.ARRIVAL, *schemas.ORDER_DETAIL_OUT),
                                    batch_id, path)

    return start(order_state.order_detail_changes(feed, ttl_ms), name, sink=look_up, **start_kw)


def order_details(spark: SparkSession, path: str) -> DataFrame:
    """The order-detail table that the job's changelog leaves."""
    return trade.fold_changelog(spark.read.parquet(path))


# ---- late rows

class LateRows(StreamingQueryListener):
    """Counts the rows that stateful operators drop as late (behind the watermark), per query.

    A listener gets the progress of every micro-batch, so nothing is polled and no report is missed;
    the reference drops late rows silently.  ``total(query)`` is the count so far."""

    def __init__(self, spark: SparkSession):
        self.counts: dict[str, int] = {}
        self.batches: dict[str, int] = {}
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        self.counts.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators)
        self.counts[str(p.id)] = self.counts.get(str(p.id), 0) + late
        self.batches[str(p.id)] = self.batches.get(str(p.id), 0) + 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, query: StreamingQuery) -> int:
        return self.counts.get(str(query.id), 0)


# ---- window jobs

DWS_JOBS = {
    "keyword": dws.keyword_window,
    "home_detail": dws.home_detail_window,
    "traffic": dws.traffic_window,
    "login": dws.login_window,
}


def run_dws_job(log: DataFrame, kind: str, name: str | None = None,
                jdbc: dict | None = None, path: str | None = None,
                size: str = "10 seconds", **start_kw) -> StreamingQuery:
    """The four DWS jobs (keyword, home/detail, traffic and login windows) on a page-log stream
    (:func:`flowmart.sources.streams.read_page_log`): the windowed metric,
    appended once its window closes, written per micro-batch to a JDBC table
    (K7: ``jdbc={"url":..., "table":...}``) or by Spark's file sink under ``path``."""
    result = DWS_JOBS[kind](log, size)
    if jdbc is None:
        return start(result, name or f"dws_{kind}", fmt="parquet", path=path, **start_kw)

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_jdbc(batch, jdbc["url"], jdbc["table"], properties=jdbc.get("properties"),
                         batch_id=batch_id if jdbc.get("with_batch_id") else None)

    return start(result, name or f"dws_{kind}", sink=write, **start_kw)
