"""Stream jobs: log split (one parse, five outputs + dirty) and the dimension
upsert through foreachBatch, each compared with the batch operators."""

import json
import os

import pytest
from pyspark.sql import functions as F

from flowmart import schemas
from flowmart.operators import config, dim, dwd, logsplit
from flowmart.sources import files, fixtures
from flowmart.sources.catalog import Tables
from flowmart.sources.streams import (dirty_lines, read_cdc, read_config_changes, read_records_once,
                                      read_text_stream)
from flowmart.streaming import jobs, sinks
from tests.test_streaming import TIMEOUT, write_lines

SF = "/root/testdata/sf0.001"


def test_log_split_stream_equals_batch(spark, tmp):
    raw = fixtures.ods_log_text(Tables(spark, SF)).toPandas()
    # arrival in event order: sort by the ts inside the text (dirty lines too)
    raw["ts"] = raw["value"].str.extract(r'"ts":"?(\d+)"?[^\[]*$')[0].astype(float)
    raw = raw.sort_values(["ts", "event_id"])
    folder = os.path.join(tmp, "ods")
    os.makedirs(folder)
    for i, part in enumerate([raw.iloc[:500], raw.iloc[500:]]):
        write_lines(folder, f"ods-{i}.txt", list(part["value"]), i)
    out = os.path.join(tmp, "out")
    stream = read_text_stream(spark, path=folder, max_files_per_trigger=1)
    for q in jobs.run_log_split(stream, out, available_now=True,
                                checkpoint=os.path.join(tmp, "ckpt")):
        assert q.awaitTermination(TIMEOUT)
        q.stop()
    batch = logsplit.log_layer(spark.read.text(folder))
    lines = spark.read.parquet(os.path.join(out, "lines"))
    for kind, df in logsplit.json_outputs(batch).items():
        got = sorted(r.value for r in lines.where(F.col("kind") == kind).collect())
        assert got == sorted(r.value for r in df.collect()), kind
    assert spark.read.parquet(os.path.join(out, "dirty")).count() == batch["dirty"].count()


def test_kafka_values_and_options(spark):
    from flowmart.sources.streams import kafka_options
    df = spark.createDataFrame([("t1", "a", None)], "topic string, x string, y string")
    out = sinks.kafka_value(df).collect()[0]
    assert out.topic == "t1" and json.loads(out.value) == {"x": "a"}
    opts = kafka_options("h:9092", "topic_log", "g1", max_offsets_per_trigger=100_000)
    assert opts["subscribe"] == "topic_log" and opts["kafka.group.id"] == "g1"
    assert opts["maxOffsetsPerTrigger"] == "100000"
    assert opts["startingOffsets"] == "earliest" and "failOnDataLoss" not in opts


def test_routed_files(spark, tmp):
    df = spark.createDataFrame([("a", "1"), ("b", "2")], "topic string, value string")
    for _ in range(2):  # a replayed batch adds nothing
        sinks.write_routed_files(df, os.path.join(tmp, "r"), 4)
    assert sorted(os.listdir(os.path.join(tmp, "r")))[-2:] == ["topic=a", "topic=b"]
    assert spark.read.parquet(os.path.join(tmp, "r")).count() == 2
    keyed = sinks.kafka_value(spark.createDataFrame([("1", "x")], "id string, v string"), key=["id"]).first()
    assert keyed.key == '{"id":"1"}' and json.loads(keyed.value) == {"id": "1", "v": "x"}


def config_lines(spark, rows):
    changes = spark.createDataFrame(rows, schemas.CONFIG_CHANGE)
    return [r.v for r in changes.select(F.to_json(F.struct("before", "after", "op", "ts_ms")).alias("v")).collect()]


def dim_app(spark, tmp, **kw):
    q = jobs.run_dim_app(read_cdc(spark, path=os.path.join(tmp, "feed"), max_files_per_trigger=1),
                         read_config_changes(spark, path=os.path.join(tmp, "config"), max_files_per_trigger=1),
                         os.path.join(tmp, "dims"), buckets=4, available_now=True,
                         checkpoint=os.path.join(tmp, "ckpt"), **kw)
    assert q.awaitTermination(TIMEOUT)


def folders(tmp):
    for name in ("feed", "config"):
        os.makedirs(os.path.join(tmp, name))
    return os.path.join(tmp, "feed"), os.path.join(tmp, "config")


def dim_rows(spark, tmp, table):
    df = sinks.read_wide(spark, os.path.join(tmp, "dims", table))
    return sorted(tuple(r) for r in df.collect())


def row(table, ts, kind="insert", **data):
    return json.dumps({"database": "shop", "table": table, "type": kind, "ts": ts, "xid": ts, "xoffset": 0, "data": data})


def rule(table, sink, columns, layer="dim", pk="id", kind="insert"):
    return (table, kind, sink, layer, columns, pk, None)


def test_dim_app_fills_the_tables_of_a_snapshot(spark, tmp):
    """The whole feed over three batches, routed by the preloaded rules: the tables hold the fold."""
    feed, conf = folders(tmp)
    t = Tables(spark, SF)
    lines = [r.value for r in fixtures.topic_db_text(t).collect()]
    for i in range(3):
        write_lines(feed, f"f-{i}.json", lines[i::3], i)
    snap = fixtures.config_snapshot(spark)
    dim_app(spark, tmp, snapshot=snap)
    want = dim.upsert_fold(dim.route(fixtures.topic_db(t), config.snapshot(snap, "dim")))
    for r in config.snapshot(snap, "dim").collect():
        cells = want.where(F.col("sink_table") == r.sink_table)
        columns = r.sink_columns.split(",")
        assert sinks.read_wide(spark, os.path.join(tmp, "dims", r.sink_table)).columns == columns
        full = cells.groupBy("pk").pivot("column", columns).agg(F.first("value")).select(*columns)
        # the balance of a user changes in two batches: a later batch wins, as in the reference
        same = [c for c in columns if c != "balance"]
        got = sinks.read_wide(spark, os.path.join(tmp, "dims", r.sink_table))
        assert sorted(map(repr, got.select(*[F.col(f"`{c}`") for c in same]).collect())) == sorted(
            map(repr, full.select(*[F.col(f"`{c}`") for c in same]).collect()))


def test_rules_before_among_and_after_the_data(spark, tmp):
    """Three starts of one job: rules come first, with the rows, and after them."""
    feed, conf = folders(tmp)
    write_lines(conf, "c-0.json", config_lines(spark, [(None, rule("t", "dim_t", "id,a"), "c", 1000)]), 0)
    dim_app(spark, tmp)  # a rule, no row: its table is there
    assert dim_rows(spark, tmp, "dim_t") == []

    write_lines(feed, "f-1.json", [row("t", 5, id="1", a="x", b="y"), row("u", 5, id="1", a="x")], 1)
    dim_app(spark, tmp)  # before the data; u has no rule yet
    assert dim_rows(spark, tmp, "dim_t") == [("1", "x")]

    # among the data: rows up to second 9 by the old rule, then a wider one; the rule of u is late
    write_lines(conf, "c-2.json", config_lines(spark, [
        (rule("t", "dim_t", "id,a"), rule("t", "dim_t", "id,a,b"), "u", 10_000),
        (None, rule("u", "dim_u", "id"), "c", 20_000)]), 2)
    write_lines(feed, "f-2.json", [row("t", 9, id="2", a="x", b="no"), row("t", 10, id="3", a="x", b="yes"),
                                   row("u", 19, id="2", a="x"), row("u", 20, id="3", a="x")], 2)
    dim_app(spark, tmp)
    assert dim_rows(spark, tmp, "dim_t") == [("1", "x", None), ("2", "x", None), ("3", "x", "yes")]
    assert dim_rows(spark, tmp, "dim_u") == [("3",)]

    # after the data: a deleted rule routes nothing more, whatever the row's time
    write_lines(conf, "c-3.json", config_lines(spark, [(rule("t", "dim_t", "id,a,b"), None, "d", 30_000)]), 3)
    dim_app(spark, tmp)
    write_lines(feed, "f-4.json", [row("t", 5, id="4", a="x"), row("u", 5, id="4")], 4)
    dim_app(spark, tmp)
    assert [r[0] for r in dim_rows(spark, tmp, "dim_t")] == ["1", "2", "3"]
    assert [r[0] for r in dim_rows(spark, tmp, "dim_u")] == ["3", "4"]


def test_a_preloaded_rule_is_replaced_and_deleted(spark, tmp):
    feed, conf = folders(tmp)
    snap = spark.createDataFrame([rule("t", "dim_t", "id,a", pk=""), rule("g", "dim_g", "id"),
                                  rule("f", "fact", "id", "dwd")], schemas.CONFIG)
    write_lines(feed, "f-0.json", [row("t", 1, id="1", a="x", b="y"), row("g", 1, id="1"), row("f", 1, id="1"),
                                   row("t", 1, "delete", id="9", a="x")], 0)
    dim_app(spark, tmp, snapshot=snap)
    assert dim_rows(spark, tmp, "dim_t") == [("1", "x")] and dim_rows(spark, tmp, "dim_g") == [("1",)]
    # two changes of one millisecond apply in the order read
    write_lines(conf, "c-1.json", config_lines(spark, [
        (None, rule("t", "dim_t", "id"), "u", 2000), (None, rule("t", "dim_t", "id,b"), "u", 2000),
        (rule("g", "dim_g", "id"), None, "d", 2000)]), 1)
    write_lines(feed, "f-1.json", [row("t", 3, id="2", a="x", b="y"), row("g", 3, id="2")], 1)
    dim_app(spark, tmp, snapshot=snap)
    got = sinks.read_wide(spark, os.path.join(tmp, "dims", "dim_t")).select("id", "a", "b").collect()
    assert sorted(map(tuple, got)) == [("1", "x", None), ("2", None, "y")]
    assert dim_rows(spark, tmp, "dim_g") == [("1",)]


def test_fact_routing_job(spark, tmp):
    t = Tables(spark, SF)
    feed, conf = folders(tmp)
    write_lines(feed, "f-0.json", [r.value for r in fixtures.topic_db_text(t).collect()], 0)
    snap = fixtures.config_snapshot(spark)
    q = jobs.run_fact_routing(read_cdc(spark, path=feed), read_config_changes(spark, path=conf),
                              os.path.join(tmp, "facts"), snapshot=snap, available_now=True,
                              checkpoint=os.path.join(tmp, "k1"))
    assert q.awaitTermination(TIMEOUT)
    want = dwd.to_topic_records(dwd.route(fixtures.topic_db(t), config.snapshot(snap, "dwd")))

    def records(df):  # keys come in the order of the text read
        return sorted((r.topic, r.ts, sorted(json.loads(r.value).items())) for r in df.collect())

    got = spark.read.parquet(os.path.join(tmp, "facts"))
    assert records(got) == records(want) and got.select("record_id").distinct().count() == got.count()


def test_records_written_again_are_read_once(spark, tmp):
    """An at-least-once sink writes a batch twice, and part of one a third time."""
    rows = [(f"{i:064}", 100 + i, "{}", "t") for i in range(20)]
    folder = os.path.join(tmp, "topic")
    for i, part in enumerate((rows[:10], rows[:10], rows[5:], rows[12:14])):
        (spark.createDataFrame(part, "record_id string, ts bigint, value string, topic string").coalesce(1)
         .write.mode("append").parquet(folder))
    q = (read_records_once(spark, path=folder, max_files_per_trigger=1).writeStream.queryName("once").format("memory")
         .option("checkpointLocation", os.path.join(tmp, "c")).trigger(availableNow=True).start())
    assert q.awaitTermination(TIMEOUT)
    assert sorted(r.record_id for r in spark.table("once").collect()) == [r[0] for r in rows]


def test_malformed_lines_are_not_lost(spark, tmp):
    folder = os.path.join(tmp, "in")
    os.makedirs(folder)
    write_lines(folder, "a.json", ['{"database":"d","table":"t","type":"insert","ts":1,"data":{"id":"1"}}', "{bad"], 0)
    q = read_cdc(spark, path=folder).writeStream.queryName("strict_cdc").format("memory").trigger(
        availableNow=True).option("checkpointLocation", os.path.join(tmp, "s")).start()
    with pytest.raises(Exception, match="malformed record"):
        q.awaitTermination(TIMEOUT)
    for name, df, n in (("good_cdc", read_cdc(spark, strict=False, path=folder), 1),
                        ("dirty_cdc", dirty_lines(read_text_stream(spark, path=folder)), 1)):
        q = df.writeStream.queryName(name).format("memory").trigger(availableNow=True).option(
            "checkpointLocation", os.path.join(tmp, name)).start()
        assert q.awaitTermination(TIMEOUT)
        assert spark.table(name).count() == n


def test_insert_into_column_order(spark, tmp):
    df = spark.createDataFrame([("b", "a")], "y string, x string")
    sinks.insert_into(df, ["x", "y"], os.path.join(tmp, "t"))
    assert spark.read.parquet(os.path.join(tmp, "t")).columns == ["x", "y"]


def test_config_stream_startup_modes(spark, tmp):
    """S5 keeps the snapshot rows ('r') then changes; S6 (latest) only changes since the start."""
    folder = os.path.join(tmp, "cfgc")
    os.makedirs(folder)
    line = '{"before":null,"after":{"source_table":"%s","sink_type":"dim"},"op":"%s","ts_ms":%d}'
    write_lines(folder, "c.json", [line % ("a", "r", 1), line % ("old", "c", 2), line % ("b", "c", 1000)], 0)
    for startup, kw, want in (("initial", {}, ["a", "b", "old"]), ("latest", {"since_ms": 1000}, ["b"]),
                              ("latest", {"name": os.path.basename(tmp)}, [])):
        name = f"cfg_{startup}_{'_'.join(kw)}"
        q = (read_config_changes(spark, startup=startup, path=folder, **kw).select("after.source_table")
             .writeStream.queryName(name).format("memory")
             .option("checkpointLocation", os.path.join(tmp, name)).trigger(availableNow=True).start())
        assert q.awaitTermination(TIMEOUT)
        q.stop()
        assert sorted(r.source_table for r in spark.table(name).collect()) == want


def test_the_first_start_is_remembered(spark, tmp):
    path = os.path.join(tmp, "x", "job.started")
    assert files.first_time(spark, path, 1000) == 1000
    assert files.first_time(spark, path, 2000) == 1000
