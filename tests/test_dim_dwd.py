import json

from pyspark.sql import functions as F

from flowmart import schemas
from flowmart.operators import config, dim, dwd, lookup, parse, trade
from flowmart.sources import fixtures


def cfg(src, sink_type="dim", cols="id,name", pk="id", stype=None, sink=None):
    return (src, stype, sink or f"dim_{src}", sink_type, cols, pk, None)


def changes(spark, rows):
    return spark.createDataFrame(rows, schemas.CONFIG_CHANGE)


def test_config_insert_update_delete(spark):
    rows = [(None, cfg("t1"), "c", 1), (cfg("t1"), cfg("t1", cols="id,x"), "u", 2),
            (None, cfg("t2"), "c", 3), (cfg("t2"), None, "d", 4),
            (None, cfg("t3", sink_type="dwd"), "c", 5)]
    out = {r.config_key: r.sink_columns for r in config.fold_changes(changes(spark, rows)).collect()}
    assert out == {"t1": "id,x"}


def test_config_moved_key(spark):
    rows = [(None, cfg("old"), "c", 1), (cfg("old"), cfg("new"), "u", 2)]
    lit = {r.config_key for r in config.fold_changes(changes(spark, rows)).collect()}
    assert lit == {"old", "new"}
    evict = {r.config_key for r in config.fold_changes(changes(spark, rows), evict_moved=True).collect()}
    assert evict == {"new"}


def test_config_preload(spark):
    pre = spark.createDataFrame([cfg("p"), cfg("q")], schemas.CONFIG)
    rows = [(cfg("q"), None, "d", 1), (None, cfg("r"), "c", 2)]
    out = {r.config_key for r in config.fold_changes(changes(spark, rows), preload=pre).collect()}
    assert out == {"p", "r"}


def test_prune_exact_split(spark):
    df = spark.createDataFrame([({"id": "1", "name": "n", "x": "2", "y": "3"}, "id,name, x")],
                               "data map<string,string>, cols string")
    assert df.select(config.prune("data", "cols")).first()[0] == {"id": "1", "name": "n"}


def test_pk_default(spark):
    df = spark.createDataFrame([(None,), ("",), ("k",)], "pk string")
    assert [r[0] for r in df.select(config.pk_or_default("pk")).collect()] == ["id", "id", "k"]


def test_upsert_null_and_partial(spark):
    feed = spark.createDataFrame([
        ("shop", "t", "insert", 1, 1, 0, {"id": "1", "name": "a", "v": "x"}, None),
        ("shop", "t", "update", 2, 2, 0, {"id": "1", "v": None}, None),
        ("shop", "t", "delete", 3, 3, 0, {"id": "1", "name": "zzz"}, None),
    ], schemas.CDC)
    conf = config.snapshot(spark.createDataFrame([cfg("t", cols="id,name,v", pk=None)],
                                                 schemas.CONFIG), "dim")
    routed = dim.route(feed, conf)
    cells = {r.column: r.value for r in dim.upsert_fold(routed).collect()}
    assert cells == {"id": "1", "name": "a", "v": ""}
    raw = {r.column: r.value for r in dim.upsert_fold(routed, null_as_empty=False).collect()}
    assert raw["v"] is None


def test_last_change_of_a_second_wins_whatever_its_value(spark):
    feed = spark.createDataFrame([
        ("shop", "t", "update", 5, 7, 1, {"id": "1", "v": "10"}, None),
        ("shop", "t", "update", 5, 7, 0, {"id": "1", "v": "9"}, None),
        ("shop", "t", "update", 5, 6, 9, {"id": "1", "v": "99"}, None),
    ], schemas.CDC)
    conf = config.snapshot(spark.createDataFrame([cfg("t", cols="id,v")], schemas.CONFIG), "dim")
    assert {r.column: r.value for r in dim.upsert_fold(dim.route(feed, conf)).collect()}["v"] == "10"


def test_schema_rows_and_ddl(spark):
    conf = spark.createDataFrame([("t", None, "dim_t", "dim", "id,name", "", None)], schemas.CONFIG)
    rows = dim.schema_rows(conf)
    assert [(r.column_name, r.is_pk) for r in rows.orderBy("position").collect()] == [
        ("id", True), ("name", False)]
    text = dim.ddl(rows).first().ddl
    assert text == "create table if not exists REALTIME_DIM.dim_t (id varchar primary key, name varchar) "


def test_lookup_drops_unmatched(spark):
    df = spark.createDataFrame([("1", "A"), ("2", "R")], "id string, source_type string")
    out = lookup.lookup_join(df, fixtures.base_dic(spark), "source_type", "dic_code")
    assert [r.id for r in out.collect()] == ["1"]


def _feed(spark, rows):
    return spark.createDataFrame([("shop", t, "insert", 1, None, None, d, None) for t, d in rows], schemas.CDC)


def test_order_detail_joins(spark):
    feed = _feed(spark, [
        ("order_detail", {"id": "d1", "order_id": "o1", "source_type": "A"}),
        ("order_detail", {"id": "d2", "order_id": "o9", "source_type": "A"}),  # no order
        ("order_detail", {"id": "d3", "order_id": "o1", "source_type": "A"}),
        ("order_info", {"id": "o1", "user_id": "u"}),
        ("order_detail_activity", {"id": "a", "order_detail_id": "d1", "activity_id": "act"}),
        ("order_detail_coupon", {"id": "c", "order_detail_id": "d3", "coupon_id": "cp"}),
    ])
    out = {r.id: r for r in trade.order_detail(feed, fixtures.base_dic(spark)).collect()}
    assert set(out) == {"d1", "d3"}
    assert out["d1"].activity_id == "act" and out["d1"].coupon_id is None
    assert out["d3"].activity_id is None and out["d3"].coupon_id == "cp"
    assert len(trade.order_detail(feed, fixtures.base_dic(spark)).columns) == 37


def test_dwd_route_and_topics(spark):
    feed = spark.createDataFrame([
        ("shop", "cart_info", "insert", 1, None, None, {"id": "1", "sku_id": "s", "junk": "j"}, None),
        ("shop", "cart_info", "update", 1, None, None, {"id": "1"}, None),
    ], schemas.CDC)
    conf = config.snapshot(spark.createDataFrame(
        [cfg("cart_info", "dwd", "id,sku_id", stype="insert", sink="dwd_cart")], schemas.CONFIG), "dwd")
    routed = dwd.route(feed, conf)
    recs = dwd.to_topic_records(routed).collect()
    assert [(r.topic, json.loads(r.value)) for r in recs] == [("dwd_cart", {"id": "1", "sku_id": "s"})]


def test_record_ids_tell_replays_from_new_records(spark):
    row = ("shop", "cart_info", "insert", 1, 5, 0, {"id": "1", "sku_id": "s"}, None)
    feed = spark.createDataFrame([row, row, (*row[:4], 6, *row[5:]), (*row[:6], {"id": "2"}, None)], schemas.CDC)
    conf = config.snapshot(spark.createDataFrame(
        [cfg("cart_info", "dwd", "id,sku_id", stype="insert", sink="dwd_cart")], schemas.CONFIG), "dwd")
    ids = [r.record_id for r in dwd.to_topic_records(dwd.route(feed, conf)).collect()]
    assert len(ids) == 4 and len(set(ids)) == 3 and all(len(i) == 64 for i in ids)


def test_q1_guard(spark):
    df = spark.createDataFrame([("",), (None,), ("  ",), ("{}",)], "value string")
    good, dirty = parse.parse_cdc(df)
    assert good.count() == 0 and [r.value for r in dirty.collect()] == ["{}"]
