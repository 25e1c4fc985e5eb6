"""Order detail over a change-feed stream (J1-J3, T15): late parts correct the rows."""

import itertools
import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from flowmart import schemas
from flowmart.operators import trade
from flowmart.operators.lookup import Dimension
from flowmart.sources import fixtures
from flowmart.sources.catalog import Tables
from flowmart.sources.streams import read_cdc
from flowmart.streaming import jobs
from tests.test_streaming import TIMEOUT, write_lines

SF = "/root/testdata/sf0.001"
SLICES = ["order_info", "order_detail", "order_detail_activity", "order_detail_coupon"]


def lines_of(feed):
    return [r.v for r in feed.select(F.to_json(F.struct(*schemas.CDC.fieldNames())).alias("v")).collect()]


def run(spark, folder, out, dic, ckpt, **kw):
    q = jobs.run_order_detail(read_cdc(spark, path=folder, max_files_per_trigger=1), dic, out, available_now=True,
                              checkpoint=ckpt, **kw)
    assert q.awaitTermination(TIMEOUT)
    return q


def bag(df, columns):
    return Counter(map(repr, df.select(columns).collect()))


def test_order_detail_job_equals_batch(spark, tmp):
    """The feed in four batches by table, the orders last: far apart, every part still joins."""
    feed = fixtures.topic_db(Tables(spark, SF))
    folder, out = os.path.join(tmp, "cdc"), os.path.join(tmp, "od")
    os.makedirs(folder)
    for i, table in enumerate(["order_detail_coupon", "order_detail", "order_detail_activity", "order_info"]):
        write_lines(folder, f"cdc-{i}.json", lines_of(feed.where(F.col("table") == table)), i)
    run(spark, folder, out, fixtures.base_dic(spark), os.path.join(tmp, "ckpt"))
    want = trade.order_detail(feed, fixtures.base_dic(spark))
    got = jobs.order_details(spark, out)
    assert sorted(got.columns) == sorted(want.columns)
    assert bag(got, want.columns) == bag(want, want.columns)


def change(table, ts, i, **data):
    return json.dumps({"database": "shop", "table": table, "type": "insert", "ts": ts, "xid": i, "xoffset": 0,
                       "data": data})


# one order of two details, one of which has two activities and a coupon; a part of nothing
PARTS = [("order_info", {"id": "o", "user_id": "u"}),
         ("order_detail", {"id": "d", "order_id": "o", "source_type": "A"}),
         ("order_detail", {"id": "e", "order_id": "o", "source_type": "A"}),
         ("order_detail_activity", {"id": "1", "order_id": "o", "order_detail_id": "d", "activity_id": "x"}),
         ("order_detail_activity", {"id": "2", "order_id": "o", "order_detail_id": "d", "activity_id": "y"}),
         ("order_detail_coupon", {"id": "3", "order_id": "o", "order_detail_id": "d", "coupon_id": "c"}),
         ("order_detail_coupon", {"id": "4", "order_id": "o", "order_detail_id": "nobody", "coupon_id": "z"})]
SEEN = ["op", "ts", "step", "id", "user_id", "activity_id", "coupon_id", "dic_name"]


def joined_one_by_one(parts):
    """The updating joins of one order, part by part: every version between two states, compared."""
    log, state, before = [], {t: [] for t in SLICES}, Counter()
    for ts, (table, data) in enumerate(parts):
        state[table].append(data)
        now = Counter()
        for o, d in itertools.product(state["order_info"], state["order_detail"]):
            own = lambda t, d=d: [x for x in state[t] if x["order_detail_id"] == d["id"]] or [{}]
            for a, c in itertools.product(own("order_detail_activity"), own("order_detail_coupon")):
                now[d["id"], o["user_id"], a.get("activity_id"), c.get("coupon_id")] += 1
        gone = before - now
        taken = {r[0] for r in gone}
        log += [("-U", ts, r) for r in gone.elements()]
        log += [("+U" if r[0] in taken else "+I", ts, r) for r in (now - before).elements()]
        before = now
    return Counter((op, ts, *r, "source A") for op, ts, r in log)


def seen(log):
    return Counter((r.op, r.ts, r.id, r.user_id, r.activity_id, r.coupon_id, r.dic_name) for r in log.collect())


def test_changelog_of_parts_in_every_order(spark):
    """Batch: sixty arrival orders of one order's parts, each an order of its own."""
    rng = random.Random(1)
    orders = [rng.sample(PARTS, len(PARTS)) for _ in range(60)] + [PARTS, PARTS[::-1]]
    rows, want = [], Counter()
    for n, parts in enumerate(orders):
        own = lambda v, n=n: f"{v}{n}" if v else v
        for i, (table, data) in enumerate(parts):
            named = {k: own(v) if k in ("id", "order_id", "order_detail_id") else v for k, v in data.items()}
            rows.append(("shop", table, "insert", i, 0, 0, named, None))
        want.update({(op, ts, own(d), u, a, c, s): k for (op, ts, d, u, a, c, s), k in joined_one_by_one(parts).items()})
    feed = spark.createDataFrame(rows, schemas.CDC)
    log = trade.order_detail_changelog(feed, fixtures.base_dic(spark))
    assert seen(log) == want
    table = trade.order_detail(feed, fixtures.base_dic(spark))
    assert bag(trade.fold_changelog(log), table.columns) == bag(table, table.columns)


def test_changes_of_one_arrival_time_follow_the_slices(spark):
    feed = spark.createDataFrame([("shop", t, "insert", 5, 0, 0, d, None) for t, d in PARTS], schemas.CDC)
    log = trade.order_detail_changelog(feed, fixtures.base_dic(spark))
    got = sorted((r.step, r.op, r.id, r.activity_id or "") for r in log.collect())
    assert got[:2] == [(1, "+I", "d", ""), (1, "+I", "e", "")]
    table = trade.order_detail(feed, fixtures.base_dic(spark))
    assert bag(trade.fold_changelog(log), table.columns) == bag(table, table.columns)


@pytest.mark.parametrize("seed", [0, 1])
def test_stream_changelog_equals_batch(spark, tmp, seed):
    """Some orders' parts in mixed order, over files: each batch's arrivals in event order."""
    rng = random.Random(seed)
    rows = []
    for n in range(8):
        for table, data in rng.sample(PARTS, len(PARTS)):
            rows.append((table, {k: f"{v}{n}" if k in ("id", "order_id", "order_detail_id") else v
                                 for k, v in data.items()}))
    folder, out = os.path.join(tmp, "cdc"), os.path.join(tmp, "od")
    os.makedirs(folder)
    text = [change(t, i, i, **d) for i, (t, d) in enumerate(rows)]
    for i in range(4):
        write_lines(folder, f"c-{i}.json", text[i * 14:(i + 1) * 14], i)
    run(spark, folder, out, fixtures.base_dic(spark), os.path.join(tmp, "ckpt"))
    feed = spark.createDataFrame([("shop", t, "insert", i, i, 0, d, None) for i, (t, d) in enumerate(rows)], schemas.CDC)
    want = trade.order_detail_changelog(feed, fixtures.base_dic(spark))
    got = spark.read.parquet(out)
    assert bag(got, SEEN) == bag(want, SEEN)
    table = trade.order_detail(feed, fixtures.base_dic(spark))
    assert bag(jobs.order_details(spark, out), table.columns) == bag(table, table.columns)
    # emission order: a version is taken back before its replacement
    per = {}
    for r in sorted(got.collect(), key=lambda r: (r.batch_id, r.order_id, r.seq)):
        per.setdefault((r.order_id, r.id), []).append(r.op)
    assert all(ops[i - 1] != "+U" or "-U" in ops[:i] for ops in per.values() for i in range(1, len(ops) + 1))


def test_state_is_cleared_by_event_time(spark, tmp):
    folder, out = os.path.join(tmp, "cdc"), os.path.join(tmp, "od")
    os.makedirs(folder)
    first = [change("order_detail", 1, 1, id="d", order_id="o", source_type="A"),
             change("order_info", 1, 2, id="o", user_id="u")]
    write_lines(folder, "a.json", first, 0)
    write_lines(folder, "b.json", [change("order_info", 500, 3, id="p", user_id="v")], 1)
    write_lines(folder, "c.json", [change("order_info", 501, 4, id="q", user_id="v")], 2)
    # the order is gone: its late activity finds nothing, one of a live order does
    write_lines(folder, "d.json", [change("order_detail_activity", 502, 5, id="a", order_id="o", order_detail_id="d"),
                                   change("order_detail", 502, 6, id="e", order_id="p", source_type="A")], 3)
    q = run(spark, folder, out, fixtures.base_dic(spark), os.path.join(tmp, "ckpt"), ttl_ms=60_000)
    assert sorted((r.op, r.id) for r in spark.read.parquet(out).collect()) == [("+I", "d"), ("+I", "e")]
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] < 20


def test_batches_read_what_they_change_only(spark, tmp):
    """Fifty batches of new orders: a batch reads its own file, and nothing that was stored before."""
    folder, out = os.path.join(tmp, "cdc"), os.path.join(tmp, "od")
    os.makedirs(folder)
    for i in range(50):
        write_lines(folder, f"c-{i:02}.json", [change("order_info", i, 1, id=f"o{i}", user_id="u"),
                                               change("order_detail", i, 2, id=f"d{i}", order_id=f"o{i}", source_type="A")],
                    i - 100)
    q = run(spark, folder, out, fixtures.base_dic(spark), os.path.join(tmp, "ckpt"))
    rows = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert len(rows) >= 50 and set(rows) == {rows[0]}
    assert jobs.order_details(spark, out).count() == 50
    assert sorted(os.listdir(out))[0] == "_SUCCESS" or all(f.startswith(("batch_id=", "_", ".")) for f in os.listdir(out))


@pytest.mark.parametrize("kind", ["cart", "order"])
def test_a_name_added_while_the_job_runs(spark, tmp, kind):
    """The dictionary is listed again in each batch: a new source type is found by later changes."""
    folder, out, dic = (os.path.join(tmp, x) for x in ("cdc", "out", "dic"))
    os.makedirs(folder)
    fixtures.values_table(spark, [("A", "one", None, None, None)], schemas.BASE_DIC).write.parquet(dic)

    def part(i, code):
        if kind == "cart":
            return [change("cart_info", i, i, id=f"d{i}", source_type=code)]
        return [change("order_info", i, i, id=f"o{i}"),
                change("order_detail", i, i, id=f"d{i}", order_id=f"o{i}", source_type=code)]

    names = Dimension(lambda: spark.read.parquet(dic))
    ckpt = os.path.join(tmp, "ckpt")
    job = jobs.run_cart_add if kind == "cart" else jobs.run_order_detail
    q = job(read_cdc(spark, path=folder), names, out, trigger="200 milliseconds", checkpoint=ckpt)
    try:
        write_lines(folder, "a.json", part(1, "A") + part(2, "B"), 0)
        q.processAllAvailable()
        fixtures.values_table(spark, [("B", "two", None, None, None)], schemas.BASE_DIC).write.mode("append").parquet(dic)
        write_lines(folder, "b.json", part(3, "B") + part(4, "C"), 1)
        q.processAllAvailable()
    finally:
        q.stop()
    rows = spark.read.parquet(out)
    if kind == "cart":
        rows = rows.select(F.get_json_object("value", "$.id").alias("id"),
                           F.get_json_object("value", "$.dic_name").alias("dic_name"))
    assert sorted((r.id, r.dic_name) for r in rows.collect()) == [("d1", "one"), ("d3", "two")]


def test_refresh_interval(spark):
    reads = []
    d = Dimension(lambda: reads.append(1), every_s=3600)
    d.now(), d.now()
    assert len(reads) == 2  # nothing read yet is no copy
    d = Dimension(lambda: reads.append(1) or spark.range(1), every_s=3600)
    assert d.now() is d.now() and len(reads) == 3
    d = Dimension(lambda: reads.append(1) or spark.range(1))
    d.now(), d.now()
    assert len(reads) == 5
