"""As-of joins: rules and dictionary rows as they were when a change came."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmart import schemas
from flowmart.operators import asof, config, dim, dwd, lookup


def brute(times, versions):
    out = []
    for k, t in sorted(set((k, t) for k, t in times if k is not None and t is not None)):
        before = [(a, v) for key, a, v in versions if key == k and a <= t]
        if before:
            out.append((k, t, max(before)[1]))
    return out


@pytest.mark.parametrize("bucket,span", [(1, 50), (10, 300), (1000, 300), (7, 5000)])
def test_versions_at_equal_brute_force(spark, bucket, span):
    rng = random.Random(bucket)
    versions = sorted({(k, rng.randrange(-span, span)) for k in "abc" for _ in range(12)}
                      | {("d", -(1 << 62)), ("b", 0), ("b", bucket), ("b", bucket - 1)})
    versions = [(k, a, f"{k}{a}") for k, a in versions]
    times = [(rng.choice(["a", "b", "c", "d", "nobody", None]), rng.randrange(-span, span)) for _ in range(400)]
    times += [("b", 0), ("b", -1), ("b", bucket), ("b", bucket - 1), ("a", None)] + [("a", 3)] * 200
    got = asof.versions_at(spark.createDataFrame(times, "key string, at bigint"),
                           spark.createDataFrame(versions, "key string, at bigint, value string"), bucket)
    assert sorted(tuple(r) for r in got.select("key", "at", "value").collect()) == brute(times, versions)


def test_no_versions_and_no_rows(spark):
    times = spark.createDataFrame([("a", 1)], "key string, at bigint")
    none = spark.createDataFrame([], "key string, at bigint, value string")
    assert asof.versions_at(times, none, 10).count() == 0
    assert asof.versions_at(times.limit(0), none, 10).count() == 0


def rule(table, sink, columns, layer="dim", kind="insert"):
    return (table, kind, sink, layer, columns, "id", None)


def feed(spark, rows):
    return spark.createDataFrame(
        [("shop", table, kind, ts, i, 0, {"id": str(i), "a": "1", "b": "2"}, None)
         for i, (table, kind, ts) in enumerate(rows)], schemas.CDC)


def changes(spark, rows):
    return spark.createDataFrame([(b, a, op, ts, i) for i, (b, a, op, ts) in enumerate(rows)],
                                 T.StructType([*schemas.CONFIG_CHANGE.fields, T.StructField("seq", T.LongType())]))


def test_rules_changed_and_deleted_in_mid_feed(spark):
    t1, t2 = rule("t", "dim_1", "id,a"), rule("t", "dim_2", "id,b")
    history = changes(spark, [
        (None, t1, "c", 10_000), (t1, t2, "u", 20_000), (t2, None, "d", 30_000), (None, t1, "c", 40_500),
        (None, rule("u", "dim_x", "id"), "c", 20_000), (None, rule("u", "dim_u", "id"), "u", 20_000)])
    f = feed(spark, [("t", "insert", s) for s in (9, 10, 19, 20, 29, 30, 39, 40, 41)]
             + [("u", "update", 20), ("u", "delete", 25), ("p", "insert", 1), ("nobody", "insert", 50)])
    pre = spark.createDataFrame([rule("p", "dim_p", "a"), rule("t", "dim_0", "b")], schemas.CONFIG)

    def routed(preload, bucket=config.DAY_MS):
        rules = config.rule_versions(history, "dim", seq="seq", preload=preload)
        return sorted((r.table, r.ts, r.sink_table, sorted(r.data)) for r in dim.route_asof(f, rules, bucket=bucket).collect())

    want = [("t", 10, "dim_1", ["a", "id"]), ("t", 19, "dim_1", ["a", "id"]), ("t", 20, "dim_2", ["b", "id"]),
            ("t", 29, "dim_2", ["b", "id"]), ("t", 41, "dim_1", ["a", "id"]), ("u", 20, "dim_u", ["id"])]
    assert routed(None) == want and routed(None, bucket=3000) == want
    # a preloaded rule holds until its first change; a delete drops both
    assert routed(pre) == sorted([*want, ("p", 1, "dim_p", ["a"]), ("t", 9, "dim_0", ["b"])])


def test_a_moved_rule_keeps_its_old_key_unless_evicted(spark):
    old, new = rule("t", "dim_t", "id"), rule("v", "dim_v", "id")
    history = changes(spark, [(None, old, "c", 1000), (old, new, "u", 2000)])
    f = feed(spark, [("t", "insert", 1), ("t", "insert", 3), ("v", "insert", 3)])
    for evict, want in ((False, [("t", 1), ("t", 3), ("v", 3)]), (True, [("t", 1), ("v", 3)])):
        rules = config.rule_versions(history, "dim", evict_moved=evict, seq="seq")
        assert sorted((r.table, r.ts) for r in dim.route_asof(f, rules).collect()) == want


def test_fact_rules_go_by_table_and_type(spark):
    history = changes(spark, [(None, rule("t", "x", "id", "dwd", "insert"), "c", 1000),
                              (None, rule("t", "y", "id", "dwd", "update"), "c", 1000),
                              (rule("t", "y", "id", "dwd", "update"), None, "d", 5000)])
    f = feed(spark, [("t", "insert", 2), ("t", "update", 2), ("t", "update", 5), ("t", "delete", 2)])
    got = dwd.route_asof(f, config.rule_versions(history, "dwd", seq="seq")).collect()
    assert sorted((r.sink_table, r.type, r.ts) for r in got) == [("x", "insert", 2), ("y", "update", 2)]


def test_the_last_rule_is_the_folded_one(spark):
    """Routed after all changes, the history gives what the folded configuration gives."""
    rng = random.Random(3)
    rows = []
    for i in range(200):
        r = rule(rng.choice("tuvw"), f"s{i}", "id,a" if i % 2 else "id,b", rng.choice(["dim", "dwd"]))
        rows.append((r, None, "d", i // 3) if i % 5 == 0 else (None, r, "u", i // 3))
    history = changes(spark, rows)
    f = feed(spark, [(t, "insert", 10_000) for t in "tuvw"])
    asof_ = dim.route_asof(f, config.rule_versions(history, "dim", seq="seq"))
    now = dim.route(f, config.fold_changes(history, "dim", seq="seq"))
    key = lambda df: sorted((r.sink_table, r.table, sorted(r.data)) for r in df.collect())
    assert key(asof_) == key(now)


def test_dictionary_names_as_they_were(spark):
    history = spark.createDataFrame(
        [("A", "one", 1000, False, 1), ("A", "two", 2000, False, 2), ("A", "three", 2000, False, 3),
         ("A", None, 3000, True, 4), (None, "x", 1, False, 5)],
        "code string, name string, at bigint, gone boolean, seq bigint")
    v = lookup.dim_versions(history, "code", "at", ["name"], F.col("gone"), "seq")
    df = spark.createDataFrame([(t, c) for t in (0, 1, 2, 3) for c in ("A", "B", None)], "ts bigint, c string")
    got = lookup.lookup_asof(df, v, "c", F.col("ts") * 1000).collect()
    assert sorted((r.ts, r.c, r.name) for r in got) == [(1, "A", "one"), (2, "A", "three")]


def test_a_hot_key_is_combined_before_the_shuffle(spark):
    times = spark.createDataFrame([("t", 5)] * 10, "key string, at bigint")
    v = spark.createDataFrame([("t", 1, "x")], "key string, at bigint, value string")
    plan = asof.versions_at(times, v, 10)._jdf.queryExecution().executedPlan().toString()
    # the window runs over distinct times and versions only, and nothing is joined but by equality
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "partial_" in plan


def test_only_columns_that_some_rule_of_the_key_keeps_are_carried(spark):
    history = changes(spark, [(None, rule("t", "x", "id,a"), "c", 1000), (None, rule("t", "y", "id, b"), "u", 2000),
                              (None, rule("u", "z", "b"), "c", 1000), (rule("w", "w", "id"), None, "d", 1000)])
    f = feed(spark, [("t", "insert", 1), ("t", "insert", 2), ("u", "insert", 1), ("w", "insert", 2)])
    rules = config.rule_versions(history, "dim", seq="seq")
    got = sorted((r.table, r.ts, dict(r.data)) for r in dim.route_asof(f, rules).collect())
    assert got == [("t", 1, {"id": "0", "a": "1"}), ("t", 2, {"id": "1"}), ("u", 1, {"b": "2"})]
    none = dim.route_asof(f, rules.where("false"))
    assert none.count() == 0


def test_the_times_are_looked_for_once(spark, tmp):
    """The rows are read for their times once, not for the versions inside the buckets and again for the carried ones."""
    spark.createDataFrame([("t", i) for i in range(50)], "key string, at bigint").write.parquet(f"{tmp}/times")
    spark.createDataFrame([("t", 7, "x"), ("t", 21, "y")], "key string, at bigint, value string").write.parquet(f"{tmp}/v")
    got = asof.versions_at(spark.read.parquet(f"{tmp}/times"), spark.read.parquet(f"{tmp}/v"), 10)
    run = got.select("key", "at", "value")
    assert len(run.collect()) == 43
    plan = run._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("/times") == 1 and "ReusedExchange" in plan


def test_prune_without_columns(spark):
    df = spark.createDataFrame([({"id": "1", "a,b": "2", "": "3"}, c) for c in ("id,a,b", "a,b,", "", " id", None)],
                               "data map<string,string>, cols string")
    got = [r[0] for r in df.select(config.prune("data", "cols")).collect()]
    assert got == [{"id": "1"}, {"": "3"}, {"": "3"}, {}, {}]
