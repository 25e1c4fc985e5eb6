"""Routing configuration kept up to date from its change feed.

The reference keeps the configuration in broadcast state: a delete removes
the key of ``before``, any other change puts ``after`` under its key, and
only rows of the layer's own sink_type count.  The batch form folds a change
history into the current table: every change "touches" one or two keys; the
last touch of a key (by change time, then sequence) decides whether the key
is present.  This is a ``max_by`` aggregate per key -- partial, skew-proof.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.functions.timefn import DAY_MS
from flowmart.operators.asof import asof_join
from flowmart.schemas import CONFIG_FIELDS

PUT, REMOVE = "put", "remove"
#: the time from which a preloaded rule holds, before any change
START = -(1 << 62)


def config_key(cfg: str, layer: str) -> Column:
    """DIM keys by source table; DWD by ``source_table || '_' || source_type``."""
    if layer == "dwd":
        return F.concat(F.col(f"{cfg}.source_table"), F.lit("_"), F.col(f"{cfg}.source_type"))
    return F.col(f"{cfg}.source_table")


def touches(changes: DataFrame, layer: str, evict_moved: bool = False, seq: str | None = None) -> DataFrame:
    """The keys that each change touches: ``config_key``, ``_o`` (change time and sequence),
    ``_action`` (put or remove) and ``_cfg`` (the row put or removed)."""
    order = F.struct(F.col("ts_ms"), (F.col(seq) if seq else F.lit(0)).alias("seq"))
    is_d = F.col("op") == "d"

    def touch(cond: Column, cfg: str, action: str) -> Column:
        return F.when(cond, F.struct(config_key(cfg, layer).alias("config_key"),
                                     F.lit(action).alias("_action"), F.col(cfg).alias("_cfg")))

    found = [
        touch(is_d & (F.col("before.sink_type") == layer), "before", REMOVE),
        touch(~is_d & (F.col("after.sink_type") == layer), "after", PUT),
    ]
    if evict_moved:
        moved = (~is_d & F.col("before").isNotNull() & (F.col("before.sink_type") == layer)
                 & ((F.col("after.sink_type") != layer)
                    | (config_key("before", layer) != config_key("after", layer))))
        # an eviction comes before the put of its own change
        found.insert(1, touch(moved, "before", REMOVE))
    # one pass over the changes: each change yields the keys it touches
    return (changes.select(order.alias("_o"), F.explode(F.array(*found)).alias("_t"))
            .where(F.col("_t").isNotNull())
            .select(F.col("_t.config_key").alias("config_key"), "_o",
                    F.col("_t._action").alias("_action"), F.col("_t._cfg").alias("_cfg")))


def rule_versions(changes: DataFrame, layer: str, evict_moved: bool = False, seq: str | None = None,
                  preload: DataFrame | None = None) -> DataFrame:
    """The history of the configuration, for joins as of time: ``key``, ``at`` (ms) and ``value``
    (``put``, ``cfg``), one row per key and millisecond (the last change of it).

    A version holds until the next one of its key; one with ``put`` false ends the rule.
    ``preload`` (R10) is the snapshot read before the first change: it holds from the start.
    """
    t = touches(changes, layer, evict_moved, seq).where("config_key is not null")
    value = F.struct((F.col("_action") == PUT).alias("put"), F.col("_cfg").alias("cfg"))
    v = (t.select(F.col("config_key").alias("key"), F.col("_o.ts_ms").alias("at"), "_o", value.alias("v"))
         .groupBy("key", "at").agg(F.max_by("v", "_o").alias("value")))
    if preload is not None:
        pre = preload.where(F.col("sink_type") == layer).select(
            config_key_cols(layer).alias("key"), F.lit(START).cast("bigint").alias("at"),
            F.struct(F.lit(True).alias("put"), F.struct(*CONFIG_FIELDS).alias("cfg")).alias("value"))
        v = v.unionByName(pre)
    return v


def in_force(rows: DataFrame, rules: DataFrame, bucket: int = DAY_MS) -> DataFrame:
    """``rows`` (with ``_key`` and ``_at``) and the config columns of the rule in force for each;
    rows without one are dropped.

    Before the rows are shuffled, those whose key never has a rule go, and ``data`` loses the columns
    that no rule of its key ever keeps.  These names per key are as many as the configuration has, and
    are read as one value before the join.
    """
    puts = rules.where("value.put").select("key", F.explode(F.split("value.cfg.sink_columns", ",")).alias("c"))
    names = (puts.groupBy("key").agg(F.collect_set("c").alias("names"))
             .agg(F.map_from_entries(F.collect_list(F.struct("key", "names"))).alias("m")))
    rows = rows.withColumn("_names", names.scalar()[F.col("_key")]).where("_names is not null")
    rows = rows.withColumn("data", kept("data", "_names")).drop("_names")
    found = asof_join(rows, "_key", "_at", rules, bucket, "_rule").where("_rule.put")
    return found.select(*rows.columns, *[F.col(f"_rule.cfg.{f}").alias(f) for f in CONFIG_FIELDS]).drop("_key", "_at")


def fold_changes(
    changes: DataFrame,
    layer: str = "dim",
    evict_moved: bool = False,
    seq: str | None = None,
    preload: DataFrame | None = None,
) -> DataFrame:
    """Current configuration of ``layer`` after a change history.

    ``changes``: ``before``, ``after`` (config structs), ``op``, ``ts_ms`` and
    optionally a sequence column ``seq`` for changes of one millisecond.
    Literal by default: an update that changes the key or moves the row to
    the other layer leaves the old key in place (Q12); ``evict_moved=True``
    removes it.  ``preload`` (R10) is the snapshot read at start: a key with
    no change keeps its preloaded row; a delete drops both.
    Output: ``config_key`` + the seven config columns.
    """
    exploded = touches(changes, layer, evict_moved, seq)
    last = (
        exploded
        .groupBy("config_key")
        .agg(F.max_by(F.struct("_action", "_cfg"), "_o").alias("_last"))
        .select("config_key", F.col("_last._action").alias("_action"),
                F.col("_last._cfg").alias("_cfg"))
    )
    if preload is not None:
        pre = preload.where(F.col("sink_type") == layer).select(
            config_key_cols(layer).alias("config_key"),
            F.struct(*[F.col(f) for f in CONFIG_FIELDS]).alias("_pre"))
        last = (last.join(pre, "config_key", "full_outer")
                .select("config_key", F.coalesce("_action", F.lit(PUT)).alias("_action"),
                        F.coalesce("_cfg", "_pre").alias("_cfg")))
    return last.where(F.col("_action") == PUT).select(
        "config_key", *[F.col(f"_cfg.{f}").alias(f) for f in CONFIG_FIELDS])


def config_key_cols(layer: str) -> Column:
    if layer == "dwd":
        return F.concat(F.col("source_table"), F.lit("_"), F.col("source_type"))
    return F.col("source_table")


def snapshot(config: DataFrame, layer: str) -> DataFrame:
    """A configuration table (rows, not changes) as the current state."""
    return config.where(F.col("sink_type") == layer).select(
        config_key_cols(layer).alias("config_key"), *CONFIG_FIELDS)


def prune(data: Column | str, sink_columns: Column | str) -> Column:
    """Keep the map keys named in ``sink_columns``.

    Exact split on ',' without trimming, as the reference: "id, name" keeps
    "id" only.  Keys that are absent are not added.
    """
    d = F.col(data) if isinstance(data, str) else data
    names = F.col(sink_columns) if isinstance(sink_columns, str) else sink_columns
    # looked for in the text itself: nothing is split for each key
    return F.map_filter(d, lambda k, v: F.call_function("find_in_set", k, names) > 0)


def kept(data: Column | str, names: Column | str) -> Column:
    """The entries of a map whose keys are in the array ``names``."""
    d = F.col(data) if isinstance(data, str) else data
    n = F.col(names) if isinstance(names, str) else names
    return F.map_filter(d, lambda k, v: F.array_contains(n, k))


def pk_or_default(sink_pk: Column | str, default: str = "id") -> Column:
    """the primary key column, ``id`` when null or empty (Q11: the
    reference compares references, so only null is replaced there)."""
    c = F.col(sink_pk) if isinstance(sink_pk, str) else sink_pk
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)
