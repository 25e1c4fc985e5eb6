"""DWD fact routing by (table, change type) configuration (fact-routing job; R8, K2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.operators import config as cfg


def route(feed: DataFrame, config: DataFrame) -> DataFrame:
    """Each change whose ``table || '_' || type`` is configured goes to its
    sink table, ``data`` pruned to the configured columns.  Output:
    ``sink_table`` (the per-row topic), ``table``, ``type``, ``ts``, ``xid``, ``xoffset``, ``data``.
    """
    c = config.select("config_key", "sink_table", F.split("sink_columns", ",").alias("_names"))
    keyed = feed.withColumn("_key", route_key())
    return routed(keyed.join(c, keyed["_key"] == c["config_key"], "inner"), cfg.kept("data", "_names"))


def route_asof(feed: DataFrame, rules: DataFrame, bucket: int = cfg.DAY_MS) -> DataFrame:
    """R8 + J4 as of time: each change goes where the rule in force when it came sends it.  ``rules``
    is ``config.rule_versions`` of the fact layer; output as :func:`route`."""
    rows = feed.withColumns({"_key": route_key(), "_at": F.col("ts") * 1000})
    return routed(cfg.in_force(rows, rules, bucket))


def route_key() -> Column:
    """The key of a change's rule."""
    return F.concat(F.col("table"), F.lit("_"), F.col("type"))


def routed(joined: DataFrame, data: Column | None = None) -> DataFrame:
    """The output of :func:`route` from changes and the columns of their rule (``data``: as pruned by it)."""
    data = cfg.prune("data", "sink_columns") if data is None else data
    return joined.select("sink_table", "table", "type", "ts", "xid", "xoffset", data.alias("data"))


def to_topic_records(rows: DataFrame) -> DataFrame:
    """K2: ``topic`` + JSON ``value`` per row (the routing field stripped), ready for a sink that
    writes each row to its own topic, with its change's ``ts`` and a ``record_id``: a hash of the
    change's place in the feed and the record.  A record that an at-least-once sink writes again has
    the same id, so readers tell it apart (``streams.read_records_once``)."""
    value = F.to_json(F.map_filter("data", lambda k, v: v.isNotNull()))
    out = rows.select(F.col("sink_table").alias("topic"), value.alias("value"), "ts", "table", "type", "xid", "xoffset")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in
             ("topic", "table", "type", "ts", "xid", "xoffset", "value")]
    return out.select("topic", F.sha2(F.concat_ws("|", *parts), 256).alias("record_id"), "ts", "value")
