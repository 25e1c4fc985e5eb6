"""Routing rules in Spark's keyed state (R7-R10, T11, J4 in a stream).

The reference copies its rules to every task (broadcast state) and routes each change by the rule
that is there when the change arrives.  Here changes and rules are one stream, keyed by the rule's
key and a slot: a rule goes to all ``slots`` of its key and each slot keeps a copy in its state, so
the changes of one hot table are routed by as many tasks.  The snapshot read before the first change
(R10) is the query's initial state; a later change of its key replaces it and a delete drops it.

Inside a micro-batch rows and rules of a chunk follow each other by time: a rule holds for the rows
from its time on, earlier rows get the one before it.  Rules of earlier batches always hold, as a rule
that has arrived is in force.  Changes of one millisecond apply in the order read.  Only rule columns
are added in Python; pruning and all else are column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from flowmart import schemas
from flowmart.operators import config, dwd

SLOTS = 8
RULE, ROW = "rule", "row"
_PASSED = ["table", "type", "ts", "xid", "xoffset", "data"]
_OUT = T.StructType([T.StructField("kind", T.StringType()), T.StructField("rule", T.StringType()),
                     *(T.StructField(c, T.LongType() if c in ("ts", "xid", "xoffset") else T.StringType())
                       for c in _PASSED)])


class RuleProcessor(StatefulProcessor):
    """See the module docstring.  Input: kind, slot, at, put, rule and the columns handed on."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rule = handle.getValueState("rule", "rule string")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        self.rule.update((initialState["rule"].iloc[-1],))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            if len(chunk):
                yield self._apply(chunk)

    def _apply(self, chunk: pd.DataFrame) -> pd.DataFrame:
        is_rule = chunk["kind"] == RULE
        held = self.rule.get()[0] if self.rule.exists() else None
        changes, rows = chunk[is_rule].sort_values("at", kind="stable"), chunk[~is_rule]
        # the rules in order, before them the one held so far; a removed one is None
        rules = [held, *(r if p else None for r, p in zip(changes["rule"], changes["put"]))]
        at = np.searchsorted(changes["at"].to_numpy(dtype="int64"), rows["at"].to_numpy(dtype="int64"), side="right")
        rows = rows.assign(rule=[rules[i] for i in at])
        if len(changes):
            if rules[-1] is None:
                self.rule.clear()
            else:
                self.rule.update((rules[-1],))
        new = changes[(changes["put"] == True) & (changes["slot"] == 0)]  # noqa: E712
        out = pd.concat([new, rows[rows["rule"].notna()]])
        # whole numbers with nulls (a rule has no ts) stay whole
        return out[_OUT.names].astype({c: "Int64" for c in ("ts", "xid", "xoffset")})

    def close(self) -> None:
        pass


def _rule(cfg: Column) -> Column:
    return F.to_json(cfg)


def with_rules(feed: DataFrame, changes: DataFrame, layer: str, snapshot: DataFrame | None = None,
               types: Sequence[str] | None = None, evict_moved: bool = False, slots: int = SLOTS) -> DataFrame:
    """``kind`` (a ``row`` of the feed with the rule in force, or a ``rule`` as it is put in place), the
    rule's columns, and for rows table, type, ts, xid, xoffset and data.  Rows without a rule are dropped."""
    key = dwd.route_key() if layer == "dwd" else F.col("table")
    rows = feed if types is None else feed.where(F.col("type").isin(*types))
    data = F.to_json("data")
    rows = rows.select(
        key.alias("key"), F.pmod(F.xxhash64(data), F.lit(slots)).cast("int").alias("slot"), F.lit(ROW).alias("kind"),
        (F.col("ts") * 1000).alias("at"), F.lit(None).cast("boolean").alias("put"),
        F.lit(None).cast("string").alias("rule"), *_PASSED[:-1], data.alias("data")).where("key is not null and at is not null")
    each = F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))
    rules = config.touches(changes, layer, evict_moved).where("config_key is not null").select(
        F.col("config_key").alias("key"), each.alias("slot"), F.lit(RULE).alias("kind"),
        F.coalesce(F.col("_o.ts_ms"), F.lit(0)).alias("at"), (F.col("_action") == config.PUT).alias("put"),
        _rule(F.col("_cfg")).alias("rule"), *(F.lit(None).cast(_OUT[c].dataType).alias(c) for c in _PASSED))
    start = None
    if snapshot is not None:
        start = (config.snapshot(snapshot, layer)
                 .select(F.col("config_key").alias("key"), each.alias("slot"),
                         _rule(F.struct(*schemas.CONFIG_FIELDS)).alias("rule"))
                 .groupBy("key", "slot"))
    out = rows.unionByName(rules).groupBy("key", "slot").transformWithStateInPandas(
        statefulProcessor=RuleProcessor(), outputStructType=_OUT, outputMode="Append", timeMode="None",
        initialState=start)
    rule = F.from_json("rule", schemas.CONFIG)
    return out.withColumns({"rule": rule, "data": F.from_json("data", schemas.STR_MAP)}).select(
        "kind", "rule.*", *_PASSED)
