"""The order-detail joins over a stream, in Spark's keyed state.

The four slices of the change feed are one stream, keyed by order id.  An order's state holds its
parts: the order rows in a list, the details, activities and coupons in maps by detail id.  A part
that arrives meets only the parts it joins with: an activity or a coupon reads the entries of its
detail, and only an order reads all details.  What it changes is emitted as changelog rows (+I, and
-U / +U where a match replaces a null side), in the order of arrival.

No slice is stored outside the state and none is read again.  By default state is kept for ever, as
in the reference, which sets no bound (Q16); with ``ttl_ms`` an event-time timer clears an order so
long after its newest part, never by wall clock.  Rows of an order come in chunks of bounded size,
each sorted by (ts, xid, xoffset, slice).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from flowmart import schemas
from flowmart.operators import trade

ARRIVAL = ["ts", "xid", "xoffset", "step"]
#: output columns: the change, its place among the changes of its order, and the row without its name
DETAIL = [c for c in schemas.ORDER_DETAIL_OUT if c != "dic_name"]
OUT = T.StructType([T.StructField("op", T.StringType()), T.StructField("seq", T.LongType()),
                    *(T.StructField(c, T.LongType()) for c in ARRIVAL[:3]), T.StructField("step", T.IntegerType()),
                    *(T.StructField(c, T.StringType()) for c in DETAIL)])
ACTIVITY, COUPON = ("activity_id", "activity_rule_id"), ("coupon_id", "coupon_use_id")


class _Parts:
    """A map state of lists of rows by detail id, read and written once per chunk and id."""

    def __init__(self, state):
        self.state = state
        self.read: dict[str, list[dict]] = {}
        self.changed: set[str] = set()

    def get(self, key: str) -> list[dict]:
        if key not in self.read:
            has = self.state.containsKey((key,))
            self.read[key] = json.loads(self.state.getValue((key,))[0]) if has else []
        return self.read[key]

    def add(self, key: str, row: dict) -> None:
        self.get(key).append(row)
        self.changed.add(key)

    def keys(self) -> list[str]:
        return sorted({k[0] for k in self.state.keys()} | self.read.keys())

    def write(self) -> None:
        for key in self.changed:
            self.state.updateValue((key,), (json.dumps(self.read[key]),))


class OrderDetailProcessor(StatefulProcessor):
    """See the module docstring.  Input: order_id, kind, detail_id, row (JSON) and the arrival."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.orders = handle.getListState("orders", "row string")
        self.parts = {k: handle.getMapState(k, "id string", "rows string")
                      for k in ("order_detail", "order_detail_activity", "order_detail_coupon")}
        self.seq = handle.getValueState("seq", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            if len(chunk):
                yield self._apply(chunk.sort_values(ARRIVAL, kind="stable"))

    def _apply(self, chunk: pd.DataFrame) -> pd.DataFrame:
        details, activities, coupons = (_Parts(s) for s in self.parts.values())
        orders = [json.loads(o[0]) for o in self.orders.get()]
        seq = self.seq.get()[0] if self.seq.exists() else 0
        out: list[tuple] = []

        def emit(op: str, detail: dict, order: dict, activity: dict | None, coupon: dict | None) -> None:
            row = {**order, **detail, **_only(activity, ACTIVITY), **_only(coupon, COUPON)}
            out.append((op, seq + len(out), *arrival, *(row.get(c) for c in DETAIL)))

        for r in chunk.itertuples(index=False):
            arrival, row, at = (r.ts, r.xid, r.xoffset, r.step), json.loads(r.row), r.detail_id
            if r.kind == "order_info":
                row = {k: v for k, v in row.items() if k in _ORDER_ONLY}
                orders.append(row)
                self.orders.appendValue((json.dumps(row),))
                for d in details.keys():
                    for detail in details.get(d):
                        for a in activities.get(d) or [None]:
                            for c in coupons.get(d) or [None]:
                                emit(trade.INSERT, detail, row, a, c)
            elif at is None:
                continue  # a part of no detail joins nothing
            elif r.kind == "order_detail":
                details.add(at, row)
                for order in orders:
                    for a in activities.get(at) or [None]:
                        for c in coupons.get(at) or [None]:
                            emit(trade.INSERT, row, order, a, c)
            else:
                is_activity = r.kind == "order_detail_activity"
                own, other = (activities, coupons) if is_activity else (coupons, activities)
                lone = not own.get(at)
                own.add(at, row)
                found = [(d, o, x) for d in details.get(at) for o in orders for x in other.get(at) or [None]]
                for op, new in ((trade.BEFORE, None), (trade.AFTER, row)) if lone else ((trade.INSERT, row),):
                    for d, o, x in found:
                        emit(op, d, o, *((new, x) if is_activity else (x, new)))
        for p in (details, activities, coupons):
            p.write()
        if out:
            self.seq.update((seq + len(out),))
        if self.ttl_ms:
            end = int(chunk["ts"].max()) * 1000 + self.ttl_ms
            for t in list(self.handle.listTimers()):
                end = max(end, t)
                self.handle.deleteTimer(t)
            self.handle.registerTimer(end)
        return pd.DataFrame(out, columns=OUT.names)

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        for state in (self.orders, self.seq, *self.parts.values()):
            state.clear()
        yield pd.DataFrame(columns=OUT.names)

    def close(self) -> None:
        pass


# an order's columns that the detail does not bring itself
_ORDER_ONLY = [c for c in schemas.ORDER_INFO_COLS if c in DETAIL and c not in schemas.ORDER_DETAIL_COLS]


def _only(row: dict | None, columns: tuple[str, ...]) -> dict:
    return {c: row.get(c) for c in columns} if row else {}


def parts_of(feed: DataFrame) -> DataFrame:
    """The four slices as one stream of rows: order_id, kind, detail_id, row and the arrival."""
    out = None
    detail_id = {"order_detail": F.col("id"), "order_info": F.lit(None).cast("string")}
    for table, (rows, order_id) in trade.slices(feed, ("ts", "xid", "xoffset")).items():
        one = rows.select(
            F.col(order_id).alias("order_id"), F.lit(table).alias("kind"),
            detail_id.get(table, F.col("order_detail_id")).alias("detail_id"),
            F.to_json(F.struct(*[c for c in rows.columns if c not in ARRIVAL])).alias("row"),
            "ts", "xid", "xoffset", F.lit(trade.RANK[table]).alias("step"))
        out = one if out is None else out.unionByName(one)
    return out.where("order_id is not null")


def order_detail_changes(feed: DataFrame, ttl_ms: int | None = None, delay: str = "2 seconds") -> DataFrame:
    """The changelog of the joins of a change-feed stream, before the dictionary lookup."""
    rows = parts_of(feed)
    if ttl_ms:
        rows = rows.withColumn("rt", F.timestamp_seconds("ts")).withWatermark("rt", delay)
    return rows.groupBy("order_id").transformWithStateInPandas(
        statefulProcessor=OrderDetailProcessor(ttl_ms), outputStructType=OUT, outputMode="Append",
        timeMode="EventTime" if ttl_ms else "None")
