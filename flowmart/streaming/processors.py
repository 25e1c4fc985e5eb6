"""Keyed "last date" state for streams (T5-T9) with ``transformWithStateInPandas``.

One processor covers the four uses of the reference's ValueState:

* ``flag``        (T7) every row, + flag 1 on a key's first row of a day;
* ``home_detail`` (T6) only first rows, + homeUv / detailUv;
* ``login``       (T8) only first rows, + uu / back (>= 8 days since last);
* ``fix``         (T5) every row, is_new rewritten against the key's first day.

Rows of one key come in chunks of bounded size, each ordered by (ts, tiebreak)
before the state is applied: event order within a chunk, arrival order across
chunks and batches, as in the reference (Q14 behaves the same: an earlier date in a
later chunk counts again).  Memory does not grow with a key's rows.  State lives in the RocksDB store;
``ttl_ms`` clears a key's state by an event-time timer (T9), never by wall
clock, so replays give the same result.  Inputs must carry a watermark on
``rt``; the output keeps ``rt`` as its event-time column so windows can follow.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (ExpiredTimerInfo, StatefulProcessor,
                                                      StatefulProcessorHandle, TimerValues)

from flowmart.functions.timefn import DAY_MS, to_date_str
from flowmart.session import DEFAULT_TZ

EPOCH_DATE = "1970-01-01"
TWO_DAYS_MS = 2 * DAY_MS


def _offset_hours(offset: str) -> timezone:
    sign = -1 if offset.startswith("-") else 1
    h, m = offset.lstrip("+-").split(":")
    return timezone(sign * timedelta(hours=int(h), minutes=int(m)))


class LastDateProcessor(StatefulProcessor):
    """See the module docstring.  Input columns used: ``fm_day``, ``ts``,
    ``fm_raw`` (fix mode), ``fm_page`` (home_detail mode), optional tiebreak."""

    def __init__(self, mode: str, out_cols: Sequence[str], tiebreak: str | None = None,
                 ttl_ms: int | None = None, back_days: int = 7, offset: str = "+08:00"):
        self.mode = mode
        self.out_cols = list(out_cols)
        self.tiebreak = tiebreak
        self.ttl_ms = ttl_ms
        self.back_days = back_days
        self.offset = offset

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_day", "day string")

    def _midnight_ms(self, day: str) -> int:
        d = datetime.strptime(day, "%Y-%m-%d").replace(tzinfo=_offset_hours(self.offset))
        return int(d.timestamp() * 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame],
                        timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            if len(pdf):
                yield from self._apply(pdf)

    def _apply(self, pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        order = ["ts"] + ([self.tiebreak] if self.tiebreak else [])
        pdf = pdf.sort_values(order, kind="stable").reset_index(drop=True)
        days = pdf["fm_day"].astype(object)
        state = self.last.get()[0] if self.last.exists() else None

        if self.mode == "fix":
            if state is None:
                state = days.iloc[0] if pdf["fm_raw"].iloc[0] == "1" else EPOCH_DATE
                self.last.update((state,))
            raw = pdf["fm_raw"]
            pdf["fm_fixed"] = raw.where(~((raw == "1") & (days != state)), "0")
            yield pdf[self.out_cols]
            return

        prev = days.shift(1)
        prev.iloc[0] = state
        first = prev.isna() | (prev != days)
        self.last.update((days.iloc[-1],))
        if self.ttl_ms:
            end = int(pdf["ts"].max()) + self.ttl_ms
            for t in list(self.handle.listTimers()):
                end = max(end, t)
                self.handle.deleteTimer(t)
            self.handle.registerTimer(end)

        if self.mode == "flag":
            pdf["fm_flag"] = first.astype("int64")
            yield pdf[self.out_cols]
        elif self.mode == "home_detail":
            out = pdf[first].copy()
            out["homeUv"] = (out["fm_page"] == "home").astype("int64")
            out["detailUv"] = (out["fm_page"] != "home").astype("int64")
            yield out[self.out_cols]
        elif self.mode == "login":
            out = pdf[first].copy()
            p = prev[first]
            mid = p.map(lambda d: self._midnight_ms(d) if isinstance(d, str) else None)
            gap = (out["ts"] - mid.astype("float64")) // DAY_MS
            out["uu"] = 1
            out["back"] = (p.notna() & (gap > self.back_days)).astype("int64")
            out["uu"] = out["uu"].astype("int64")
            yield out[self.out_cols]
        else:
            raise ValueError(self.mode)

    def handleExpiredTimer(self, key, timerValues: TimerValues,
                           expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame(columns=self.out_cols)

    def close(self) -> None:
        pass


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _require_flat(df: DataFrame) -> None:
    nested = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.StructType, T.MapType, T.ArrayType))]
    if nested:
        raise ValueError(f"stream state input must be flat; nested columns: {nested}")


def _run(df: DataFrame, key: Column | str, processor: LastDateProcessor,
         out_schema: T.StructType) -> DataFrame:
    if "rt" not in df.columns:
        raise ValueError("stream input needs an event-time column 'rt' with a watermark")
    return (df.withColumn("fm_key", _col(key)).where(F.col("fm_key").isNotNull())
            .groupBy("fm_key")
            .transformWithStateInPandas(statefulProcessor=processor,
                                        outputStructType=out_schema, outputMode="Append",
                                        timeMode="EventTime", eventTimeColumnName="rt"))


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    by = {f.name: f for f in df.schema.fields}
    return [by[n] for n in names]


def daily_first_flag_stream(df: DataFrame, key: Column | str, flag: str = "uv",
                            ts: str = "ts", tz: str = DEFAULT_TZ,
                            tiebreak: str | None = None,
                            ttl_ms: int | None = TWO_DAYS_MS) -> DataFrame:
    """T7 + T9 on a flat stream: every row, + ``flag``."""
    _require_flat(df)
    src = df.withColumn("fm_day", to_date_str(ts, tz))
    cols = df.columns
    schema = T.StructType(_fields(df, cols) + [T.StructField("fm_flag", T.LongType())])
    p = LastDateProcessor("flag", cols + ["fm_flag"], tiebreak, ttl_ms)
    return _run(src, key, p, schema).withColumnRenamed("fm_flag", flag)


def home_detail_stream(df: DataFrame, key: Column | str, page: Column | str,
                       ts: str = "ts", tz: str = DEFAULT_TZ, per_page: bool = False,
                       tiebreak: str | None = None,
                       ttl_ms: int | None = TWO_DAYS_MS) -> DataFrame:
    """T6 on a stream: first rows of a day only, + homeUv / detailUv."""
    src = df.select(_col(key).alias("mid"), _col(page).alias("page_id"), ts, "rt",
                    *([tiebreak] if tiebreak else []))
    src = src.withColumn("fm_day", to_date_str(ts, tz)).withColumn("fm_page", F.col("page_id"))
    k = F.concat_ws("\u0001", "mid", "page_id") if per_page else F.col("mid")
    cols = ["mid", "page_id", ts, "rt"] + ([tiebreak] if tiebreak else [])
    schema = T.StructType(_fields(src, cols) + [T.StructField("homeUv", T.LongType()),
                                                T.StructField("detailUv", T.LongType())])
    p = LastDateProcessor("home_detail", cols + ["homeUv", "detailUv"], tiebreak, ttl_ms)
    return _run(src, k, p, schema)


def login_stream(df: DataFrame, key: Column | str, ts: str = "ts", tz: str = DEFAULT_TZ,
                 back_days: int = 7, offset: str = "+08:00",
                 tiebreak: str | None = None) -> DataFrame:
    """T8 on a stream: first rows of a day only, + uu / back.  No TTL: the
    returning test needs the key's last day however old it is."""
    src = df.select(_col(key).alias("uid"), ts, "rt", *([tiebreak] if tiebreak else []))
    src = src.withColumn("fm_day", to_date_str(ts, tz))
    cols = ["uid", "fm_day", ts, "rt"] + ([tiebreak] if tiebreak else [])
    schema = T.StructType(_fields(src, cols) + [T.StructField("uu", T.LongType()),
                                                T.StructField("back", T.LongType())])
    p = LastDateProcessor("login", cols + ["uu", "back"], tiebreak, None, back_days, offset)
    return _run(src, "uid", p, schema).withColumnRenamed("fm_day", "day")


def fix_is_new_stream(df: DataFrame, key: Column | str, flag: Column | str,
                      ts: str = "ts", tz: str = DEFAULT_TZ,
                      tiebreak: str | None = None) -> DataFrame:
    """T5 on a flat stream: ``fm_raw`` is the raw flag; adds ``fm_fixed``."""
    _require_flat(df)
    src = df.withColumn("fm_day", to_date_str(ts, tz)).withColumn("fm_raw", _col(flag))
    cols = df.columns
    schema = T.StructType(_fields(df, cols) + [T.StructField("fm_fixed", T.StringType())])
    p = LastDateProcessor("fix", cols + ["fm_fixed"], tiebreak)
    return _run(src, key, p, schema)
