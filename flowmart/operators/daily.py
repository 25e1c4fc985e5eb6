"""Keyed "last date" state of the reference, in batch form.

The reference keeps one ValueState per key (mid or uid) holding the date of
the key's last counted row.  In event order the state always equals the date
of the key's previous row, so a row is counted exactly when it is the key's
first row of its day.  Batch forms here never sort a key's rows in one task:

* the first row of every (key, day) is found with ``groupBy(key, day)`` and the
  ``min`` of one number made of ts and tiebreak (:func:`order_key`) -- of fixed
  width, so Spark aggregates by hash, not by sorting raw rows, and with map-side
  partial aggregation a key holding a third of all rows collapses before the shuffle;
* flags are joined back on ``(key, ts, tiebreak)``, a composite key that
  spreads evenly even when one key is hot.  AQE turns the join into a
  broadcast join when the per-day table is measured small at run time.

Streaming inputs go to the stateful processors in
:mod:`flowmart.streaming.processors`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions.timefn import DAY_MS, TO_TS_OFFSET, to_date_str, to_ts
from flowmart.session import DEFAULT_TZ

EPOCH_DATE = "1970-01-01"
# The two pages that the home/detail job counts.
HOME, DETAIL = "home", "good_detail"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# the order key: ts * 2^65 + (tiebreak + 2^63) * 2 + flag, in a decimal of 38 digits
_TB, _TS = 1 << 64, 1 << 65


def _dec(v: int) -> Column:
    return F.lit(str(v)).cast("decimal(38,0)")


def order_key(ts: Column | str, tiebreak: Column | str | None, flag: Column | None = None) -> Column:
    """(ts, tiebreak) as one number in the same order (a null tiebreak counts as the least), with one
    bit of the row beside it.  ts is in ms, from the year -10^7 on."""
    wide = lambda c: _col(c).cast("decimal(20,0)")
    tb = F.coalesce(wide(tiebreak), _dec(-(1 << 63)).cast("decimal(20,0)")) if tiebreak is not None else F.lit(0).cast("decimal(20,0)")
    bit = F.when(flag, 1).otherwise(0) if flag is not None else F.lit(0)
    low = ((tb + _dec(1 << 63).cast("decimal(20,0)")) * F.lit(2) + bit).cast("decimal(38,0)")
    # ts is counted from 2^59 ms before the epoch, so that keys are never negative
    high = (wide(ts) + F.lit(1 << 59)).cast("decimal(18,0)") * _dec(_TS).cast("decimal(20,0)")
    return (high.cast("decimal(38,0)") + low).cast("decimal(38,0)")


def key_parts(key: Column | str) -> dict[str, Column]:
    """``ts``, ``tiebreak`` and ``flag`` (0 or 1) of an order key."""
    k = _col(key)
    rest = k % _dec(_TS)
    flag = (rest % F.lit(2)).cast("int")
    return {"ts": ((k - rest) / _dec(_TS).cast("decimal(20,0)")).cast("bigint") - (1 << 59),
            "tiebreak": ((rest - flag) / F.lit(2) - _dec(1 << 63)).cast("decimal(20,0)").cast("bigint"), "flag": flag}


def first_of_day(
    df: DataFrame,
    key: Column | str,
    ts: str = "ts",
    tiebreak: str | None = None,
    tz: str = DEFAULT_TZ,
    flag: Column | None = None,
    carry: Sequence[tuple[str, Column | str]] = (),
) -> DataFrame:
    """One row per (key, day): the day's first row by (ts, tiebreak).

    Returns ``_key, _day, _ts, _tb``, ``_flag`` (whether ``flag`` held in that row) and the ``carry``
    columns of that row.  With ``carry`` the raw rows are first combined per value of these columns, by
    hash as well; what is sorted after that is one row per key, day and value.
    """
    names = [n for n, _ in carry]
    rows = df.select(_col(key).alias("_key"), to_date_str(ts, tz).alias("_day"),
                     order_key(ts, tiebreak, flag).alias("_f"), *(_col(c).alias(n) for n, c in carry))
    first = rows.where(F.col("_key").isNotNull()).groupBy("_key", "_day", *names).agg(F.min("_f").alias("_f"))
    if names:
        first = (first.groupBy("_key", "_day").agg(F.min_by(F.struct(*names), "_f").alias("_c"), F.min("_f").alias("_f"))
                 .select("_key", "_day", "_f", "_c.*"))
    parts = key_parts("_f")
    return first.select("_key", "_day", parts["ts"].alias("_ts"), parts["tiebreak"].alias("_tb"),
                        (parts["flag"] == 1).alias("_flag"), *names)


def daily_first_flag(
    df: DataFrame,
    key: Column | str,
    flag: str = "uv",
    ts: str = "ts",
    tiebreak: str | None = None,
    tz: str = DEFAULT_TZ,
) -> DataFrame:
    """Add ``flag`` = 1 on each key's first row of a day, else 0.

    Every input row is kept.  ``tiebreak`` (a unique row id) makes the result
    repeatable when two rows of one key share a millisecond; without it any one
    of them gets the flag.  It is a whole number.
    """
    if df.isStreaming:
        from flowmart.streaming.processors import daily_first_flag_stream
        return daily_first_flag_stream(df, key, flag=flag, ts=ts, tz=tz, tiebreak=tiebreak)
    if tiebreak is None:
        # rows of one key and millisecond are told apart by an id made for this query
        made = "_row"
        out = daily_first_flag(df.withColumn(made, F.monotonically_increasing_id()), key, flag, ts, made, tz)
        return out.drop(made)
    firsts = (first_of_day(df, key, ts, tiebreak, tz)
              .select("_key", "_ts", "_tb", F.lit(1).cast("bigint").alias("_flag")))
    tagged = df.withColumn("_key", _col(key))
    cond = ((tagged["_key"] == firsts["_key"]) & (tagged[ts] == firsts["_ts"])
            & (tagged[tiebreak] == firsts["_tb"]))
    return (
        tagged.join(firsts, cond, "left")
        .withColumn(flag, F.coalesce(F.col("_flag"), F.lit(0)).cast("bigint"))
        .drop("_key", "_ts", "_tb", "_flag")
    )


def home_detail_firsts(
    df: DataFrame,
    key: Column | str = "common.mid",
    page: Column | str = "page.page_id",
    ts: str = "ts",
    tiebreak: str | None = None,
    tz: str = DEFAULT_TZ,
    per_page: bool = False,
) -> DataFrame:
    """The rows the home/detail job emits, with ``homeUv`` / ``detailUv``.

    The reference shares one date state per mid between both pages (Q6), so a
    mid counts once a day for whichever page comes first.  ``per_page=True``
    keys the state by (mid, page).  Input must already be filtered to the two
    pages (P5).  Output: ``mid``, ``page_id``, ``ts`` (and the tiebreak),
    ``homeUv``, ``detailUv`` (bigint 0/1).
    """
    if df.isStreaming:
        from flowmart.streaming.processors import home_detail_stream
        return home_detail_stream(df, key, page, ts=ts, tz=tz, per_page=per_page,
                                  tiebreak=tiebreak)
    # a row without a mid is dropped in both forms: a struct key is null with its mid
    is_home = _col(page) == HOME
    k = F.when(_col(key).isNotNull(), F.struct(_col(key).alias("mid"), is_home)) if per_page else _col(key)
    firsts = first_of_day(df, k, ts, tiebreak, tz, flag=is_home)
    home = F.col("_flag")
    return firsts.select(
        F.col("_key.mid" if per_page else "_key").alias("mid"), F.when(home, HOME).otherwise(DETAIL).alias("page_id"),
        F.col("_ts").alias("ts"), *([F.col("_tb").alias(tiebreak)] if tiebreak else []),
        home.cast("bigint").alias("homeUv"), (~home).cast("bigint").alias("detailUv"),
    )


def login_firsts(
    df: DataFrame,
    key: Column | str = "common.uid",
    ts: str = "ts",
    tiebreak: str | None = None,
    tz: str = DEFAULT_TZ,
    back_days: int = 7,
    offset: str = TO_TS_OFFSET,
) -> DataFrame:
    """One row per (uid, day): ``uid``, ``day``, ``ts`` (and the
    tiebreak), ``uu`` = 1 and ``back`` 0/1.

    back = 1 when the uid's previous login day exists and
    ``(ts - midnight(previous day)) div 1 day > back_days`` (8 days or more).
    Midnight is taken at the fixed offset the reference uses (``toTs``).
    The window runs over per-day rows only: at most one row per uid and day.
    """
    if df.isStreaming:
        from flowmart.streaming.processors import login_stream
        return login_stream(df, key, ts=ts, tz=tz, back_days=back_days, offset=offset,
                            tiebreak=tiebreak)
    firsts = first_of_day(df, key, ts, tiebreak, tz)
    prev = F.lag("_day").over(Window.partitionBy("_key").orderBy("_day"))
    days = F.floor((F.col("_ts") - to_ts(prev, offset=offset)) / F.lit(DAY_MS))
    back = F.when(prev.isNotNull() & (days > back_days), 1).otherwise(0)
    return firsts.select(
        F.col("_key").alias("uid"), F.col("_day").alias("day"), F.col("_ts").alias("ts"),
        *([F.col("_tb").alias(tiebreak)] if tiebreak else []),
        F.lit(1).cast("bigint").alias("uu"), back.cast("bigint").alias("back"))


def visitor_states(
    df: DataFrame,
    key: Column | str = "common.mid",
    flag: str = "common.is_new",
    ts: str = "ts",
    tiebreak: str | None = None,
    tz: str = DEFAULT_TZ,
) -> DataFrame:
    """T5: the state of every mid (``_key``, ``_state``), set by its first row."""
    parts = key_parts("_f")
    return (
        df.select(_col(key).alias("_key"), order_key(ts, tiebreak, _col(flag) == "1").alias("_f"))
        .groupBy("_key").agg(F.min("_f").alias("_f"))
        .select("_key", F.when(parts["flag"] == 1, to_date_str(parts["ts"], tz))
                .otherwise(F.lit(EPOCH_DATE)).alias("_state"))
    )


def fix_is_new(
    df: DataFrame,
    key: Column | str = "common.mid",
    flag: str = "common.is_new",
    ts: str = "ts",
    tiebreak: str | None = None,
    tz: str = DEFAULT_TZ,
    states: DataFrame | None = None,
) -> DataFrame:
    """T5: new-visitor repair.

    The state S of a mid is set once, by its first row: that row's date when
    its raw flag is '1', else 1970-01-01.  A row whose raw flag is '1' and
    whose date differs from S is rewritten to '0'; other rows keep their flag.
    The per-mid first row is a partial aggregate; it is joined back on mid
    (broadcast when AQE measures it small, else a sort-merge join whose hot
    partitions AQE splits).
    """
    if df.isStreaming:
        from flowmart.streaming.processors import fix_is_new_stream
        return fix_is_new_stream(df, key, flag, ts=ts, tz=tz, tiebreak=tiebreak)
    per_key = states if states is not None else visitor_states(df, key, flag, ts, tiebreak, tz)
    tagged = df.withColumn("_key", _col(key))
    joined = tagged.join(per_key, "_key", "left")
    raw = _col(flag)
    fixed = F.when((raw == "1") & (F.col("_state") != to_date_str(ts, tz)), F.lit("0")).otherwise(raw)
    parent, _, leaf = flag.rpartition(".")
    if parent:
        out = joined.withColumn(parent, F.col(parent).withField(leaf, fixed))
    else:
        out = joined.withColumn(flag, fixed)
    return out.drop("_key", "_state")
