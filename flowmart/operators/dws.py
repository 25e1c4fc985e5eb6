"""DWS layer: windowed metrics over the page log.

Windows are epoch-aligned tumbling event-time windows (``[start, end)``, no
offset), expressed with ``F.window`` over the instant of ``ts`` so the same
plan runs on batch tables and, after ``withWatermark``, on streams.  All
aggregates are sums/counts, so Spark aggregates partially before the shuffle;
the reference's single-task ``windowAll`` becomes a partial + final sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.functions import text as text_fn
from flowmart.functions.timefn import (DATE_FMT, DATETIME_FMT, event_time, format_ms,
                                       now_ms, now_s)
from flowmart.operators import daily
from flowmart.session import DEFAULT_TZ, WATERMARK_DELAY, WINDOW_SIZE


def with_event_time(df: DataFrame, ts: str = "ts", delay: str | None = WATERMARK_DELAY,
                    out: str = "rt") -> DataFrame:
    """Event-time column from epoch ms, watermark on streams."""
    df = df.withColumn(out, event_time(ts))
    if df.isStreaming and delay:
        df = df.withWatermark(out, delay)
    return df


def _rt(df: DataFrame, ts: str) -> DataFrame:
    return df if "rt" in df.columns else with_event_time(df, ts)


def window_bounds(window_col: str = "w", tz: str = DEFAULT_TZ, bounds: str = "datetime",
                  ) -> list[Column]:
    """A5: ``stt``/``edt`` text of a window (``bounds`` = "datetime" or "date";
    the reference prints some 10 s windows as a date only, Q8)."""
    fmt = DATETIME_FMT if bounds == "datetime" else DATE_FMT
    return [format_ms(F.unix_millis(F.col(f"{window_col}.start")), fmt, tz).alias("stt"),
            format_ms(F.unix_millis(F.col(f"{window_col}.end")), fmt, tz).alias("edt")]


def page_filter(df: DataFrame, pages=("home", "good_detail")) -> DataFrame:
    """P5: keep the home and detail pages."""
    return df.where(F.col("page.page_id").isin(*pages))


def login_filter(df: DataFrame) -> DataFrame:
    """Uid present and the page was entered from nowhere or from login."""
    lp = F.col("page.last_page_id")
    return df.where(F.col("common.uid").isNotNull() & (lp.isNull() | (lp == "login")))


def keyword_filter(df: DataFrame) -> DataFrame:
    """Search-result pages with a keyword item."""
    return df.where((F.col("page.last_page_id") == "search")
                    & (F.col("page.item_type") == "keyword")
                    & F.col("page.item").isNotNull())


def traffic_measures(df: DataFrame, session_field: str = "last_page",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat measure rows: mid, dimensions, sv (session start), duration.

    The reference tests ``page.last_page`` for a session start (Q7), a field
    its logs do not carry, so every row starts a session;
    ``session_field="last_page_id"`` gives the intended test.  uv is added by
    the daily state step and pv is a row count.
    """
    return df.select(
        *keep, "ts", *(["rt"] if "rt" in df.columns else []),
        F.col("common.mid").alias("mid"),
        F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"),
        F.col("common.ar").alias("ar"), F.col("common.is_new").alias("isNew"),
        F.when(F.col(f"page.{session_field}").isNull(), 1).otherwise(0).cast("bigint").alias("sv"),
        F.col("page.during_time").alias("dur"),
    )


def traffic_window(
    log: DataFrame,
    size: str = WINDOW_SIZE,
    tz: str = DEFAULT_TZ,
    session_field: str = "last_page",
    tiebreak: str | None = None,
    bounds: str = "datetime",
    load_ts: bool = True,
) -> DataFrame:
    """A2 + T7: uv, sv, pv, duration by (vc, ch, ar, is_new) per window.

    Rows without a mid cannot be keyed and are dropped (Q15).  ``tiebreak``
    names a unique row id; with it the daily-unique flag is computed without
    sorting any key's rows in one task (see :mod:`flowmart.operators.daily`).
    """
    log = _rt(log.where(F.col("common.mid").isNotNull()), "ts")
    m = traffic_measures(log, session_field, keep=(tiebreak,) if tiebreak else ())
    if not log.isStreaming:
        # uv is only summed per group: count each (mid, day) first row, which
        # carries its own dimensions, beside the other measures -- no join of
        # a flag back onto every row; both sides aggregate before any shuffle
        dims = ("vc", "ch", "ar", "isNew")
        firsts = daily.first_of_day(m, "mid", "ts", tiebreak, tz, carry=[(d, d) for d in dims])
        uv = firsts.select(event_time("_ts").alias("rt"), *dims,
                           F.lit(1).cast("bigint").alias("uv"), F.lit(0).cast("bigint").alias("sv"),
                           F.lit(0).cast("bigint").alias("pv"), F.lit(None).cast("bigint").alias("dur"))
        rest = m.select("rt", *dims, F.lit(0).cast("bigint").alias("uv"), "sv",
                        F.lit(1).cast("bigint").alias("pv"), F.col("dur").cast("bigint").alias("dur"))
        flagged = uv.unionByName(rest)
        pv = F.sum("pv")
    else:
        flagged = daily.daily_first_flag(m, "mid", "uv", "ts", tiebreak, tz)
        pv = F.count(F.lit(1))
    out = (
        flagged.groupBy(F.window("rt", size).alias("w"), "vc", "ch", "ar", "isNew")
        .agg(F.sum("uv").alias("uvCt"), F.sum("sv").alias("svCt"),
             pv.alias("pvCt"), F.sum("dur").alias("durSum"))
        .select(*window_bounds("w", tz, bounds), "vc", "ch", "ar", "isNew",
                "uvCt", "svCt", "pvCt", "durSum")
    )
    return out.withColumn("ts", now_ms()) if load_ts else out


def home_detail_window(
    log: DataFrame,
    size: str = WINDOW_SIZE,
    tz: str = DEFAULT_TZ,
    per_page: bool = False,
    tiebreak: str | None = None,
    bounds: str = "date",
    load_ts: bool = True,
) -> DataFrame:
    """A3 + T6 + P15: home and detail unique visitors per window (all keys)."""
    pages = _rt(page_filter(log).where(F.col("common.mid").isNotNull()), "ts")
    rows = daily.home_detail_firsts(pages, "common.mid", "page.page_id", "ts", tiebreak,
                                    tz, per_page)
    out = (
        _rt(rows, "ts").groupBy(F.window("rt", size).alias("w"))
        .agg(F.sum("homeUv").alias("homeUvCt"), F.sum("detailUv").alias("goodDetailUvCt"))
        .select(*window_bounds("w", tz, bounds), "homeUvCt", "goodDetailUvCt")
    )
    return out.withColumn("ts", now_ms()) if load_ts else out


def login_window(
    log: DataFrame,
    size: str = WINDOW_SIZE,
    tz: str = DEFAULT_TZ,
    tiebreak: str | None = None,
    back_days: int = 7,
    bounds: str = "date",
    load_ts: bool = True,
) -> DataFrame:
    """A4 + T8 + P15: unique and returning logins per window (all keys)."""
    rows = daily.login_firsts(_rt(login_filter(log), "ts"), "common.uid", "ts", tiebreak, tz,
                              back_days)
    out = (
        _rt(rows, "ts").groupBy(F.window("rt", size).alias("w"))
        .agg(F.sum("back").alias("backCt"), F.sum("uu").alias("uuCt"))
        .select(*window_bounds("w", tz, bounds), "backCt", "uuCt")
    )
    return out.withColumn("ts", now_ms()) if load_ts else out


def keyword_window(
    log: DataFrame,
    size: str = WINDOW_SIZE,
    tz: str = DEFAULT_TZ,
    pattern: str = text_fn.WORD_PATTERN,
    dictionary: DataFrame | None = None,
    load_ts: bool = True,
) -> DataFrame:
    """A1 + J5 + U1: count of each search keyword per window.

    ``dictionary`` (a column ``term``) counts its terms wherever they occur (U2)
    instead of the text's words.  The load time ``ts`` is in seconds here, as in
    the reference (Q9).
    """
    items = _rt(keyword_filter(log), "ts").select("rt", F.col("page.item").alias("item"))
    if dictionary is None:
        words = text_fn.explode_words(items, "item", "keyword", pattern)
    else:
        words = text_fn.dictionary_terms(items, "item", dictionary).withColumnRenamed("term", "keyword")
    out = (
        words.groupBy(F.window("rt", size).alias("w"), "keyword")
        .agg(F.count(F.lit(1)).alias("keyword_count"))
        .select(*window_bounds("w", tz, "datetime"), "keyword", "keyword_count")
    )
    return out.withColumn("ts", now_s()) if load_ts else out
