"""Hand-row builders for operator tests."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from flowmart import schemas

SH = timezone(timedelta(hours=8))


def ms(day: int, hh: int = 10, mm: int = 0, ss: float = 0.0) -> int:
    """Epoch ms of 2024-01-<day> hh:mm:ss in Asia/Shanghai."""
    base = datetime(2024, 1, 1, tzinfo=SH) + timedelta(days=day - 1, hours=hh, minutes=mm)
    return int(base.timestamp() * 1000 + round(ss * 1000))


def log_row(event_id, mid, ts, is_new="1", page_id="home", last_page_id=None, uid=None,
            vc="v1", ch="web", ar="a1", item=None, item_type=None, during_time=10,
            last_page=None, start=None, displays=None, actions=None, err=None, page=True):
    common = (mid, uid if uid is not None else mid, is_new, vc, ch, ar)
    pg = (page_id, last_page_id, item, item_type, during_time, last_page) if page else None
    return (event_id, common, pg, start, displays, actions, err, ts)


def log_df(spark, rows):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("event_id", T.LongType())] + schemas.LOG.fields)
    return spark.createDataFrame(rows, schema)
