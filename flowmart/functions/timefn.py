"""Time functions (F1-F8).

Log ``ts`` is epoch milliseconds.  All functions take an explicit ``tz`` and
are independent of ``spark.sql.session.timeZone``: epoch millis are turned into
a TIMESTAMP_NTZ at UTC with ``timestampadd`` and shifted with
``convert_timezone``, both pure column expressions that stay in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmart.session import DEFAULT_TZ

# Formats and the fixed offset used by the reference's toTs.
DATE_FMT = "yyyy-MM-dd"
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
TO_TS_OFFSET = "+08:00"
DAY_MS = 24 * 3600 * 1000

_EPOCH_TEXT = "1970-01-01 00:00:00"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _epoch() -> Column:
    return F.lit(_EPOCH_TEXT).cast("timestamp_ntz")


def ntz_to_ms(col: Column | str) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> epoch milliseconds (bigint)."""
    return F.timestamp_diff("MILLISECOND", _epoch(), _c(col))


def ms_to_utc_ntz(ms: Column | str) -> Column:
    """Epoch millis -> TIMESTAMP_NTZ holding the UTC wall clock."""
    return F.timestamp_add("MILLISECOND", _c(ms), _epoch())


def ms_to_local(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """Epoch millis -> TIMESTAMP_NTZ holding the wall clock in ``tz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), ms_to_utc_ntz(ms))


def to_date_str(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """F2 ``toDate(ms)`` -> ``yyyy-MM-dd`` in ``tz``."""
    return F.date_format(ms_to_local(ms, tz), DATE_FMT)


def to_ymd_hms(ms: Column | str, tz: str = DEFAULT_TZ) -> Column:
    """F3 ``toYmdHms(ms)`` -> ``yyyy-MM-dd HH:mm:ss`` in ``tz``."""
    return F.date_format(ms_to_local(ms, tz), DATETIME_FMT)


def to_ts(s: Column | str, is_full: bool = False, offset: str = TO_TS_OFFSET) -> Column:
    """F1 ``toTs(str, isFull)``: date or date-time text at a fixed offset -> ms.

    The reference pins UTC+8 here even where ``toDate`` uses the machine zone;
    ``offset`` keeps that literal.  Unparseable text gives null.
    """
    if is_full:
        # wall clock recovered exactly: parse and cast back use the same zone
        local = F.try_to_timestamp(_c(s), F.lit(DATETIME_FMT)).cast("timestamp_ntz")
    else:
        local = F.try_to_date(_c(s), DATE_FMT).cast("timestamp_ntz")
    return ntz_to_ms(F.convert_timezone(F.lit(offset), F.lit("UTC"), local))


def event_time(ms: Column | str) -> Column:
    """F4 ``TO_TIMESTAMP_LTZ(ts, 3)``: an instant usable for watermarks."""
    return F.timestamp_millis(_c(ms))


def format_ms(ms: Column | str, fmt: str, tz: str = DEFAULT_TZ) -> Column:
    """F5 ``date_format`` of an epoch-millis instant in ``tz``."""
    return F.date_format(ms_to_local(ms, tz), fmt)


def now_ms() -> Column:
    """F7 current time in ms (load time of a result row)."""
    return F.unix_millis(F.current_timestamp())


def now_s() -> Column:
    """F6 ``UNIX_TIMESTAMP()`` in seconds."""
    return F.unix_seconds(F.current_timestamp())


def window_start_ms(ms: Column | str, size_ms: int) -> Column:
    """Start of the epoch-aligned tumbling window holding ``ms`` (no offset)."""
    c = _c(ms)
    return c - F.pmod(c, F.lit(size_ms))


def duration_ms(duration: str) -> int:
    """F8 interval literal such as ``"10 seconds"`` or ``"1 hour"`` -> ms."""
    n, unit = duration.split()
    unit = unit.rstrip("s").lower()
    scale = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000,
             "day": DAY_MS}[unit]
    return int(n) * scale
