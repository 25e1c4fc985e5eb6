"""Property tests: the batch forms of the keyed state (T5-T8) equal a plain
loop over rows that applies the reference's per-record state logic."""

from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flowmart.operators import daily
from tests.helpers import log_df, log_row

SH = timezone(timedelta(hours=8))
BASE = int(datetime(2024, 1, 1, tzinfo=SH).timestamp() * 1000)
HOUR = 3_600_000

rows_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 24 * 20), st.sampled_from(["0", "1"])),
    min_size=1, max_size=40)


def _events(rows):
    # unique (ts, id) order; ts spread over 20 days in hours
    return [(i, mid, BASE + h * HOUR + i, flag) for i, (mid, h, flag) in enumerate(rows)]


def _day(ms):
    return datetime.fromtimestamp(ms / 1000, SH).strftime("%Y-%m-%d")


def _loop_state(events):
    """Reference logic, per record in (ts, id) order."""
    uv, fixed, login = {}, {}, {}
    last, first, last_login = {}, {}, {}
    for i, mid, ts, flag in sorted(events, key=lambda e: (e[2], e[0])):
        d = _day(ts)
        uv[i] = 1 if last.get(mid) != d else 0
        last[mid] = d
        if flag == "1":
            cur = first.get(mid)
            if cur is None or cur == d:
                first[mid] = d
                fixed[i] = "1"
            else:
                fixed[i] = "0"
        else:
            first.setdefault(mid, "1970-01-01")
            fixed[i] = flag
        prev = last_login.get(mid)
        if prev != d:
            midnight = int(datetime.strptime(prev, "%Y-%m-%d").replace(tzinfo=SH).timestamp() * 1000) \
                if prev else None
            login[i] = 1 if prev and (ts - midnight) // (24 * HOUR) > 7 else 0
            last_login[mid] = d
    return uv, fixed, login


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_st)
def test_batch_state_equals_loop(spark, rows):
    events = _events(rows)
    df = log_df(spark, [log_row(i, m, ts, flag) for i, m, ts, flag in events])
    want_uv, want_fixed, want_back = _loop_state(events)
    uv = {r.event_id: r.uv for r in daily.daily_first_flag(df, "common.mid", tiebreak="event_id").collect()}
    assert uv == want_uv
    fixed = {r.event_id: r.common.is_new for r in daily.fix_is_new(df, tiebreak="event_id").collect()}
    assert fixed == want_fixed
    back = {r.event_id: r.back for r in daily.login_firsts(df, tiebreak="event_id").collect()}
    assert back == want_back


pages_st = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 24 * 6), st.sampled_from(["home", "good_detail"])),
    min_size=1, max_size=30)


def _loop_home_detail(events, per_page):
    """Reference logic: one date state per mid (or per mid and page)."""
    last, out = {}, {}
    for i, mid, ts, page in sorted(events, key=lambda e: (e[2], e[0])):
        key = (mid, page) if per_page else mid
        d = _day(ts)
        if last.get(key) != d:
            last[key] = d
            out[i] = (1, 0) if page == "home" else (0, 1)
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pages_st)
def test_home_detail_equals_loop(spark, rows):
    events = [(i, mid, BASE + h * HOUR + i, page) for i, (mid, h, page) in enumerate(rows)]
    df = log_df(spark, [log_row(i, m, ts, page_id=p) for i, m, ts, p in events])
    for per_page in (False, True):
        got = {r.event_id: (r.homeUv, r.detailUv)
               for r in daily.home_detail_firsts(df, tiebreak="event_id", per_page=per_page).collect()}
        assert got == _loop_home_detail(events, per_page)
