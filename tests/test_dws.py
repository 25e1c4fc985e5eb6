from flowmart.operators import daily, dws
from tests.helpers import log_df, log_row, ms


def test_home_detail_shared_state(spark):
    rows = [log_row(1, "m", ms(1, 1), page_id="home"), log_row(2, "m", ms(1, 2), page_id="good_detail")]
    df = log_df(spark, rows)
    shared = daily.home_detail_firsts(df, tiebreak="event_id").collect()
    assert sum(r.homeUv for r in shared) == 1 and sum(r.detailUv for r in shared) == 0
    per_page = daily.home_detail_firsts(df, tiebreak="event_id", per_page=True).collect()
    assert sum(r.homeUv for r in per_page) == 1 and sum(r.detailUv for r in per_page) == 1


def test_out_of_order_dates_in_event_order(spark):
    # arrival: day 2, day 1, day 2 -> the reference counts 3; in event order 2 (Q14)
    rows = [log_row(1, "m", ms(2)), log_row(2, "m", ms(1)), log_row(3, "m", ms(2, 11))]
    out = daily.daily_first_flag(log_df(spark, rows), "common.mid", tiebreak="event_id")
    assert sum(r.uv for r in out.collect()) == 2


def test_login_return(spark):
    rows = [log_row(1, "u", ms(1), last_page_id=None), log_row(2, "u", ms(8), last_page_id="login"),
            log_row(3, "u", ms(16), last_page_id=None),
            log_row(4, "u", ms(16, 12), last_page_id="home")]  # filtered out (P6)
    out = daily.login_firsts(dws.login_filter(log_df(spark, rows)), tiebreak="event_id")
    got = sorted((r.ts, r.uu, r.back) for r in out.collect())
    assert [(u, b) for _, u, b in got] == [(1, 0), (1, 0), (1, 1)]


def test_session_field(spark):
    rows = [log_row(1, "m", ms(1), last_page_id="home")]
    df = log_df(spark, rows)
    lit = dws.traffic_window(df, tiebreak="event_id", load_ts=False).first()
    assert lit.svCt == 1 and lit.uvCt == 1 and lit.pvCt == 1
    intent = dws.traffic_window(df, tiebreak="event_id", session_field="last_page_id",
                                load_ts=False).first()
    assert intent.svCt == 0


def test_null_duration_is_skipped(spark):
    rows = [log_row(1, "m", ms(1), during_time=None), log_row(2, "m", ms(1, 10, 0, 1), during_time=5)]
    out = dws.traffic_window(log_df(spark, rows), tiebreak="event_id", load_ts=False).collect()
    assert [(r.pvCt, r.durSum) for r in out] == [(2, 5)]


def test_keyword_window(spark):
    rows = [log_row(1, "m", ms(1), last_page_id="search", item="Red bolt", item_type="keyword"),
            log_row(2, "m", ms(1, 10, 0, 1), last_page_id="search", item="red", item_type="keyword"),
            log_row(3, "m", ms(1, 10, 0, 2), last_page_id="home", item="red", item_type="keyword")]
    out = dws.keyword_window(log_df(spark, rows), load_ts=False).collect()
    assert sorted((r.keyword, r.keyword_count) for r in out) == [("bolt", 1), ("red", 2)]


def test_windows_with_load_time(spark):
    rows = [log_row(1, "m", ms(1))]
    out = dws.home_detail_window(log_df(spark, rows), tiebreak="event_id").first()
    assert out.stt == "2024-01-01" and out.homeUvCt == 1 and out.ts > 1_600_000_000_000
