from pyspark.sql import functions as F

from flowmart.operators import daily, logsplit
from tests.helpers import log_df, log_row, ms


def test_dirty_json(spark):
    raw = spark.createDataFrame(
        [(1, "{bad"), (2, ""), (3, None),
         (4, '{"common":{"mid":"m","is_new":"1"},"page":{"page_id":"home"},"ts":1}'),
         (5, '{"common":{"is_new":"1"},"page":{"page_id":"home"},"ts":1}')],
        "event_id long, value string")
    valid, dirty = logsplit.parse_log(raw)
    assert [r.event_id for r in valid.collect()] == [4]
    # a line missing a required field (mid) joins the dirty output (Q15)
    assert sorted((r.event_id, r.value) for r in dirty.collect()) == [
        (1, "{bad"), (5, '{"common":{"is_new":"1"},"page":{"page_id":"home"},"ts":1}')]


GOOD = '"common":{"mid":"m","is_new":"1","uid":null,"os":"x"},"page":{"page_id":"home","during_time":"12","k":1}'


def test_exactly_one_object_with_a_time(spark):
    lines = ["{%s,\"ts\":\"1000\"}" % GOOD, "{%s,\"ts\":1000,\"z\":[1]}" % GOOD,
             "{%s,\"ts\":1} tail" % GOOD, "{%s,\"ts\":1}]" % GOOD, "{%s,\"ts\":1}}" % GOOD,
             "{%s,\"ts\":1}{%s,\"ts\":1}" % (GOOD, GOOD), "{%s}" % GOOD, "{%s,\"ts\":\"x\"}" % GOOD,
             "[1]", "5", "null", "   "]
    raw = spark.createDataFrame(list(enumerate(lines)), "event_id long, value string")
    valid, dirty = logsplit.parse_log(raw)
    got = {r.event_id: (r.ts, r.page.during_time, r.common.uid) for r in valid.drop("record").collect()}
    assert got == {0: (1000, 12, None), 1: (1000, 12, None)}
    assert sorted(r.event_id for r in dirty.collect()) == list(range(2, 11))


def test_whole_records_as_json(spark):
    lines = ['{"extra":{"b":1,"a":"t"},%s,"ts":1000}' % GOOD,
             '{%s,"ts":1704200000000,"actions":[{"n":1}],"displays":[{"n":"2","q":null}],"err":{"c":7}}' % GOOD]
    out = logsplit.json_outputs(logsplit.log_layer(
        spark.createDataFrame(list(enumerate(lines)), "event_id long, value string"), tiebreak="event_id"))
    got = {k: [(r.event_id, r.value) for r in df.orderBy("event_id").collect()] for k, df in out.items()}
    page = '"page":{"during_time":"12","k":1,"page_id":"home"}'
    new, old = ('"common":{"is_new":"%s","mid":"m","os":"x"}' % f for f in "10")
    assert got["page"] == [(0, '{%s,"extra":{"a":"t","b":1},%s,"ts":1000}' % (new, page)),
                           (1, '{%s,%s,"ts":1704200000000}' % (old, page))]
    assert got["display"] == [(1, '{"n":"2","page_id":"home","ts":1704200000000}')]
    assert got["action"] == [(1, '{"n":1,"page_id":"home"}')]
    assert got["error"] == [(1, '{"actions":[{"n":1}],%s,"displays":[{"n":"2","q":null}],"err":{"c":7},%s,'
                                '"ts":1704200000000}' % (old, page))]
    assert got["start"] == []


def test_a_line_without_time_does_not_turn_the_repair_off(spark):
    lines = ["{%s}" % GOOD] + ["{%s,\"ts\":%d}" % (GOOD, t) for t in (ms(1, 1), ms(2, 1))]
    page = logsplit.log_layer(spark.createDataFrame(list(enumerate(lines)), "event_id long, value string"))["page"]
    assert {r.event_id: r.common.is_new for r in page.drop("record").collect()} == {1: "1", 2: "0"}


def test_fix_is_new(spark):
    rows = [
        log_row(1, "a", ms(1, 1), "1"), log_row(2, "a", ms(1, 2), "1"), log_row(3, "a", ms(2, 1), "1"),
        log_row(4, "b", ms(1, 1), "0"), log_row(5, "b", ms(1, 2), "1"), log_row(6, "b", ms(2, 1), "1"),
        log_row(7, "c", ms(1, 1), "1"), log_row(8, "c", ms(2, 1), "0"), log_row(9, "c", ms(1, 2), "1"),
    ]
    out = daily.fix_is_new(log_df(spark, rows), tiebreak="event_id")
    got = {r.event_id: r.common.is_new for r in out.collect()}
    # c: event 9 (day 1) sorts before event 8 (day 2) in event order
    assert [got[i] for i in range(1, 10)] == ["1", "1", "0", "0", "0", "0", "1", "0", "1"]


def test_fix_is_new_window_fallback_agrees(spark):
    rows = [log_row(i, "m%d" % (i % 3), ms(1 + i % 4, i % 24), "1" if i % 2 else "0")
            for i in range(40)]
    df = log_df(spark, rows)
    a = {r.event_id: r.common.is_new for r in daily.fix_is_new(df, tiebreak="event_id").collect()}
    b = {r.event_id: r.common.is_new for r in daily.fix_is_new(df).collect()}
    assert a == b


def test_split(spark):
    rows = [
        log_row(1, "m", 1000, page_id="p1", err='{"code":1}',
                displays=[{"item": "x"}, {"item": "y"}], actions=[{"action_id": "a", "ts": "5"}]),
        log_row(2, "m", 2000, page=False, start='{"entry":"icon"}', displays=[{"item": "z"}]),
    ]
    out = logsplit.split_log(log_df(spark, rows))
    err = out["error"].collect()
    assert len(err) == 1 and err[0].err == '{"code":1}' and len(err[0].displays) == 2
    page = out["page"].collect()
    assert len(page) == 1 and page[0].event_id == 1
    assert set(out["page"].columns) == {"event_id", "common", "page", "ts"}
    disp = out["display"].collect()
    assert sorted(r.display["item"] for r in disp) == ["x", "y"]
    assert all(r.page_id == "p1" and r.ts == 1000 for r in disp)
    act = out["action"].collect()
    assert len(act) == 1 and act[0].page_id == "p1" and "ts" not in out["action"].columns
    assert act[0].action["ts"] == "5"  # the action's own field, nothing added
    start = out["start"].collect()
    assert [r.event_id for r in start] == [2] and "err" not in out["start"].columns
