"""The order key of first rows (T5-T8): one number in the order of (ts, tiebreak)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowmart.operators import daily
from flowmart.plans import queries as Q

MS = st.integers(-(1 << 58), 1 << 58)
ID = st.one_of(st.none(), st.integers(-(1 << 63) + 1, (1 << 63) - 1))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(MS, ID, st.booleans()), min_size=1, max_size=40))
def test_keys_sort_and_split_like_their_parts(spark, rows):
    rows += [(1_704_067_200_000, i, f) for i in (None, -(1 << 63) + 1, -1, 0, 1, (1 << 63) - 1) for f in (False, True)]
    df = spark.createDataFrame(rows, "ts bigint, id bigint, f boolean")
    k = df.withColumn("k", daily.order_key("ts", "id", F.col("f")))
    got = k.select("*", *(v.alias(f"_{n}") for n, v in daily.key_parts("k").items())).collect()
    least = -(1 << 63)
    assert all((r["_ts"], r["_tiebreak"], r["_flag"]) == (r.ts, least if r.id is None else r.id, int(r.f)) for r in got)
    by_key = sorted(got, key=lambda r: r.k)
    by_part = sorted(got, key=lambda r: (r.ts, least if r.id is None else r.id, r.f))
    assert [r.k for r in by_key] == [r.k for r in by_part]


@pytest.mark.parametrize("name", ["daily_uv", "home_detail_daily", "login_return", "fix_is_new", "home_detail_window",
                                  "login_window", "home_detail_daily_per_page"])
def test_first_rows_are_found_by_hash(spark, name):
    plan = Q.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_raw_rows_are_combined_by_hash_before_the_traffic_window(spark):
    plan = Q.queries()["traffic_window"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    deepest = max((len(x) - len(x.lstrip(" :+-")), x) for x in lines if "Aggregate" in x)
    assert "HashAggregate" in deepest[1] and "partial_min" in deepest[1]
