from pyspark.sql import functions as F

from flowmart.functions import text, timefn
from tests.helpers import ms


def test_date_functions_ignore_session_zone(spark):
    df = spark.createDataFrame([(ms(1, 0, 0, 0.5),), (ms(1, 23, 59, 59.999),)], "ts long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        rows = df.select(timefn.to_date_str("ts").alias("d"),
                         timefn.to_ymd_hms("ts").alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [tuple(r) for r in rows] == [("2024-01-01", "2024-01-01 00:00:00"),
                                        ("2024-01-01", "2024-01-01 23:59:59")]


def test_to_ts_round_trip_and_bad_text(spark):
    df = spark.createDataFrame([("2024-01-02",), ("null",)], "d string")
    rows = df.select(timefn.to_ts("d").alias("t")).collect()
    assert rows[0].t == ms(2, 0)
    assert rows[1].t is None  # the reference throws here (Q5)
    full = spark.createDataFrame([("2024-01-02 10:00:00",)], "d string")
    assert full.select(timefn.to_ts("d", is_full=True)).first()[0] == ms(2, 10)


def test_window_edges(spark):
    from flowmart.operators.dws import window_bounds
    base = ms(1, 10)  # a multiple of 10 s
    df = spark.createDataFrame([(base + 9999,), (base + 10000,)], "ts long")
    rows = (df.withColumn("rt", timefn.event_time("ts"))
            .select(F.window("rt", "10 seconds").alias("w"), "ts")
            .select(*window_bounds("w"), "ts").orderBy("ts").collect())
    assert (rows[0].stt, rows[0].edt) == ("2024-01-01 10:00:00", "2024-01-01 10:00:10")
    assert (rows[1].stt, rows[1].edt) == ("2024-01-01 10:00:10", "2024-01-01 10:00:20")


def test_split_words_keeps_order_and_repeats(spark):
    df = spark.createDataFrame([("Red  bolt red-7",)], "s string")
    assert df.select(text.split_words("s")).first()[0] == ["red", "bolt", "red", "7"]


def test_dictionary_terms_overlapping_hits(spark):
    df = spark.createDataFrame([(1, "cold gold"), (2, "")], "id long, s string")
    vocab = spark.createDataFrame([("old",), ("cold",), ("gold",), ("",)], "term string")
    hits = text.dictionary_terms(df, "s", vocab).select("id", "pos", "term").collect()
    assert sorted(tuple(r) for r in hits) == [(1, 1, "cold"), (1, 2, "old"), (1, 6, "gold"),
                                               (1, 7, "old")]


def test_duration_ms():
    assert timefn.duration_ms("10 seconds") == 10_000
    assert timefn.duration_ms("1 hour") == 3_600_000


def test_sql_functions(spark):
    text.register_sql_functions(spark)
    words = spark.sql("SELECT w.word FROM VALUES ('Red bolt 7') AS t(item), "
                      "LATERAL split_function(t.item) w").collect()
    assert [r.word for r in words] == ["red", "bolt", "7"]
    ms_ = ms(1, 23, 59, 59.5)
    row = spark.sql(f"SELECT to_date_str({ms_}L) AS d, to_ymd_hms({ms_}L) AS t").first()
    assert (row.d, row.t) == ("2024-01-01", "2024-01-01 23:59:59")
    # same as the Column functions
    df = spark.createDataFrame([(ms_,)], "ts long")
    col = df.select(timefn.to_date_str("ts"), timefn.to_ymd_hms("ts")).first()
    assert (col[0], col[1]) == (row.d, row.t)


def test_dictionary_positions_cost_the_same_for_any_lengths(spark):
    """One row per position, whether the dictionary has two lengths of terms or twenty."""
    words = ["alpha", "beta", "gammadelta", "ab", "abc", "al", "etag"]
    df = spark.createDataFrame([(1, "alphabetagamma" * 60), (2, ""), (3, None), (4, "xalx")], "id int, s string")
    rows = []
    for n in (2, 20):
        terms = [w for w in words] + ["q" * k for k in range(2, 2 + n)]
        vocab = spark.createDataFrame([(w,) for w in [*terms, "", None, terms[0]]], "term string")
        most = F.lit(max(map(len, terms)))
        rows.append(text._positions(df, F.col("s"), most, F.lit(False)).count())
        got = sorted((r.id, r.pos, r.term) for r in text.dictionary_terms(df, "s", vocab).collect())
        want = sorted((i, p + 1, w) for i, s in ((1, "alphabetagamma" * 60), (4, "xalx")) for w in terms
                      for p in range(len(s)) if s.startswith(w, p))
        assert got == want
    assert rows == [len("alphabetagamma" * 60) + 4] * 2


def test_dictionary_terms_of_one_character(spark):
    df = spark.createDataFrame([(1, "a𝒳ab中")], "id int, s string")
    vocab = spark.createDataFrame([("a",), ("ab",), ("𝒳",), ("中",), ("b中x",)], "term string")
    got = sorted((r.pos, r.term) for r in text.dictionary_terms(df, "s", vocab).collect())
    assert got == [(1, "a"), (2, "𝒳"), (3, "a"), (3, "ab"), (5, "中")]
