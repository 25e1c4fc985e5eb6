"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's tables (or data Spark derives from them) in
full; the load-time column of the reference's beans is left out because it is
the wall clock of the run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart import schemas
from flowmart.functions import text, timefn
from flowmart.operators import cdc, config, daily, dim, dwd, dws, logsplit, lookup, parse, trade
from flowmart.sources import fixtures as fx
from flowmart.sources.catalog import Tables
from flowmart.streaming import sinks

Query = Callable[[SparkSession, str], DataFrame]

TIEBREAK = "event_id"


def traffic_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir))
    return dws.traffic_window(log, "10 seconds", tiebreak=TIEBREAK, load_ts=False)


def traffic_window_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir))
    return dws.traffic_window(log, "1 hour", session_field="last_page_id",
                              tiebreak=TIEBREAK, load_ts=False)


def home_detail_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir))
    return dws.home_detail_window(log, "10 seconds", tiebreak=TIEBREAK, load_ts=False)


def home_detail_window_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir))
    return dws.home_detail_window(log, "1 hour", tiebreak=TIEBREAK, bounds="datetime",
                                  load_ts=False)


def login_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir))
    return dws.login_window(log, "10 seconds", tiebreak=TIEBREAK, load_ts=False)


def login_window_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir))
    return dws.login_window(log, "1 hour", tiebreak=TIEBREAK, bounds="datetime", load_ts=False)


def keyword_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir), with_item=True)
    return dws.keyword_window(log, "10 seconds", load_ts=False)


def keyword_window_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir), with_item=True)
    return dws.keyword_window(log, "1 hour", load_ts=False)


def keyword_window_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of whole documents (four languages) in one-minute windows."""
    return dws.keyword_window(fx.text_log(Tables(spark, sf_dir)), "1 minute", load_ts=False)


def keyword_window_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword window in dictionary mode (U2): the words of part names as dictionary."""
    t = Tables(spark, sf_dir)
    vocab = t("part").select(F.explode(text.split_words("p_name")).alias("term"))
    return dws.keyword_window(fx.page_log(t, with_item=True), "1 hour", dictionary=vocab, load_ts=False)


def keyword_window_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword window job written in SQL, as the reference writes it: a view of the page log
    (P16), the registered table function (U1) and a 10 s window (T3)."""
    text.register_sql_functions(spark)
    log = fx.page_log(Tables(spark, sf_dir), with_item=True)
    return spark.sql("""
        WITH flit AS (
          SELECT page.item AS item, timestamp_millis(ts) AS rt
          FROM {log}
          WHERE page.last_page_id = 'search' AND page.item_type = 'keyword'
            AND page.item IS NOT NULL)
        SELECT to_ymd_hms(unix_millis(window.start)) AS stt,
               to_ymd_hms(unix_millis(window.end)) AS edt,
               word AS keyword, count(*) AS keyword_count
        FROM flit, LATERAL split_function(item)
        GROUP BY window(rt, '10 seconds'), word""", log=log)


def daily_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir))
    out = daily.daily_first_flag(log, "common.mid", "uv", "ts", TIEBREAK)
    return out.select("event_id", F.col("common.mid").alias("mid"), "ts", "uv")


def home_detail_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = dws.page_filter(fx.page_log(Tables(spark, sf_dir)))
    return daily.home_detail_firsts(log, tiebreak=TIEBREAK)


def home_detail_daily_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = dws.page_filter(fx.page_log(Tables(spark, sf_dir)))
    return daily.home_detail_firsts(log, tiebreak=TIEBREAK, per_page=True)


def login_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = dws.login_filter(fx.page_log(Tables(spark, sf_dir)))
    return daily.login_firsts(log, tiebreak=TIEBREAK)


def fix_is_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = fx.page_log(Tables(spark, sf_dir))
    raw = log.select("event_id", "ts", "common", F.col("common.is_new").alias("raw_is_new"))
    out = daily.fix_is_new(raw, tiebreak=TIEBREAK)
    return out.select("event_id", F.col("common.mid").alias("mid"), "ts", "raw_is_new",
                      F.col("common.is_new").alias("is_new"))


def _page_cols(df: DataFrame) -> DataFrame:
    return df.select("event_id", F.col("common.mid").alias("mid"),
                     F.col("page.page_id").alias("page_id"),
                     F.col("page.last_page_id").alias("last_page_id"), "ts")


def page_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_cols(dws.page_filter(fx.page_log(Tables(spark, sf_dir))))


def login_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_cols(dws.login_filter(fx.page_log(Tables(spark, sf_dir))))


def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = dws.keyword_filter(fx.page_log(Tables(spark, sf_dir), with_item=True))
    return df.select("event_id", F.col("page.item").alias("item"), "ts")


def _log_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return logsplit.log_layer(fx.ods_log_text(Tables(spark, sf_dir)), tiebreak=TIEBREAK)


def _size(c: str):
    """Element count, null for a missing array (whatever the ANSI setting)."""
    return F.when(F.col(c).isNotNull(), F.size(c)).cast("bigint")


def parse_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = logsplit.parse_log(fx.ods_log_text(Tables(spark, sf_dir)))
    return valid.select(
        "event_id", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"),
        F.col("page.page_id").alias("page_id"), F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.during_time").alias("during_time"), "start", "err", "ts",
        _size("displays").alias("n_displays"), _size("actions").alias("n_actions"))


def parse_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dirty = logsplit.parse_log(fx.ods_log_text(Tables(spark, sf_dir)))
    return dirty.select("event_id", "value")


def log_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = _log_layer(spark, sf_dir)["page"]
    return page.select(
        "event_id", *[F.col(f"common.{c}").alias(c) for c in ("mid", "uid", "is_new", "vc", "ch", "ar")],
        F.col("page.page_id").alias("page_id"), F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.during_time").alias("during_time"), "ts")


def log_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = _log_layer(spark, sf_dir)["start"]
    return start.select("event_id", F.col("common.mid").alias("mid"),
                        F.col("common.is_new").alias("is_new"), "start",
                        _size("displays").alias("n_displays"), "ts")


def log_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    err = _log_layer(spark, sf_dir)["error"]
    return err.select("event_id", F.col("common.mid").alias("mid"),
                      F.col("common.is_new").alias("is_new"), "err",
                      F.col("page.page_id").alias("page_id"), "ts")


def log_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _log_layer(spark, sf_dir)["display"]
    x = lambda name: parse.entry(F.col("display"), name)
    return d.select("event_id", x("display_type").alias("display_type"), x("item").alias("item"),
                    x("item_type").alias("item_type"), x("order").alias("display_order"),
                    x("pos_id").alias("pos_id"), "page_id", "ts")


def log_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _log_layer(spark, sf_dir)["action"]
    x = lambda name: parse.entry(F.col("action"), name)
    return a.select("event_id", x("action_id").alias("action_id"), x("item").alias("item"),
                    x("item_type").alias("item_type"), x("ts").alias("action_ts"), "page_id")


def _json_lines(kind: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return logsplit.json_outputs(_log_layer(spark, sf_dir))[kind]
    query.__doc__ = f"The {kind} output of the log split as JSON lines."
    return query


def cdc_cart(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.topic_db(Tables(spark, sf_dir))
    return cdc.cdc_slice(feed, "cart_info", schemas.CART_INFO_COLS)


def cdc_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed read from its JSON lines (S3), every slice field from real maps."""
    feed, _ = parse.parse_cdc(fx.topic_db_text(Tables(spark, sf_dir)))
    return cdc.cdc_slice(feed, "cart_info", schemas.CART_INFO_COLS, keep=("ts", "xid", "xoffset"))


def cart_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.topic_db(Tables(spark, sf_dir))
    return trade.cart_add(feed, fx.base_dic(spark))


def order_detail_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.topic_db(Tables(spark, sf_dir))
    return trade.order_detail(feed, fx.base_dic(spark))


def order_detail_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the order details while their parts arrive out of step."""
    feed = fx.scattered(fx.topic_db(Tables(spark, sf_dir)))
    return trade.order_detail_changelog(feed, fx.base_dic(spark))


def _config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.config_changes_from_events(Tables(spark, sf_dir))


def config_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.fold_changes(_config_changes(spark, sf_dir), "dim", seq=TIEBREAK)


def config_fold_dwd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.fold_changes(_config_changes(spark, sf_dir), "dwd", seq=TIEBREAK)


def config_fold_evict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.fold_changes(_config_changes(spark, sf_dir), "dim", evict_moved=True,
                               seq=TIEBREAK)


def _long(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols, F.col("data")["id"].alias("id"),
                     F.explode("data").alias("column", "value"))


def _dim_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.topic_db(Tables(spark, sf_dir))
    return dim.route(feed, config.snapshot(fx.config_snapshot(spark), "dim"))


def dim_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(_dim_routed(spark, sf_dir), "sink_table", "sink_pk", "table", "type", "ts")


def dwd_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fx.topic_db(Tables(spark, sf_dir))
    routed = dwd.route(feed, config.snapshot(fx.config_snapshot(spark), "dwd"))
    return _long(routed, "sink_table", "table", "type", "ts")


def dim_route_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 / J4 as of time: each dimension change by the rule in force when it came."""
    t = Tables(spark, sf_dir)
    rules = config.rule_versions(fx.routing_changes(t), "dim", seq=TIEBREAK)
    return _long(dim.route_asof(fx.topic_db(t), rules), "sink_table", "sink_pk", "table", "type", "ts")


def dwd_route_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R8 / J4 as of time: each fact change by the rule in force when it came."""
    t = Tables(spark, sf_dir)
    rules = config.rule_versions(fx.routing_changes(t), "dwd", seq=TIEBREAK)
    return _long(dwd.route_asof(fx.topic_db(t), rules), "sink_table", "table", "type", "ts")


def cart_lookup_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 as of time: cart additions with the dictionary as it was when they came."""
    t = Tables(spark, sf_dir)
    dic = lookup.dim_versions(fx.dic_changes(t), "dic_code", "ts_ms", ["dic_name"], F.col("deleted"), TIEBREAK)
    return trade.cart_add_asof(fx.topic_db(t), dic)


def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim.upsert_fold(_dim_routed(spark, sf_dir))


def dim_upsert_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 on one wide table whose key is not ``id``: routed cells merged into the table's rows."""
    t = Tables(spark, sf_dir)
    rules = fx.values_table(spark, [("user_info", None, "dim_user_by_name", "dim", "name,balance",
                                     "name", None)], schemas.CONFIG)
    cells = dim.upsert_fold(dim.route(fx.topic_db(t), config.snapshot(rules, "dim")))
    # rows that are there before: customers who have ordered; the others come in with the changes
    ordered = t("customer").join(t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_semi")
    current = ordered.select(
        F.col("c_name").alias("name"), F.lit("0").alias("balance"), F.col("c_mktsegment").alias("segment"))
    return dim.merge_into(current, cells, ["name", "balance", "segment"], "name")


def config_fold_preload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold over a snapshot read before the first change (here: one row per user)."""
    t = Tables(spark, sf_dir)
    key = F.concat(F.lit("src_"), F.col("c_custkey").cast("string"))
    pre = t("customer").select(
        key.alias("source_table"), F.lit("insert").alias("source_type"), F.concat(F.lit("pre_"), key).alias("sink_table"),
        F.lit("dim").alias("sink_type"), F.lit("id").alias("sink_columns"), F.lit("id").alias("sink_pk"),
        F.lit(None).cast("string").alias("sink_extend"))
    return config.fold_changes(_config_changes(spark, sf_dir), "dim", seq=TIEBREAK, preload=pre)


def topic_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the routed facts as JSON records of their topics."""
    feed = fx.topic_db(Tables(spark, sf_dir))
    records = dwd.to_topic_records(dwd.route(feed, config.snapshot(fx.config_snapshot(spark), "dwd")))
    return records.select("topic", "record_id", "value")


def cart_add_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: cart additions as JSON lines."""
    return sinks.kafka_value(cart_lookup(spark, sf_dir))


def order_detail_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: order details as keyed records of an upsert topic: the key and a few fields read back."""
    wide = order_detail_wide(spark, sf_dir)
    out = sinks.kafka_value(wide, key=["id"])
    x = lambda name: F.get_json_object("value", f"$.{name}").alias(name)
    return out.select("key", x("id"), x("order_id"), x("dic_name"), x("activity_id"), x("coupon_id"),
                      x("total_amount"))


def traffic_window_from_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain of the log split and the traffic window: raw lines, repaired pages, metrics."""
    page = _log_layer(spark, sf_dir)["page"]
    return dws.traffic_window(page, "1 hour", session_field="last_page_id", tiebreak=TIEBREAK, load_ts=False)


def ensure_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dim.schema_rows(config_fold(spark, sf_dir))
    return rows.withColumn("position", F.col("position").cast("bigint"))


def dim_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: the create-table statement of every dimension table in the folded configuration."""
    return dim.ddl(dim.schema_rows(config_fold(spark, sf_dir)))


def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir)("events").select("event_id", timefn.ntz_to_ms("ts").alias("ms"))
    return e.select(
        "event_id", "ms",
        timefn.to_date_str("ms").alias("date"),
        timefn.to_ymd_hms("ms").alias("datetime"),
        timefn.window_start_ms("ms", 10_000).alias("window_start"),
    ).select("*", timefn.to_ts("date").alias("day_start_ms"),
             timefn.to_ts("datetime", is_full=True).alias("second_ms"))


def dictionary_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    items = dws.keyword_filter(fx.page_log(t, with_item=True)).select(
        "event_id", F.col("page.item").alias("item"))
    vocab = t("part").select(F.explode(text.split_words("p_name")).alias("term"))
    hits = text.dictionary_terms(items, "item", vocab)
    return hits.select("event_id", F.col("pos").cast("bigint").alias("pos"), "term")


def queries() -> dict[str, Query]:
    return {
        "traffic_window": traffic_window,
        "traffic_window_hourly": traffic_window_hourly,
        "home_detail_window": home_detail_window,
        "home_detail_window_hourly": home_detail_window_hourly,
        "login_window": login_window,
        "login_window_hourly": login_window_hourly,
        "keyword_window": keyword_window,
        "keyword_window_hourly": keyword_window_hourly,
        "keyword_window_sql": keyword_window_sql,
        "keyword_window_text": keyword_window_text,
        "keyword_window_terms": keyword_window_terms,
        "daily_uv": daily_uv,
        "home_detail_daily": home_detail_daily,
        "home_detail_daily_per_page": home_detail_daily_per_page,
        "login_return": login_return,
        "fix_is_new": fix_is_new,
        "page_filter": page_filter,
        "login_filter": login_filter,
        "keyword_filter": keyword_filter,
        "parse_clean": parse_clean,
        "parse_dirty": parse_dirty,
        "log_page": log_page,
        "log_start": log_start,
        "log_error": log_error,
        **{f"log_{k}_json": _json_lines(k) for k in logsplit.OUTPUTS},
        "log_display": log_display,
        "log_action": log_action,
        "cdc_cart": cdc_cart,
        "cdc_parse": cdc_parse,
        "cart_lookup": cart_lookup,
        "order_detail_wide": order_detail_wide,
        "order_detail_changelog": order_detail_changelog,
        "config_fold": config_fold,
        "config_fold_dwd": config_fold_dwd,
        "config_fold_evict": config_fold_evict,
        "dim_route": dim_route,
        "dwd_route": dwd_route,
        "dim_route_asof": dim_route_asof,
        "dwd_route_asof": dwd_route_asof,
        "cart_lookup_asof": cart_lookup_asof,
        "dim_upsert": dim_upsert,
        "dim_upsert_wide": dim_upsert_wide,
        "config_fold_preload": config_fold_preload,
        "topic_records": topic_records,
        "cart_add_json": cart_add_json,
        "order_detail_upsert": order_detail_upsert,
        "traffic_window_from_log": traffic_window_from_log,
        "ensure_schema": ensure_schema,
        "dim_ddl": dim_ddl,
        "time_functions": time_functions,
        "dictionary_terms": dictionary_terms,
    }
