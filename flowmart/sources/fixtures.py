"""Mapping of the driver's TPC-H-like tables onto the warehouse's inputs.

The reference reads Kafka topics that are not available here; these functions
derive equivalent records from the given tables with column expressions only,
so every derived input grows with the tables.  The same mapping is written in
SQL in :mod:`flowmart.plans.oracle`.

Page log (from ``events``): mid = uid = user_id; k = props.$.k;
page_id: view -> home, click -> good_detail, signup -> login, else event_type;
last_page_id by k % 4: null, login, search, home; is_new '1' when k is even;
vc = 'v' || k % 3; ch = event_type; ar = 'a' || user_id % 5;
during_time = round(value * 100); item = name of part p_partkey = event_id mod
(number of parts); item_type = 'keyword'; ts = event time in epoch ms (UTC).

Change feed (from ``orders`` / ``lineitem`` / ``customer`` / ``part`` /
``supplier``): order_info = orders; order_detail = lineitem; activity = lineitem
with l_discount >= 0.05; coupon = lineitem with l_tax = 0; cart = lineitem;
source_type = l_returnflag.  Amounts are decimal(18,2) text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart import schemas
from flowmart.functions.timefn import ntz_to_ms
from flowmart.operators.cdc import DATABASE
from flowmart.operators.parse import bind
from flowmart.sources.catalog import Tables

DATETIME = "yyyy-MM-dd HH:mm:ss"


def _s(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


# --------------------------------------------------------------------------- page log
PAGE_LOG_SQL = [
    "CAST(user_id AS STRING) AS mid",
    "CAST(user_id AS STRING) AS uid",
    "CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new",
    "concat('v', CAST(k % 3 AS STRING)) AS vc",
    "event_type AS ch",
    "concat('a', CAST(user_id % 5 AS STRING)) AS ar",
    "CASE WHEN event_type = 'view' THEN 'home' WHEN event_type = 'click' THEN 'good_detail' "
    "WHEN event_type = 'signup' THEN 'login' ELSE event_type END AS page_id",
    "CASE WHEN k % 4 = 1 THEN 'login' WHEN k % 4 = 2 THEN 'search' "
    "WHEN k % 4 = 3 THEN 'home' END AS last_page_id",
    "'keyword' AS item_type",
    "CAST(round(value * 100) AS BIGINT) AS during_time",
    "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS ts",
]


def page_log_columns(events: DataFrame, keep_k: bool = False) -> DataFrame:
    """Flat page-log columns from ``events`` (one page record per event)."""
    raw = events.selectExpr("event_id", "ts", "user_id", "event_type", "value",
                            "CAST(get_json_object(props, '$.k') AS BIGINT) AS k")
    if keep_k:
        raw = bind(raw, k=F.col("k"))
    return raw.selectExpr("event_id", *(["k"] if keep_k else []), *PAGE_LOG_SQL)


def _with_item(t: Tables, flat: DataFrame) -> DataFrame:
    part = t("part")
    n_part = part.agg(F.count(F.lit(1))).scalar()
    names = part.select(F.col("p_partkey"), F.col("p_name").alias("item"))
    keyed = flat.withColumn("_pk", F.pmod(F.col("event_id"), n_part))
    # one part row per key: an equi-join on a key spread evenly over all parts
    return keyed.join(names, keyed["_pk"] == names["p_partkey"], "left").drop("_pk", "p_partkey")


def to_log_record(flat: DataFrame) -> DataFrame:
    """Pack flat page-log columns into the nested log record shape."""
    has_item = "item" in flat.columns
    return flat.select(
        "event_id",
        F.struct(*[F.col(c) for c in ("mid", "uid", "is_new", "vc", "ch", "ar")]).alias("common"),
        F.struct(
            F.col("page_id"), F.col("last_page_id"),
            (F.col("item") if has_item else F.lit(None).cast("string")).alias("item"),
            F.col("item_type"), F.col("during_time"),
            F.lit(None).cast("string").alias("last_page"),
        ).alias("page"),
        F.col("ts"),
    )


def page_log(t: Tables, with_item: bool = False) -> DataFrame:
    """Page log (``dwd_traffic_page_log``) as nested records plus ``event_id``."""
    flat = page_log_columns(t("events"))
    if with_item:
        flat = _with_item(t, flat)
    return to_log_record(flat)


def text_log(t: Tables) -> DataFrame:
    """Search records whose keyword text is a whole document: one per second, from
    ``documents``."""
    return t("documents").select(
        F.col("doc_id").alias("event_id"),
        F.struct(F.lit("search").alias("last_page_id"), F.col("text").alias("item"),
                 F.lit("keyword").alias("item_type")).alias("page"),
        (F.lit(1_704_067_200_000) + F.col("doc_id") * 1000).alias("ts"))


# --------------------------------------------------------------------------- ODS log text
def _sql_list(n: str, element, max_n: int) -> str:
    """``[e(0),...,e(n-1)]`` for 0 < n <= max_n, else null (the key is left out)."""
    branches = " ".join(
        f"WHEN {n} = {size} THEN concat('[', concat_ws(',', "
        + ", ".join(element(i) for i in range(size)) + "), ']')"
        for size in range(1, max_n + 1))
    return f"CASE {branches} END"


def _display(i: int) -> str:
    return ("concat('{\"display_type\":\"query\",\"item\":\"', "
            f"CAST(event_id * 10 + {i} AS STRING), "
            "'\",\"item_type\":\"sku_id\",\"order\":\"', "
            f"CAST({i} + 1 AS STRING), '\",\"pos_id\":\"', CAST((k + {i}) % 5 AS STRING), "
            "'\"}')")


def _action(i: int) -> str:
    return ("concat('{\"action_id\":\"favor_add\",\"item\":\"', CAST(event_id AS STRING), "
            f"'\",\"item_type\":\"sku_id\",\"ts\":', CAST(ts + 500 + {i} AS STRING), '}}')")


ODS_PARTS_SQL = [
    "event_id", "k", "ch", "ts",
    "concat('{\"ar\":\"', ar, '\",\"ch\":\"', ch, '\",\"is_new\":\"', is_new, "
    "'\",\"md\":\"phone ', CAST(k % 2 AS STRING), '\",\"mid\":\"', mid, '\",\"uid\":', "
    "CASE WHEN event_id % 11 = 4 THEN 'null' ELSE concat('\"', uid, '\"') END, "
    "',\"vc\":\"', vc, '\"}') AS common_txt",
    "concat_ws('', '{\"during_time\":', CASE WHEN event_id % 7 = 3 "
    "THEN concat('\"', CAST(during_time AS STRING), '\"') ELSE CAST(during_time AS STRING) END, "
    "',\"item_type\":\"keyword\"', "
    "CASE WHEN last_page_id IS NOT NULL THEN concat(',\"last_page_id\":\"', last_page_id, '\"') END, "
    "',\"page_id\":\"', page_id, '\",\"source_type\":\"s', CAST(k % 3 AS STRING), '\"}') AS page_txt",
    "concat('{\"entry\":\"icon\",\"loading_time\":', CAST(k * 10 AS STRING), '}') AS start_txt",
    "concat('{\"error_code\":', CAST(k AS STRING), ',\"msg\":\"e', CAST(k AS STRING), '\"}') AS err_txt",
    f"{_sql_list('k % 3', _display, 2)} AS disp_txt",
    f"{_sql_list('k % 2', _action, 1)} AS act_txt",
]

ODS_LINE_SQL = (
    "concat_ws('', '{\"app\":{\"n\":', CAST(k AS STRING), ',\"v\":[1,\"2\"]},\"common\":', common_txt, "
    "CASE WHEN ch <> 'signup' THEN concat(',\"page\":', page_txt) END, "
    "CASE WHEN ch = 'signup' THEN concat(',\"start\":', start_txt) END, "
    "CASE WHEN disp_txt IS NOT NULL THEN concat(',\"displays\":', disp_txt) END, "
    "CASE WHEN ch <> 'signup' AND act_txt IS NOT NULL THEN concat(',\"actions\":', act_txt) END, "
    "CASE WHEN ch = 'error' THEN concat(',\"err\":', err_txt) END, "
    "CASE WHEN event_id % 50 = 23 THEN '' WHEN event_id % 7 = 5 "
    "THEN concat(',\"ts\":\"', CAST(ts AS STRING), '\"') ELSE concat(',\"ts\":', CAST(ts AS STRING)) END, '}')")


def ods_log_text(t: Tables) -> DataFrame:
    """Raw behaviour-log lines (``topic_log``): ``event_id``, ``value``.

    signup events are start records, all others page records; error events
    carry ``err``; every record has k % 3 displays, page records k % 2 actions.
    Every tenth line (by event id) is cut short, others have text after the
    record or no time: dirty lines.  Some numbers are quoted, some uids null, and
    every record has fields that no schema lists.
    Written as SQL expressions (plain CASE branches stay in codegen); the fields that many of them
    read are bound once.
    """
    flat = page_log_columns(t("events"), keep_k=True)
    return (bind(flat, **{c: F.col(c) for c in flat.columns})
            .selectExpr(*ODS_PARTS_SQL)
            .selectExpr("event_id", f"{ODS_LINE_SQL} AS line")
            .selectExpr("event_id", "CASE WHEN event_id % 10 = 0 THEN substring(line, 1, length(line) - 1) "
                        "WHEN event_id % 50 = 21 THEN concat(line, ' tail') "
                        "WHEN event_id % 50 = 22 THEN concat(line, ']') "
                        "ELSE line END AS value"))


# --------------------------------------------------------------------------- change feed


def _amount(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def _change(table: str, ts: Column, data: Column, type_: Column | str = "insert",
            xid: int = 0) -> list[Column]:
    return [F.lit(DATABASE).alias("database"), F.lit(table).alias("table"),
            (F.lit(type_) if isinstance(type_, str) else type_).alias("type"),
            ts.alias("ts"), F.lit(xid).cast("bigint").alias("xid"),
            F.lit(0).cast("bigint").alias("xoffset"), data.alias("data"),
            F.lit(None).cast(schemas.STR_MAP).alias("old")]


def _kv(**cols: Column) -> Column:
    """A ``map<string,string>`` record, as a parsed change would carry.

    With literal keys Catalyst folds ``data['k']`` of this map down to the one
    value expression, so a slice computes only the columns it reads."""
    args = []
    for k, v in cols.items():
        args += [F.lit(k), v.cast("string")]
    return F.create_map(*args)






# The order and lineitem changes are written as SQL expressions: one
# ``selectExpr`` per branch keeps building the plan cheap on the driver.
DETAIL_ID = ("concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), "
             "CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), "
             "date_format(l_shipdate, 'yyyyMMdd'))")
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
SQL_DATETIME = f"'{DATETIME}'"


def _sql_secs(col: str) -> str:
    return ("CAST(floor(timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
            f"{col}) / 1000) AS BIGINT)")


def _sql_amount(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS STRING)"


def _sql_map(**cols: str) -> str:
    return "map(" + ", ".join(f"'{k}', CAST({v} AS STRING)" for k, v in cols.items()) + ")"


def _sql_change(table: str, ts: str, data: str, type_: str = "insert") -> list[str]:
    return [f"'{DATABASE}' AS database", f"'{table}' AS `table`", f"'{type_}' AS type",
            f"{ts} AS ts", "CAST(0 AS BIGINT) AS xid", "CAST(0 AS BIGINT) AS xoffset", f"{data} AS data", "CAST(NULL AS MAP<STRING,STRING>) AS old"]


def order_info_changes(t: Tables) -> DataFrame:
    o = t("orders")
    insert = o.selectExpr(*_sql_change("order_info", _sql_secs("o_orderdate"), _sql_map(
        id="o_orderkey",
        consignee="concat('consignee_', CAST(o_custkey AS STRING))",
        total_amount=_sql_amount("o_totalprice"),
        order_status="o_orderstatus",
        user_id="o_custkey",
        payment_way="'1101'",
        order_comment="o_orderpriority",
        out_trade_no="concat('otn', CAST(o_orderkey AS STRING))",
        create_time=f"date_format(o_orderdate, {SQL_DATETIME})",
        original_total_amount=_sql_amount("o_totalprice"),
        activity_reduce_amount="'0.00'",
        coupon_reduce_amount="'0.00'",
        feight_fee="'5.00'",
    )))
    # finished orders also carry a status update (a non-insert change)
    update = o.where("o_orderstatus = 'F'").selectExpr(*_sql_change(
        "order_info", _sql_secs("o_orderdate") + " + 86400", _sql_map(
            id="o_orderkey", order_status="'1004'",
            operate_time=f"date_format(o_orderdate + INTERVAL 1 DAY, {SQL_DATETIME})"),
        "update"))
    return insert.unionByName(update)


def _lineitem_changes(li: DataFrame, table: str, data: str) -> DataFrame:
    return li.selectExpr(*_sql_change(table, _sql_secs("l_shipdate"), data))


def order_detail_changes(t: Tables) -> DataFrame:
    return _lineitem_changes(t("lineitem"), "order_detail", _sql_map(
        id=DETAIL_ID, order_id="l_orderkey", sku_id="l_partkey",
        sku_name="concat('sku_', CAST(l_partkey AS STRING))",
        order_price=_sql_amount(PRICE),
        sku_num="CAST(l_quantity AS BIGINT)",
        create_time=f"date_format(l_shipdate, {SQL_DATETIME})",
        source_type="l_returnflag", source_id="l_suppkey",
        split_total_amount=_sql_amount(f"{PRICE} * (1 - CAST(l_discount AS DECIMAL(18,2)))"),
        split_activity_amount=_sql_amount(f"{PRICE} * CAST(l_discount AS DECIMAL(18,2))"),
        split_coupon_amount=_sql_amount(f"{PRICE} * CAST(l_tax AS DECIMAL(18,2))"),
    ))


def order_activity_changes(t: Tables) -> DataFrame:
    li = t("lineitem").where("l_discount >= 0.05")
    return _lineitem_changes(li, "order_detail_activity", _sql_map(
        id=f"concat('act-', {DETAIL_ID})", order_id="l_orderkey", order_detail_id=DETAIL_ID,
        activity_id="l_linestatus", activity_rule_id="l_linenumber",
        sku_id="l_partkey", create_time=f"date_format(l_shipdate, {SQL_DATETIME})"))


def order_coupon_changes(t: Tables) -> DataFrame:
    li = t("lineitem").where("l_tax = 0")
    return _lineitem_changes(li, "order_detail_coupon", _sql_map(
        id=f"concat('cpn-', {DETAIL_ID})", order_id="l_orderkey", order_detail_id=DETAIL_ID,
        coupon_id="l_suppkey", coupon_use_id=f"concat('cu-', {DETAIL_ID})",
        sku_id="l_partkey", create_time=f"date_format(l_shipdate, {SQL_DATETIME})"))


def cart_changes(t: Tables) -> DataFrame:
    return _lineitem_changes(t("lineitem"), "cart_info", _sql_map(
        id=f"concat('cart-', {DETAIL_ID})", user_id="l_suppkey",
        sku_id="l_partkey", cart_price=_sql_amount(PRICE),
        sku_num="CAST(l_quantity AS BIGINT)",
        sku_name="concat('sku_', CAST(l_partkey AS STRING))",
        is_checked="'1'", create_time=f"date_format(l_shipdate, {SQL_DATETIME})",
        is_ordered="'0'", source_type="l_returnflag", source_id="l_linenumber"))


def dimension_changes(t: Tables) -> DataFrame:
    """Changes of dimension source tables (user_info, sku_info, base_trademark,
    base_province, base_region) with insert, update, bootstrap-insert and
    delete types.  Updates name only the columns they change."""
    t0 = F.lit(1_700_000_000).cast("bigint")

    def users() -> list[DataFrame]:
        c = t("customer")
        boot = c.select(*_change("user_info", t0, _kv(
            id=F.col("c_custkey"), name=F.col("c_name"), nation_id=F.col("c_nationkey"),
            balance=_amount(F.col("c_acctbal")), segment=F.col("c_mktsegment"),
            phone_num=F.lit(None).cast("string")), "bootstrap-insert"))
        # two later partial updates in one second: only balance changes; id is the
        # key; the second transaction is the last, whatever its value
        low = c.where(F.col("c_acctbal") < 1000)
        upd = [low.select(*_change(
            "user_info", t0 + 100, _kv(
                id=F.col("c_custkey"), balance=_amount(F.col("c_acctbal") + more)), "update", xid))
            for xid, more in ((1, 9000), (2, 1000))]
        # deletes are never routed to a dimension
        dele = c.where(F.col("c_mktsegment") == "BUILDING").select(*_change(
            "user_info", t0 + 200, _kv(id=F.col("c_custkey")), "delete"))
        return [boot, *upd, dele]

    def skus() -> list[DataFrame]:
        p = t("part")
        return [p.select(*_change("sku_info", t0, _kv(
            id=F.col("p_partkey"), name=F.col("p_name"), brand=F.col("p_brand"),
            type=F.col("p_type"), size=F.col("p_size"),
            price=_amount(F.col("p_retailprice"))), "insert"))]

    def marks() -> list[DataFrame]:
        s = t("supplier")
        return [s.select(*_change("base_trademark", t0, _kv(
            id=F.col("s_suppkey"), tm_name=F.col("s_name"), nation_id=F.col("s_nationkey")),
            "insert"))]

    def provinces() -> list[DataFrame]:
        n = t("nation")
        return [n.select(*_change("base_province", t0, _kv(
            id=F.col("n_nationkey"), name=F.col("n_name"), region_id=F.col("n_regionkey")),
            "bootstrap-insert"))]

    def regions() -> list[DataFrame]:
        r = t("region")
        return [r.select(*_change("base_region", t0, _kv(
            id=F.col("r_regionkey"), region_name=F.col("r_name")), "insert"))]

    return reduce(DataFrame.unionByName,
                  [df for fn in (users, skus, marks, provinces, regions) for df in fn()])


def topic_db(t: Tables) -> DataFrame:
    """The change feed: changes of all tables.

    A slice's filter on ``table`` prunes the other branches at planning time
    (each branch's table is a literal).
    """
    return reduce(DataFrame.unionByName, [
        order_info_changes(t), order_detail_changes(t), order_activity_changes(t),
        order_coupon_changes(t), cart_changes(t), dimension_changes(t)])


def scattered(feed: DataFrame) -> DataFrame:
    """The feed with its order parts out of step: orders up to ten days late, activities and coupons
    from a day before to a day after their detail, by the change's own id."""
    n = F.length(F.col("data")["id"])
    late = (F.when(F.col("table") == "order_info", n % 3 * 40)
            .when(F.col("table") == "order_detail_activity", n % 3 - 1)
            .when(F.col("table") == "order_detail_coupon", (n + 1) % 3 - 1).otherwise(0))
    return feed.withColumn("ts", F.col("ts") + F.coalesce(late, F.lit(0)) * 86_400)


def topic_db_text(t: Tables) -> DataFrame:
    """The change feed as its JSON lines: ``value``."""
    record = F.struct("database", "table", "type", "ts", "xid", "xoffset", "data")
    return topic_db(t).select(F.to_json(record).alias("value"))


# --------------------------------------------------------------------------- lookups / config
# The dictionary rows used by the lookups (source types A and N;
# R is deliberately absent so the inner lookup drop is visible).
BASE_DIC_ROWS = [
    ("A", "source A", "24", "2024-01-01 00:00:00", None),
    ("N", "source N", "24", "2024-01-01 00:00:00", None),
]

# The routing configuration (table_process) used by the DIM and
# DWD routing queries.  "id,name,brand,size, price" keeps the reference's exact
# split: " price" matches no key.
CONFIG_ROWS = [
    ("user_info", None, "dim_user_info", "dim", "id,name,nation_id,balance,segment,phone_num", "id", None),
    ("sku_info", None, "dim_sku_info", "dim", "id,name,brand,size, price", None, None),
    ("base_trademark", None, "dim_base_trademark", "dim", "id,tm_name", "", " SALT_BUCKETS = 4"),
    ("base_province", None, "dim_base_province", "dim", "id,name,region_id", "id", None),
    ("cart_info", "insert", "dwd_trade_cart_add", "dwd", "id,user_id,sku_id,sku_num,source_type", "id", None),
    ("order_info", "update", "dwd_trade_order_status", "dwd", "id,order_status,operate_time", "id", None),
    ("order_detail_coupon", "insert", "dwd_tool_coupon_use", "dwd", "id,coupon_id,order_id,create_time", "id", None),
]


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_table(spark, rows, schema) -> DataFrame:
    """A small fixed table as a SQL ``VALUES`` relation: planned and run in
    the JVM (a local relation), with no Python worker behind it."""
    names = [f.name for f in schema.fields]
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST({n} AS {f.dataType.simpleString()}) AS {n}"
                     for n, f in zip(names, schema.fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({', '.join(names)})")


def base_dic(spark) -> DataFrame:
    return values_table(spark, BASE_DIC_ROWS, schemas.BASE_DIC)


def config_snapshot(spark) -> DataFrame:
    """The configuration table as rows (an initial snapshot)."""
    return values_table(spark, CONFIG_ROWS, schemas.CONFIG)


# Tables whose routing rules change in mid-feed, and the columns that rules keep.
ROUTED_TABLES = ["cart_info", "order_info", "order_detail", "order_detail_activity", "order_detail_coupon",
                 "user_info", "sku_info"]
ROUTED_COLUMNS = ["id,order_id,sku_id", "id,order_status,activity_id,coupon_id", "id, order_id,user_id"]


def feed_time(events_ts: Column | str) -> Column:
    """The month of the events stretched over the years of the change feed (ms)."""
    return F.lit(788_918_400_000) + (ntz_to_ms(events_ts) - 1_704_067_200_000) * 80


def routing_changes(t: Tables) -> DataFrame:
    """A change history of the routing rules of the feed's own tables, spread over the feed's time:
    the changes of :func:`config_changes_from_events`, with user ids mapped to tables."""
    name = lambda uid: F.element_at(F.array(*map(F.lit, ROUTED_TABLES)),
                                    (F.pmod(uid, len(ROUTED_TABLES)) + 1).cast("int"))
    return config_changes_from_events(t, name, ROUTED_COLUMNS).withColumn(
        "ts_ms", F.lit(788_918_400_000) + (F.col("ts_ms") - 1_704_067_200_000) * 80)


def dic_changes(t: Tables) -> DataFrame:
    """A change history of the dictionary's source types over the feed's time: code by k, a new name
    with each event, the row deleted by error events."""
    e = t("events").select("event_id", "ts", "event_type", _k().alias("k"))
    code = F.element_at(F.array(*map(F.lit, "ANR")), (F.col("k") % 3 + 1).cast("int"))
    return e.select("event_id", code.alias("dic_code"), (F.col("event_type") == "error").alias("deleted"),
                    F.concat(F.lit("source "), code, F.lit(" "), _s(F.col("event_id"))).alias("dic_name"),
                    feed_time("ts").alias("ts_ms"))


def config_changes_from_events(t: Tables, name: Callable[[Column], Column] | None = None,
                               columns: Sequence[str] = ("id,name,v", "id,name", "id,name, v")) -> DataFrame:
    """A configuration change feed derived from ``events`` (one change per
    event), used to exercise the fold at table scale.

    key = 'src_' || user_id (or ``name`` of it); op: error -> d, signup -> c, else u; sink_type by
    k: even -> dim, odd -> dwd; source_type by event_type; when k % 7 = 0 an
    update moves the key (before names 'src_' || (user_id + 1)).
    """
    e = t("events").select("event_id", "ts", "user_id", "event_type", _k().alias("k"))
    k, uid = F.col("k"), F.col("user_id")
    name = name or (lambda x: F.concat(F.lit("src_"), _s(x)))
    key = name(uid)
    sink_type = F.when(k % 2 == 0, "dim").otherwise("dwd")
    op = (F.when(F.col("event_type") == "error", "d")
          .when(F.col("event_type") == "signup", "c").otherwise("u"))
    source_type = F.when(F.col("event_type") == "purchase", "update").otherwise("insert")

    def config(src: Column, st: Column) -> Column:
        return F.struct(
            src.alias("source_table"), source_type.alias("source_type"),
            F.concat(F.lit("dim_"), src, F.lit("_v"), _s(k % 5)).alias("sink_table"),
            st.alias("sink_type"),
            F.when(k % 3 == 0, columns[0]).when(k % 3 == 1, columns[1])
            .otherwise(columns[2]).alias("sink_columns"),
            F.when(k % 4 == 0, None).when(k % 4 == 1, "").otherwise("id").alias("sink_pk"),
            F.lit(None).cast("string").alias("sink_extend"),
        )

    moved = (k % 7 == 0) & (F.col("op") == "u")
    before_key = F.when(moved, name(uid + 1)).otherwise(key)
    return (
        e.withColumn("op", op)
        .select(
            "event_id",
            F.when(F.col("op") == "c", F.lit(None).cast(schemas.CONFIG))
            .otherwise(config(before_key, sink_type)).alias("before"),
            F.when(F.col("op") == "d", F.lit(None).cast(schemas.CONFIG))
            .otherwise(config(key, sink_type)).alias("after"),
            "op",
            ntz_to_ms("ts").alias("ts_ms"),
        )
    )
