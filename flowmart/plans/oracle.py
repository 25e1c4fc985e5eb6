"""DuckDB SQL equal to each registered query (the correctness oracle).

The page-log and change-feed mappings of :mod:`flowmart.sources.fixtures`
are restated here in SQL.  Asia/Shanghai has a fixed +8 h offset for the
dates in the tables, so local time is ``epoch_ms(ms) + INTERVAL 8 HOUR``.
"""

from __future__ import annotations

LOCAL = "INTERVAL 8 HOUR"


def _local(ms: str, fmt: str) -> str:
    return f"strftime(epoch_ms({ms}) + {LOCAL}, '{fmt}')"


def _date(ms: str) -> str:
    return _local(ms, "%Y-%m-%d")


def _dt(ms: str) -> str:
    return _local(ms, "%Y-%m-%d %H:%M:%S")


PAGE_LOG = f"""
ev AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS ms,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events
),
pl AS (
  SELECT event_id, k,
    CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
    CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS is_new,
    'v' || CAST(k % 3 AS VARCHAR) AS vc,
    event_type AS ch,
    'a' || CAST(user_id % 5 AS VARCHAR) AS ar,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail'
                    WHEN 'signup' THEN 'login' ELSE event_type END AS page_id,
    CASE k % 4 WHEN 1 THEN 'login' WHEN 2 THEN 'search' WHEN 3 THEN 'home' END AS last_page_id,
    CAST(round(value * 100) AS BIGINT) AS during_time,
    ms AS ts,
    {_date('ms')} AS d
  FROM ev
)"""

PAGE_LOG_ITEM = PAGE_LOG + """,
pli AS (
  SELECT pl.*, p.p_name AS item
  FROM pl LEFT JOIN part p ON p.p_partkey = pl.event_id % (SELECT count(*) FROM part)
)"""


def _window(size_ms: int, bounds: str = "datetime") -> tuple[str, str]:
    f = _dt if bounds == "datetime" else _date
    return f("w"), f(f"w + {size_ms}")


def traffic_window(size_ms: int, session_field: str = "last_page") -> str:
    stt, edt = _window(size_ms)
    sv = ("CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END" if session_field == "last_page_id"
          else "1")
    return f"""
WITH {PAGE_LOG},
flagged AS (
  SELECT *, CASE WHEN lag(d) OVER (PARTITION BY mid ORDER BY ts, event_id) IS DISTINCT FROM d
                 THEN 1 ELSE 0 END AS uv,
         {sv} AS sv,
         ts - (ts % {size_ms}) AS w
  FROM pl
)
SELECT {stt} AS stt, {edt} AS edt, vc, ch, ar, is_new AS isNew,
       CAST(sum(uv) AS BIGINT) AS uvCt, CAST(sum(sv) AS BIGINT) AS svCt,
       CAST(count(*) AS BIGINT) AS pvCt, CAST(sum(during_time) AS BIGINT) AS durSum
FROM flagged
GROUP BY w, vc, ch, ar, is_new
"""


def _firsts(src: str, keys: str) -> str:
    return f"""(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, d
                ORDER BY ts, event_id) AS rn FROM {src}) WHERE rn = 1)"""


HOME_DETAIL = "pl WHERE page_id IN ('home', 'good_detail')"
LOGIN = "pl WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')"


def home_detail_daily(per_page: bool) -> str:
    keys = "mid, page_id" if per_page else "mid"
    return f"""
WITH {PAGE_LOG}, hd AS (SELECT * FROM {HOME_DETAIL})
SELECT mid, page_id, ts, event_id,
       CAST(page_id = 'home' AS BIGINT) AS homeUv,
       CAST(page_id <> 'home' AS BIGINT) AS detailUv
FROM {_firsts('hd', keys)}
"""


def home_detail_window(size_ms: int, bounds: str) -> str:
    stt, edt = _window(size_ms, bounds)
    return f"""
WITH {PAGE_LOG}, hd AS (SELECT * FROM {HOME_DETAIL}),
f AS (SELECT *, ts - (ts % {size_ms}) AS w FROM {_firsts('hd', 'mid')})
SELECT {stt} AS stt, {edt} AS edt,
       CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS homeUvCt,
       CAST(sum(CASE WHEN page_id <> 'home' THEN 1 ELSE 0 END) AS BIGINT) AS goodDetailUvCt
FROM f GROUP BY w
"""


LOGIN_FIRSTS = f"""
lg AS (SELECT * FROM {LOGIN}),
lf AS (SELECT uid, d, ts, event_id, lag(d) OVER (PARTITION BY uid ORDER BY d) AS prev
       FROM {_firsts('lg', 'uid')}),
lr AS (SELECT uid, d AS day, ts, event_id, CAST(1 AS BIGINT) AS uu,
              CAST(CASE WHEN prev IS NOT NULL AND
                   (ts - (epoch_ms(CAST(prev AS TIMESTAMP)) - 8 * 3600 * 1000)) // 86400000 > 7
                   THEN 1 ELSE 0 END AS BIGINT) AS back
       FROM lf)"""


def login_return() -> str:
    return f"WITH {PAGE_LOG}, {LOGIN_FIRSTS} SELECT * FROM lr"


def login_window(size_ms: int, bounds: str) -> str:
    stt, edt = _window(size_ms, bounds)
    return f"""
WITH {PAGE_LOG}, {LOGIN_FIRSTS}, f AS (SELECT *, ts - (ts % {size_ms}) AS w FROM lr)
SELECT {stt} AS stt, {edt} AS edt, CAST(sum(back) AS BIGINT) AS backCt,
       CAST(sum(uu) AS BIGINT) AS uuCt
FROM f GROUP BY w
"""


KEYWORD_ROWS = "pli WHERE last_page_id = 'search' AND item IS NOT NULL"


def keyword_window(size_ms: int) -> str:
    stt, edt = _window(size_ms)
    return f"""
WITH {PAGE_LOG_ITEM},
kw AS (SELECT ts - (ts % {size_ms}) AS w,
              unnest(regexp_extract_all(lower(item), '[\\p{{L}}\\p{{N}}]+')) AS keyword
       FROM {KEYWORD_ROWS})
SELECT {stt} AS stt, {edt} AS edt, keyword, CAST(count(*) AS BIGINT) AS keyword_count
FROM kw GROUP BY w, keyword
"""


# One document a second as search text.
KEYWORD_TEXT = f"""
WITH kw AS (SELECT (1704067200000 + doc_id * 1000) - (1704067200000 + doc_id * 1000) % 60000 AS w,
                   unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS keyword
            FROM documents WHERE text IS NOT NULL)
SELECT {_dt('w')} AS stt, {_dt('w + 60000')} AS edt, keyword, CAST(count(*) AS BIGINT) AS keyword_count
FROM kw GROUP BY w, keyword
"""

DAILY_UV = f"""
WITH {PAGE_LOG}
SELECT event_id, mid, ts,
       CAST(CASE WHEN lag(d) OVER (PARTITION BY mid ORDER BY ts, event_id) IS DISTINCT FROM d
                 THEN 1 ELSE 0 END AS BIGINT) AS uv
FROM pl
"""

FIX_IS_NEW = f"""
WITH {PAGE_LOG},
s AS (SELECT *, CASE WHEN first_value(is_new) OVER w = '1' THEN first_value(d) OVER w
                     ELSE '1970-01-01' END AS state
      FROM pl WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id))
SELECT event_id, mid, ts, is_new AS raw_is_new,
       CASE WHEN is_new = '1' AND d <> state THEN '0' ELSE is_new END AS is_new
FROM s
"""


def _filtered(where: str) -> str:
    return f"WITH {PAGE_LOG} SELECT event_id, mid, page_id, last_page_id, ts FROM pl WHERE {where}"


# ODS log lines, built exactly as flowmart.sources.fixtures.ods_log_text does.
ODS = PAGE_LOG + """,
ods_parts AS (
  SELECT pl.*,
    CASE WHEN event_id % 11 = 4 THEN NULL ELSE uid END AS log_uid,
    concat('{"ar":"', ar, '","ch":"', ch, '","is_new":"') AS common_a,
    concat('","md":"phone ', k % 2, '","mid":"', mid, '"') AS common_b,
    concat(',"vc":"', vc, '"}') AS common_z,
    concat(common_a, is_new, common_b, ',"uid":', CASE WHEN event_id % 11 = 4 THEN 'null' ELSE
           concat('"', uid, '"') END, common_z) AS common_txt,
    concat('{"during_time":', CASE WHEN event_id % 7 = 3 THEN concat('"', during_time, '"')
           ELSE CAST(during_time AS VARCHAR) END, ',"item_type":"keyword"',
           CASE WHEN last_page_id IS NOT NULL THEN concat(',"last_page_id":"', last_page_id, '"') END,
           ',"page_id":"', page_id, '","source_type":"s', k % 3, '"}') AS page_txt,
    concat('"app":{"n":', k, ',"v":[1,"2"]}') AS app_txt,
    CASE WHEN event_id % 50 = 23 THEN '' WHEN event_id % 7 = 5 THEN concat(',"ts":"', ts, '"')
         ELSE concat(',"ts":', ts) END AS ts_txt,
    concat('{"entry":"icon","loading_time":', k * 10, '}') AS start_txt,
    concat('{"error_code":', k, ',"msg":"e', k, '"}') AS err_txt,
    CASE WHEN k % 3 > 0 THEN concat('[', array_to_string(list_transform(range(k % 3), lambda i:
      concat('{"display_type":"query","item":"', event_id * 10 + i,
             '","item_type":"sku_id","order":"', i + 1, '","pos_id":"', (k + i) % 5, '"}')), ','),
      ']') END AS disp_txt,
    CASE WHEN k % 2 > 0 THEN concat('[', array_to_string(list_transform(range(k % 2), lambda i:
      concat('{"action_id":"favor_add","item":"', event_id, '","item_type":"sku_id","ts":',
             ts + 500 + i, '}')), ','), ']') END AS act_txt
  FROM pl
),
ods AS (
  SELECT *, concat('{', app_txt, ',"common":', common_txt,
      CASE WHEN ch <> 'signup' THEN concat(',"page":', page_txt) END,
      CASE WHEN ch = 'signup' THEN concat(',"start":', start_txt) END,
      CASE WHEN disp_txt IS NOT NULL THEN concat(',"displays":', disp_txt) END,
      CASE WHEN ch <> 'signup' AND act_txt IS NOT NULL THEN concat(',"actions":', act_txt) END,
      CASE WHEN ch = 'error' THEN concat(',"err":', err_txt) END,
      ts_txt, '}') AS line,
    event_id % 10 = 0 OR event_id % 50 IN (21, 22, 23) AS dirty
  FROM ods_parts
),
clean AS (SELECT * FROM ods WHERE NOT dirty),
fixed AS (
  SELECT *, CASE WHEN is_new = '1' AND d <> (CASE WHEN first_value(is_new) OVER w = '1'
                 THEN first_value(d) OVER w ELSE '1970-01-01' END) THEN '0' ELSE is_new END
            AS is_new_fixed,
    concat(common_a, is_new_fixed, common_b, CASE WHEN log_uid IS NOT NULL THEN
           concat(',"uid":"', uid, '"') END, common_z) AS common_fixed
  FROM clean WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id)
)"""

PARSE_CLEAN = f"""
WITH {ODS}
SELECT event_id, mid, is_new,
       CASE WHEN ch <> 'signup' THEN page_id END AS page_id,
       CASE WHEN ch <> 'signup' THEN last_page_id END AS last_page_id,
       CASE WHEN ch <> 'signup' THEN during_time END AS during_time,
       CASE WHEN ch = 'signup' THEN start_txt END AS start,
       CASE WHEN ch = 'error' THEN err_txt END AS err,
       ts,
       CASE WHEN k % 3 > 0 THEN k % 3 END AS n_displays,
       CASE WHEN ch <> 'signup' AND k % 2 > 0 THEN k % 2 END AS n_actions
FROM clean
"""

PARSE_DIRTY = f"""
WITH {ODS}
SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substring(line, 1, length(line) - 1)
         WHEN event_id % 50 = 21 THEN concat(line, ' tail') WHEN event_id % 50 = 22 THEN concat(line, ']')
         ELSE line END AS value
FROM ods WHERE dirty
"""

LOG_PAGE = f"""
WITH {ODS}
SELECT event_id, mid, log_uid AS uid, is_new_fixed AS is_new, vc, ch, ar, page_id, last_page_id,
       during_time, ts
FROM fixed WHERE ch <> 'signup'
"""

# Whole records as JSON text, keys in order.
LOG_PAGE_JSON = f"""
WITH {ODS}
SELECT event_id, concat('{{', app_txt, ',"common":', common_fixed, ',"page":', page_txt, ts_txt, '}}') AS value
FROM fixed WHERE ch <> 'signup'
"""

LOG_START_JSON = f"""
WITH {ODS}
SELECT event_id, concat('{{', app_txt, ',"common":', common_fixed,
    CASE WHEN disp_txt IS NOT NULL THEN concat(',"displays":', disp_txt) END, ',"start":', start_txt, ts_txt,
    '}}') AS value
FROM fixed WHERE ch = 'signup'
"""

LOG_ERROR_JSON = f"""
WITH {ODS}
SELECT event_id, concat('{{', CASE WHEN act_txt IS NOT NULL THEN concat('"actions":', act_txt, ',') END, app_txt,
    ',"common":', common_fixed, CASE WHEN disp_txt IS NOT NULL THEN concat(',"displays":', disp_txt) END,
    ',"err":', err_txt, ',"page":', page_txt, ts_txt, '}}') AS value
FROM fixed WHERE ch = 'error'
"""

LOG_DISPLAY_JSON = f"""
WITH {ODS}, p AS (SELECT *, unnest(range(k % 3)) AS i FROM fixed WHERE ch <> 'signup')
SELECT event_id, concat('{{"display_type":"query","item":"', event_id * 10 + i,
    '","item_type":"sku_id","order":"', i + 1, '","page_id":"', page_id, '","pos_id":"', (k + i) % 5,
    '","ts":', ts, '}}') AS value
FROM p
"""

LOG_ACTION_JSON = f"""
WITH {ODS}, p AS (SELECT *, unnest(range(k % 2)) AS i FROM fixed WHERE ch <> 'signup')
SELECT event_id, concat('{{"action_id":"favor_add","item":"', event_id, '","item_type":"sku_id","page_id":"',
    page_id, '","ts":', ts + 500 + i, '}}') AS value
FROM p
"""

LOG_START = f"""
WITH {ODS}
SELECT event_id, mid, is_new_fixed AS is_new, start_txt AS start,
       CASE WHEN k % 3 > 0 THEN k % 3 END AS n_displays, ts
FROM fixed WHERE ch = 'signup'
"""

LOG_ERROR = f"""
WITH {ODS}
SELECT event_id, mid, is_new_fixed AS is_new, err_txt AS err, page_id, ts
FROM fixed WHERE ch = 'error'
"""

LOG_DISPLAY = f"""
WITH {ODS}, p AS (SELECT *, unnest(range(k % 3)) AS i FROM fixed WHERE ch <> 'signup')
SELECT event_id, 'query' AS display_type, CAST(event_id * 10 + i AS VARCHAR) AS item,
       'sku_id' AS item_type, CAST(i + 1 AS VARCHAR) AS display_order,
       CAST((k + i) % 5 AS VARCHAR) AS pos_id, page_id, ts
FROM p
"""

LOG_ACTION = f"""
WITH {ODS}, p AS (SELECT *, unnest(range(k % 2)) AS i FROM fixed WHERE ch <> 'signup')
SELECT event_id, 'favor_add' AS action_id, CAST(event_id AS VARCHAR) AS item,
       'sku_id' AS item_type, CAST(ts + 500 + i AS VARCHAR) AS action_ts, page_id
FROM p
"""


def _amt(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)"


_MS = "epoch_us({}) // 1000000"
DETAIL_ID = ("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
             "strftime(l_shipdate, '%Y%m%d'))")
DT = "'%Y-%m-%d %H:%M:%S'"
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"

CART = f"""
cart AS (
  SELECT 'cart-' || {DETAIL_ID} AS id, CAST(l_suppkey AS VARCHAR) AS user_id,
         CAST(l_partkey AS VARCHAR) AS sku_id, {_amt('l_extendedprice')} AS cart_price,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num,
         'sku_' || CAST(l_partkey AS VARCHAR) AS sku_name, '1' AS is_checked,
         strftime(l_shipdate, {DT}) AS create_time, CAST(NULL AS VARCHAR) AS operate_time,
         '0' AS is_ordered, CAST(NULL AS VARCHAR) AS order_time, l_returnflag AS source_type,
         CAST(l_linenumber AS VARCHAR) AS source_id,
         epoch_us(l_shipdate) // 1000000 AS ts
  FROM lineitem
)"""

DIC = """
dic AS (SELECT * FROM (VALUES ('A', 'source A'), ('N', 'source N')) t(dic_code, dic_name))"""

CDC_CART = f"WITH {CART} SELECT * FROM cart"

CDC_PARSE = f"""
WITH {CART} SELECT *, CAST(0 AS BIGINT) AS xid, CAST(0 AS BIGINT) AS xoffset FROM cart
"""

CART_LOOKUP = f"""
WITH {CART}, {DIC}
SELECT id, user_id, sku_id, cart_price, sku_num, sku_name, is_checked, create_time,
       operate_time, is_ordered, order_time, source_type, dic_name, source_id
FROM cart JOIN dic ON cart.source_type = dic.dic_code
"""

ORDER_DETAIL_WIDE = f"""
WITH {DIC},
od AS (
  SELECT {DETAIL_ID} AS id, CAST(l_orderkey AS VARCHAR) AS order_id,
         CAST(l_partkey AS VARCHAR) AS sku_id, 'sku_' || CAST(l_partkey AS VARCHAR) AS sku_name,
         {_amt('l_extendedprice')} AS order_price,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS sku_num,
         strftime(l_shipdate, {DT}) AS create_time, l_returnflag AS source_type,
         CAST(l_suppkey AS VARCHAR) AS source_id,
         CAST(CAST({PRICE} * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS VARCHAR)
           AS split_total_amount,
         CAST(CAST({PRICE} * CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS VARCHAR)
           AS split_activity_amount,
         CAST(CAST({PRICE} * CAST(l_tax AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS VARCHAR)
           AS split_coupon_amount
  FROM lineitem
),
oi AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, 'consignee_' || CAST(o_custkey AS VARCHAR) AS consignee,
         {_amt('o_totalprice')} AS total_amount, o_orderstatus AS order_status,
         CAST(o_custkey AS VARCHAR) AS user_id, '1101' AS payment_way,
         o_orderpriority AS order_comment, 'otn' || CAST(o_orderkey AS VARCHAR) AS out_trade_no,
         '0.00' AS activity_reduce_amount, '0.00' AS coupon_reduce_amount,
         {_amt('o_totalprice')} AS original_total_amount, '5.00' AS feight_fee
  FROM orders
),
oa AS (
  SELECT {DETAIL_ID} AS order_detail_id, l_linestatus AS activity_id,
         CAST(l_linenumber AS VARCHAR) AS activity_rule_id
  FROM lineitem WHERE l_discount >= 0.05
),
oc AS (
  SELECT {DETAIL_ID} AS order_detail_id, CAST(l_suppkey AS VARCHAR) AS coupon_id,
         'cu-' || {DETAIL_ID} AS coupon_use_id
  FROM lineitem WHERE l_tax = 0
)
SELECT od.id, od.order_id, od.sku_id, od.sku_name, od.order_price, od.sku_num,
       od.create_time, od.source_type, dic.dic_name, od.source_id, od.split_total_amount,
       od.split_activity_amount, od.split_coupon_amount, oi.consignee,
       CAST(NULL AS VARCHAR) AS consignee_tel, oi.total_amount, oi.order_status, oi.user_id,
       oi.payment_way, CAST(NULL AS VARCHAR) AS delivery_address, oi.order_comment,
       oi.out_trade_no, CAST(NULL AS VARCHAR) AS trade_body,
       CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS process_status,
       CAST(NULL AS VARCHAR) AS tracking_no, CAST(NULL AS VARCHAR) AS parent_order_id,
       CAST(NULL AS VARCHAR) AS province_id, oi.activity_reduce_amount,
       oi.coupon_reduce_amount, oi.original_total_amount, oi.feight_fee,
       CAST(NULL AS VARCHAR) AS feight_fee_reduce,
       oa.activity_id, oa.activity_rule_id, oc.coupon_id, oc.coupon_use_id
FROM od
JOIN oi ON od.order_id = oi.id
LEFT JOIN oa ON od.id = oa.order_detail_id
LEFT JOIN oc ON od.id = oc.order_detail_id
JOIN dic ON od.source_type = dic.dic_code
"""


def _order_detail_changelog() -> str:
    """Versions with the arrivals that begin and end them (``s``, ``e``; an arrival is
    ts * 10 + the slice's place), then one row per beginning and end."""
    ctes, first, rest = ORDER_DETAIL_WIDE.partition("SELECT od.id")
    columns = first.removeprefix("SELECT ") + rest.partition(",\n       oa.activity_id")[0]
    shipped = _MS.format("l_shipdate")
    for old, at in [
            ("AS split_coupon_amount", f"{shipped} * 10 + 1"),
            ("AS feight_fee", f"({_MS.format('o_orderdate')} + length(CAST(o_orderkey AS VARCHAR)) % 3 * 40 * 86400) * 10"),
            ("AS activity_rule_id", f"({shipped} + ((length({DETAIL_ID}) + 4) % 3 - 1) * 86400) * 10 + 2"),
            ("AS coupon_use_id", f"({shipped} + ((length({DETAIL_ID}) + 5) % 3 - 1) * 86400) * 10 + 3")]:
        ctes = ctes.replace(f"{old}\n", f"{old}, {at} AS arr\n")
    return f"""{ctes.rstrip()},
base AS (
  SELECT {columns}, greatest(od.arr, oi.arr) AS s
  FROM od JOIN oi ON od.order_id = oi.id JOIN dic ON od.source_type = dic.dic_code),
fa AS (SELECT order_detail_id, min(arr) AS m FROM oa GROUP BY 1),
fc AS (SELECT order_detail_id, min(arr) AS m FROM oc GROUP BY 1),
one AS (
  SELECT b.* EXCLUDE (s), greatest(s, arr) AS s, NULL AS e, activity_id, activity_rule_id
  FROM base b JOIN oa ON b.id = order_detail_id
  UNION ALL
  SELECT b.* EXCLUDE (s), s, m AS e, NULL, NULL FROM base b LEFT JOIN fa ON b.id = order_detail_id
  WHERE m IS NULL OR s < m),
two AS (
  SELECT o.* EXCLUDE (s), greatest(s, arr) AS s, coupon_id, coupon_use_id FROM one o JOIN oc ON o.id = order_detail_id
  WHERE e IS NULL OR greatest(s, arr) < e
  UNION ALL
  SELECT * FROM (
    SELECT o.* EXCLUDE (s) REPLACE (least(e, m) AS e), s, NULL, NULL
    FROM one o LEFT JOIN fc ON o.id = order_detail_id) WHERE e IS NULL OR s < e),
events AS (
  SELECT * EXCLUDE (s, e), s AS arr, true AS add FROM two
  UNION ALL SELECT * EXCLUDE (s, e), e AS arr, false AS add FROM two WHERE e IS NOT NULL),
taken AS (SELECT DISTINCT id, arr FROM events WHERE NOT add)
SELECT v.* EXCLUDE (arr, add), CAST(v.arr // 10 AS BIGINT) AS ts, CAST(v.arr % 10 AS INTEGER) AS step,
  CAST(0 AS BIGINT) AS xid, CAST(0 AS BIGINT) AS xoffset,
  CASE WHEN NOT add THEN '-U' WHEN t.id IS NOT NULL THEN '+U' ELSE '+I' END AS op
FROM events v LEFT JOIN taken t ON v.id = t.id AND v.arr = t.arr
"""


# Configuration change feed derived from events (fixtures.config_changes_from_events).
CONFIG_CHANGES = PAGE_LOG + """,
chg0 AS (
  SELECT event_id, ts AS ts_ms, CAST(mid AS BIGINT) AS user_id, k,
         CASE ch WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op,
         'src_' || CAST(user_id AS VARCHAR) AS key,
         CASE WHEN k % 2 = 0 THEN 'dim' ELSE 'dwd' END AS sink_type,
         CASE WHEN ch = 'purchase' THEN 'update' ELSE 'insert' END AS source_type,
         CASE k % 3 WHEN 0 THEN 'id,name,v' WHEN 1 THEN 'id,name' ELSE 'id,name, v' END
           AS sink_columns,
         CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'id' END AS sink_pk
  FROM pl
),
chg AS (
  SELECT *, CASE WHEN k % 7 = 0 AND op = 'u' THEN 'src_' || CAST(user_id + 1 AS VARCHAR)
                 ELSE key END AS before_key
  FROM chg0
),
cfg_rows AS (
  SELECT event_id, ts_ms, op, 'before' AS side, before_key AS source_table, * EXCLUDE (event_id, ts_ms, op)
  FROM chg WHERE op <> 'c'
  UNION ALL
  SELECT event_id, ts_ms, op, 'after' AS side, key AS source_table, * EXCLUDE (event_id, ts_ms, op)
  FROM chg WHERE op <> 'd'
),
cfg AS (
  SELECT event_id, ts_ms, op, side, source_table, source_type,
         'dim_' || source_table || '_v' || CAST(k % 5 AS VARCHAR) AS sink_table,
         sink_type, sink_columns, sink_pk, CAST(NULL AS VARCHAR) AS sink_extend
  FROM cfg_rows
)"""


# A snapshot read before the first change: one row per user.
CONFIG_PRELOAD = """
pre AS (SELECT 'src_' || CAST(c_custkey AS VARCHAR) AS config_key, 'src_' || CAST(c_custkey AS VARCHAR) AS source_table,
        'insert' AS source_type, 'pre_src_' || CAST(c_custkey AS VARCHAR) AS sink_table, 'dim' AS sink_type,
        'id' AS sink_columns, 'id' AS sink_pk, CAST(NULL AS VARCHAR) AS sink_extend FROM customer),
top AS (SELECT * FROM last WHERE rn = 1)
SELECT config_key, source_table, source_type, sink_table, sink_type, sink_columns, sink_pk, sink_extend
FROM top WHERE action = 'put'
UNION ALL
SELECT * FROM pre WHERE config_key NOT IN (SELECT config_key FROM top)
"""


def config_fold_preload(layer: str) -> str:
    folded, _, _ = config_fold(layer).rpartition("\nSELECT config_key")
    return folded + "," + CONFIG_PRELOAD


def config_fold(layer: str, evict_moved: bool = False) -> str:
    key = ("source_table || '_' || source_type" if layer == "dwd" else "source_table")
    evict = ""
    if evict_moved:
        evict = f"""
  UNION ALL
  SELECT {_prefixed(key, 'b')} AS config_key, b.ts_ms, b.event_id AS seq, 'remove' AS action,
         b.*
  FROM cfg b JOIN cfg a ON a.event_id = b.event_id AND a.side = 'after'
  WHERE b.side = 'before' AND b.op <> 'd' AND b.sink_type = '{layer}'
    AND (a.sink_type <> '{layer}' OR {_prefixed(key, 'a')} <> {_prefixed(key, 'b')})"""
    return f"""
WITH {CONFIG_CHANGES},
touches AS (
  SELECT {key} AS config_key, ts_ms, event_id AS seq, 'remove' AS action, cfg.*
  FROM cfg WHERE side = 'before' AND op = 'd' AND sink_type = '{layer}'
  UNION ALL
  SELECT {key} AS config_key, ts_ms, event_id AS seq, 'put' AS action, cfg.*
  FROM cfg WHERE side = 'after' AND sink_type = '{layer}'{evict}
),
last AS (
  SELECT *, row_number() OVER (PARTITION BY config_key ORDER BY ts_ms DESC, seq DESC) AS rn
  FROM touches
)
SELECT config_key, source_table, source_type, sink_table, sink_type, sink_columns, sink_pk,
       sink_extend
FROM last WHERE rn = 1 AND action = 'put'
"""


def _prefixed(key: str, alias: str) -> str:
    return key.replace("source_table", f"{alias}.source_table").replace(
        "source_type", f"{alias}.source_type")


def _cells(select_cols: str, names: list[str], values: list[str]) -> str:
    n = ", ".join(f"'{x}'" for x in names)
    v = ", ".join(f"CAST({x} AS VARCHAR)" for x in values)
    return f'{select_cols}, unnest([{n}]) AS "column", unnest([{v}]) AS value'


DIM_SOURCES = f"""
dim_cells AS (
  SELECT {_cells("'dim_user_info' AS sink_table, 'id' AS sink_pk, 'user_info' AS \"table\", "
                 "'bootstrap-insert' AS type, CAST(1700000000 AS BIGINT) AS ts, "
                 "CAST(c_custkey AS VARCHAR) AS id, 0 AS xid",
                 ["id", "name", "nation_id", "balance", "segment", "phone_num"],
                 ["c_custkey", "c_name", "c_nationkey", "CAST(c_acctbal AS DECIMAL(18,2))",
                  "c_mktsegment", "NULL"])}
  FROM customer
  UNION ALL
  SELECT {_cells("'dim_user_info', 'id', 'user_info', 'update', CAST(1700000100 AS BIGINT), "
                 "CAST(c_custkey AS VARCHAR), 1",
                 ["id", "balance"], ["c_custkey", "CAST(c_acctbal + 9000 AS DECIMAL(18,2))"])}
  FROM customer WHERE c_acctbal < 1000
  UNION ALL
  SELECT {_cells("'dim_user_info', 'id', 'user_info', 'update', CAST(1700000100 AS BIGINT), "
                 "CAST(c_custkey AS VARCHAR), 2",
                 ["id", "balance"], ["c_custkey", "CAST(c_acctbal + 1000 AS DECIMAL(18,2))"])}
  FROM customer WHERE c_acctbal < 1000
  UNION ALL
  SELECT {_cells("'dim_sku_info', 'id', 'sku_info', 'insert', CAST(1700000000 AS BIGINT), "
                 "CAST(p_partkey AS VARCHAR), 0",
                 ["id", "name", "brand", "size"], ["p_partkey", "p_name", "p_brand", "p_size"])}
  FROM part
  UNION ALL
  SELECT {_cells("'dim_base_trademark', 'id', 'base_trademark', 'insert', "
                 "CAST(1700000000 AS BIGINT), CAST(s_suppkey AS VARCHAR), 0",
                 ["id", "tm_name"], ["s_suppkey", "s_name"])}
  FROM supplier
  UNION ALL
  SELECT {_cells("'dim_base_province', 'id', 'base_province', 'bootstrap-insert', "
                 "CAST(1700000000 AS BIGINT), CAST(n_nationkey AS VARCHAR), 0",
                 ["id", "name", "region_id"], ["n_nationkey", "n_name", "n_regionkey"])}
  FROM nation
)"""

DIM_ROUTE = f"WITH {DIM_SOURCES} SELECT * EXCLUDE (xid) FROM dim_cells"

DIM_UPSERT = f"""
WITH {DIM_SOURCES},
r AS (SELECT *, row_number() OVER (PARTITION BY sink_table, id, "column"
                                   ORDER BY ts DESC, xid DESC) AS rn
      FROM dim_cells)
SELECT sink_table, id AS pk, "column", coalesce(value, '') AS value FROM r WHERE rn = 1
"""

DWD_ROUTE = f"""
SELECT {_cells("'dwd_trade_cart_add' AS sink_table, 'cart_info' AS \"table\", 'insert' AS type, "
               "epoch_us(l_shipdate) // 1000000 AS ts, 'cart-' || " + DETAIL_ID + " AS id",
               ["id", "user_id", "sku_id", "sku_num", "source_type"],
               ["'cart-' || " + DETAIL_ID, "l_suppkey", "l_partkey", "CAST(l_quantity AS BIGINT)",
                "l_returnflag"])}
FROM lineitem
UNION ALL
SELECT {_cells("'dwd_trade_order_status', 'order_info', 'update', "
               "epoch_us(o_orderdate) // 1000000 + 86400, CAST(o_orderkey AS VARCHAR)",
               ["id", "order_status", "operate_time"],
               ["o_orderkey", "'1004'", "strftime(o_orderdate + INTERVAL 1 DAY, " + DT + ")"])}
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT {_cells("'dwd_tool_coupon_use', 'order_detail_coupon', 'insert', "
               "epoch_us(l_shipdate) // 1000000, 'cpn-' || " + DETAIL_ID,
               ["id", "coupon_id", "order_id", "create_time"],
               ["'cpn-' || " + DETAIL_ID, "l_suppkey", "l_orderkey",
                "strftime(l_shipdate, " + DT + ")"])}
FROM lineitem WHERE l_tax = 0
"""

# The rules of the feed's own tables, spread over the feed's time (fixtures.routing_changes).
_TABLES = "['cart_info','order_info','order_detail','order_detail_activity','order_detail_coupon','user_info','sku_info']"
ROUTING_CHANGES = (
    CONFIG_CHANGES.replace("'src_' || CAST(user_id AS VARCHAR)", f"{_TABLES}[user_id % 7 + 1]")
    .replace("'src_' || CAST(user_id + 1 AS VARCHAR)", f"{_TABLES}[(user_id + 1) % 7 + 1]")
    .replace("ts AS ts_ms", "788918400000 + (ts - 1704067200000) * 80 AS ts_ms")
    .replace("'id,name,v'", "'id,order_id,sku_id'").replace("'id,name, v'", "'id, order_id,user_id'")
    .replace("'id,name'", "'id,order_status,activity_id,coupon_id'"))

# The cells of all changes whose columns a rule may keep.
_FEED = [
    ("cart_info", "insert", _MS.format("l_shipdate"), f"'cart-' || {DETAIL_ID}",
     {"sku_id": "l_partkey", "user_id": "l_suppkey"}, "lineitem"),
    ("order_info", "insert", _MS.format("o_orderdate"), "o_orderkey",
     {"order_status": "o_orderstatus", "user_id": "o_custkey"}, "orders"),
    ("order_info", "update", _MS.format("o_orderdate") + " + 86400", "o_orderkey",
     {"order_status": "'1004'"}, "orders WHERE o_orderstatus = 'F'"),
    ("order_detail", "insert", _MS.format("l_shipdate"), DETAIL_ID,
     {"order_id": "l_orderkey", "sku_id": "l_partkey"}, "lineitem"),
    ("order_detail_activity", "insert", _MS.format("l_shipdate"), f"'act-' || {DETAIL_ID}",
     {"order_id": "l_orderkey", "sku_id": "l_partkey", "activity_id": "l_linestatus"},
     "lineitem WHERE l_discount >= 0.05"),
    ("order_detail_coupon", "insert", _MS.format("l_shipdate"), f"'cpn-' || {DETAIL_ID}",
     {"order_id": "l_orderkey", "sku_id": "l_partkey", "coupon_id": "l_suppkey"}, "lineitem WHERE l_tax = 0"),
    ("user_info", "bootstrap-insert", "1700000000", "c_custkey", {}, "customer"),
    ("user_info", "update", "1700000100", "c_custkey", {}, "customer WHERE c_acctbal < 1000"),
    ("user_info", "update", "1700000100", "c_custkey", {}, "customer WHERE c_acctbal < 1000"),
    ("user_info", "delete", "1700000200", "c_custkey", {}, "customer WHERE c_mktsegment = 'BUILDING'"),
    ("sku_info", "insert", "1700000000", "p_partkey", {}, "part"),
]


def _feed_rows() -> str:
    rows = []
    for table, kind, ts, key, data, source in _FEED:
        names = ["id", *data]
        values = [f"CAST({v} AS VARCHAR)" for v in (key, *data.values())]
        rows.append(f"""SELECT '{table}' AS "table", '{kind}' AS type, CAST({ts} AS BIGINT) AS ts,
  CAST({key} AS VARCHAR) AS id, {names} AS names, [{', '.join(values)}] AS vals FROM {source}""")
    return "\nUNION ALL\n".join(rows)


def route_asof(layer: str) -> str:
    touched, _, _ = config_fold(layer).replace(CONFIG_CHANGES, ROUTING_CHANGES).rpartition(",\nlast AS (")
    key, kinds, pk = {
        "dim": ('"table"', "type IN ('insert', 'update', 'bootstrap-insert')",
                "CASE WHEN v.sink_pk IS NULL OR v.sink_pk = '' THEN 'id' ELSE v.sink_pk END AS sink_pk, "),
        "dwd": ("\"table\" || '_' || type", "true", "")}[layer]
    return f"""{touched},
versions AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY config_key, ts_ms ORDER BY seq DESC) AS rn FROM touches) WHERE rn = 1),
feed AS ({_feed_rows()}),
routed AS (
  SELECT v.sink_table, {pk}f."table", f.type, f.ts, f.id, v.action, string_split(v.sink_columns, ',') AS keep,
    f.names, f.vals
  FROM (SELECT *, {key} AS k, ts * 1000 AS at FROM feed WHERE {kinds}) f
  ASOF JOIN versions v ON f.k = v.config_key AND f.at >= v.ts_ms),
cells AS (
  SELECT * EXCLUDE (names, vals), unnest(names) AS "column", unnest(vals) AS value FROM routed WHERE action = 'put')
SELECT * EXCLUDE (action, keep, id), CASE WHEN list_contains(keep, 'id') THEN id END AS id FROM cells
WHERE list_contains(keep, "column")
"""


CART_LOOKUP_ASOF = f"""
WITH {CART},
e AS (
  SELECT event_id, event_type, substr('ANR', CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 + 1 AS INT), 1)
    AS dic_code, 788918400000 + (epoch_us(ts) // 1000 - 1704067200000) * 80 AS ts_ms FROM events),
v AS (
  SELECT dic_code, ts_ms, event_type = 'error' AS deleted, 'source ' || dic_code || ' ' || event_id AS dic_name,
    row_number() OVER (PARTITION BY dic_code, ts_ms ORDER BY event_id DESC) AS rn FROM e)
SELECT id, user_id, sku_id, cart_price, sku_num, sku_name, is_checked, create_time,
       operate_time, is_ordered, order_time, source_type, dic_name, source_id
FROM (SELECT *, ts * 1000 AS at FROM cart) c
ASOF JOIN (SELECT * FROM v WHERE rn = 1) v ON c.source_type = v.dic_code AND c.at >= v.ts_ms
WHERE NOT v.deleted
"""


DIM_UPSERT_WIDE = f"""
SELECT c_name AS name, {_amt('c_acctbal')} AS balance,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN c_mktsegment END AS segment
FROM customer
"""

TOPIC_RECORDS = f"""
SELECT topic, value, sha256(concat_ws('|', topic, "table", type, ts, 0, 0, value)) AS record_id FROM (
SELECT 'dwd_trade_cart_add' AS topic, concat('{{"id":"cart-', {DETAIL_ID}, '","user_id":"', l_suppkey,
    '","sku_id":"', l_partkey, '","sku_num":"', CAST(l_quantity AS BIGINT), '","source_type":"', l_returnflag,
    '"}}') AS value, 'cart_info' AS "table", 'insert' AS type, {_MS.format("l_shipdate")} AS ts
FROM lineitem
UNION ALL
SELECT 'dwd_trade_order_status', concat('{{"id":"', o_orderkey, '","order_status":"1004","operate_time":"',
    strftime(o_orderdate + INTERVAL 1 DAY, {DT}), '"}}'),
    'order_info', 'update', {_MS.format("o_orderdate")} + 86400
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT 'dwd_tool_coupon_use', concat('{{"id":"cpn-', {DETAIL_ID}, '","order_id":"', l_orderkey,
    '","coupon_id":"', l_suppkey, '","create_time":"', strftime(l_shipdate, {DT}), '"}}'),
    'order_detail_coupon', 'insert', {_MS.format("l_shipdate")}
FROM lineitem WHERE l_tax = 0)
"""

CART_ADD_JSON = f"""
WITH {CART}, {DIC}
SELECT concat('{{"id":"', id, '","user_id":"', user_id, '","sku_id":"', sku_id, '","cart_price":"', cart_price,
    '","sku_num":"', sku_num, '","sku_name":"', sku_name, '","is_checked":"', is_checked, '","create_time":"',
    create_time, '","is_ordered":"', is_ordered, '","source_type":"', source_type, '","dic_name":"', dic_name,
    '","source_id":"', source_id, '"}}') AS value
FROM cart JOIN dic ON cart.source_type = dic.dic_code
"""

ORDER_DETAIL_UPSERT = f"""
SELECT concat('{{"id":"', id, '"}}') AS key, id, order_id, dic_name, activity_id, coupon_id, total_amount
FROM ({ORDER_DETAIL_WIDE})
"""

TRAFFIC_WINDOW_FROM_LOG = f"""
WITH {ODS},
pages AS (
  SELECT *, CASE WHEN lag(d) OVER (PARTITION BY mid ORDER BY ts, event_id) IS DISTINCT FROM d THEN 1 ELSE 0 END AS uv,
         ts - (ts % 3600000) AS w
  FROM fixed WHERE ch <> 'signup')
SELECT {_dt('w')} AS stt, {_dt('w + 3600000')} AS edt, vc, ch, ar, is_new_fixed AS isNew,
       CAST(sum(uv) AS BIGINT) AS uvCt, CAST(sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS svCt,
       CAST(count(*) AS BIGINT) AS pvCt, CAST(sum(during_time) AS BIGINT) AS durSum
FROM pages GROUP BY w, vc, ch, ar, is_new_fixed
"""

ENSURE_SCHEMA = f"""
WITH folded AS ({config_fold('dim')}),
s AS (
  SELECT sink_table,
         CASE WHEN sink_pk IS NULL OR sink_pk = '' THEN 'id' ELSE sink_pk END AS pk,
         coalesce(sink_extend, '') AS sink_extend,
         string_split(sink_columns, ',') AS cols
  FROM folded
),
u AS (SELECT sink_table, pk, sink_extend, unnest(cols) AS column_name,
             unnest(range(1, len(cols) + 1)) AS position FROM s)
SELECT 'REALTIME_DIM' AS schema_name, sink_table, CAST(position AS BIGINT) AS position,
       column_name, 'varchar' AS column_type, column_name = pk AS is_pk, sink_extend
FROM u
"""

DIM_DDL = f"""
SELECT sink_table, 'create table if not exists ' || schema_name || '.' || sink_table || ' (' || string_agg(
    column_name || ' varchar' || CASE WHEN is_pk THEN ' primary key' ELSE '' END, ', ' ORDER BY position)
  || ') ' || sink_extend AS ddl
FROM ({ENSURE_SCHEMA}) GROUP BY schema_name, sink_table, sink_extend
"""

TIME_FUNCTIONS = f"""
WITH e AS (SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events),
f AS (SELECT event_id, ms, {_date('ms')} AS date, {_dt('ms')} AS datetime,
             ms - ms % 10000 AS window_start FROM e)
SELECT *, epoch_us(CAST(date AS TIMESTAMP)) // 1000 - 28800000 AS day_start_ms,
          epoch_us(CAST(datetime AS TIMESTAMP)) // 1000 - 28800000 AS second_ms
FROM f
"""


DICTIONARY_TERMS = f"""
WITH {PAGE_LOG_ITEM},
dict AS (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '[\\p{{L}}\\p{{N}}]+')) AS term FROM part),
lens AS (SELECT DISTINCT length(term) AS len FROM dict),
kw AS (SELECT event_id, lower(item) AS src FROM {KEYWORD_ROWS}),
subs AS (SELECT event_id, src, len, unnest(range(1, length(src) - len + 2)) AS pos
         FROM kw JOIN lens ON length(kw.src) >= lens.len)
SELECT event_id, CAST(pos AS BIGINT) AS pos, dict.term
FROM subs JOIN dict ON substring(src, pos, len) = dict.term
"""


KEYWORD_TERMS = f"""
WITH {PAGE_LOG_ITEM},
dict AS (SELECT DISTINCT unnest(regexp_extract_all(lower(p_name), '[\\p{{L}}\\p{{N}}]+')) AS term FROM part),
lens AS (SELECT DISTINCT length(term) AS len FROM dict),
kw AS (SELECT ts - (ts % 3600000) AS w, lower(item) AS src FROM {KEYWORD_ROWS}),
subs AS (SELECT w, src, len, unnest(range(1, length(src) - len + 2)) AS pos
         FROM kw JOIN lens ON length(kw.src) >= lens.len)
SELECT {_dt('w')} AS stt, {_dt('w + 3600000')} AS edt, dict.term AS keyword, CAST(count(*) AS BIGINT) AS keyword_count
FROM subs JOIN dict ON substring(src, pos, len) = dict.term GROUP BY w, dict.term
"""


def oracle_sql() -> dict[str, str]:
    return {
        "traffic_window": traffic_window(10_000),
        "traffic_window_hourly": traffic_window(3_600_000, "last_page_id"),
        "home_detail_window": home_detail_window(10_000, "date"),
        "home_detail_window_hourly": home_detail_window(3_600_000, "datetime"),
        "login_window": login_window(10_000, "date"),
        "login_window_hourly": login_window(3_600_000, "datetime"),
        "keyword_window": keyword_window(10_000),
        "keyword_window_hourly": keyword_window(3_600_000),
        "keyword_window_sql": keyword_window(10_000),
        "keyword_window_text": KEYWORD_TEXT,
        "keyword_window_terms": KEYWORD_TERMS,
        "daily_uv": DAILY_UV,
        "home_detail_daily": home_detail_daily(False),
        "home_detail_daily_per_page": home_detail_daily(True),
        "login_return": login_return(),
        "fix_is_new": FIX_IS_NEW,
        "page_filter": _filtered("page_id IN ('home', 'good_detail')"),
        "login_filter": _filtered("uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')"),
        "keyword_filter": f"WITH {PAGE_LOG_ITEM} SELECT event_id, item, ts FROM {KEYWORD_ROWS}",
        "parse_clean": PARSE_CLEAN,
        "parse_dirty": PARSE_DIRTY,
        "log_page": LOG_PAGE,
        "log_start": LOG_START,
        "log_error": LOG_ERROR,
        "log_page_json": LOG_PAGE_JSON,
        "log_start_json": LOG_START_JSON,
        "log_error_json": LOG_ERROR_JSON,
        "log_display_json": LOG_DISPLAY_JSON,
        "log_action_json": LOG_ACTION_JSON,
        "log_display": LOG_DISPLAY,
        "log_action": LOG_ACTION,
        "cdc_cart": CDC_CART,
        "cdc_parse": CDC_PARSE,
        "cart_lookup": CART_LOOKUP,
        "order_detail_wide": ORDER_DETAIL_WIDE,
        "order_detail_changelog": _order_detail_changelog(),
        "config_fold": config_fold("dim"),
        "config_fold_dwd": config_fold("dwd"),
        "config_fold_evict": config_fold("dim", evict_moved=True),
        "dim_route": DIM_ROUTE,
        "dwd_route": DWD_ROUTE,
        "dim_route_asof": route_asof("dim"),
        "dwd_route_asof": route_asof("dwd"),
        "cart_lookup_asof": CART_LOOKUP_ASOF,
        "dim_upsert": DIM_UPSERT,
        "dim_upsert_wide": DIM_UPSERT_WIDE,
        "config_fold_preload": config_fold_preload("dim"),
        "topic_records": TOPIC_RECORDS,
        "cart_add_json": CART_ADD_JSON,
        "order_detail_upsert": ORDER_DETAIL_UPSERT,
        "traffic_window_from_log": TRAFFIC_WINDOW_FROM_LOG,
        "ensure_schema": ENSURE_SCHEMA,
        "dim_ddl": DIM_DDL,
        "time_functions": TIME_FUNCTIONS,
        "dictionary_terms": DICTIONARY_TERMS,
    }
