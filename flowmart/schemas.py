"""Record shapes of the warehouse (explicit StructTypes; no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
STR_MAP = T.MapType(S, S)

COMMON = T.StructType([T.StructField(n, S) for n in ("mid", "uid", "is_new", "vc", "ch", "ar")])

PAGE = T.StructType([
    T.StructField("page_id", S),
    T.StructField("last_page_id", S),
    T.StructField("item", S),
    T.StructField("item_type", S),
    T.StructField("during_time", L),
    # read by the traffic job only (its session test, Q7); absent in most logs
    T.StructField("last_page", S),
])

# Behaviour log record (topic_log).  ``start`` and ``err`` are JSON objects in
# the text; parsed as strings they keep their JSON text.
LOG = T.StructType([
    T.StructField("common", COMMON),
    T.StructField("page", PAGE),
    T.StructField("start", S),
    T.StructField("displays", T.ArrayType(STR_MAP)),
    T.StructField("actions", T.ArrayType(STR_MAP)),
    T.StructField("err", S),
    T.StructField("ts", L),
])

# Database change feed (topic_db, Maxwell format).
CDC = T.StructType([
    T.StructField("database", S),
    T.StructField("table", S),
    T.StructField("type", S),
    T.StructField("ts", L),
    # transaction id and place in the transaction: the order of changes of one second
    T.StructField("xid", L),
    T.StructField("xoffset", L),
    T.StructField("data", STR_MAP),
    T.StructField("old", STR_MAP),
])

# One row of the routing configuration table (table_process).
CONFIG_FIELDS = ("source_table", "source_type", "sink_table", "sink_type",
                 "sink_columns", "sink_pk", "sink_extend")
CONFIG = T.StructType([T.StructField(n, S) for n in CONFIG_FIELDS])

# A change of the configuration table (Debezium format).
CONFIG_CHANGE = T.StructType([
    T.StructField("before", CONFIG),
    T.StructField("after", CONFIG),
    T.StructField("op", S),
    T.StructField("ts_ms", L),
])

BASE_DIC = T.StructType([T.StructField(n, S) for n in
                         ("dic_code", "dic_name", "parent_code", "create_time", "operate_time")])

# Column lists of the CDC slices (fixed values: the reference's table layouts).
CART_INFO_COLS = ["id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name",
                  "is_checked", "create_time", "operate_time", "is_ordered",
                  "order_time", "source_type", "source_id"]
ORDER_DETAIL_COLS = ["id", "order_id", "sku_id", "sku_name", "img_url", "order_price",
                     "sku_num", "create_time", "source_type", "source_id",
                     "split_total_amount", "split_activity_amount", "split_coupon_amount"]
ORDER_INFO_COLS = ["id", "consignee", "consignee_tel", "total_amount", "order_status",
                   "user_id", "payment_way", "delivery_address", "order_comment",
                   "out_trade_no", "trade_body", "create_time", "operate_time",
                   "expire_time", "process_status", "tracking_no", "parent_order_id",
                   "img_url", "province_id", "activity_reduce_amount",
                   "coupon_reduce_amount", "original_total_amount", "feight_fee",
                   "feight_fee_reduce", "refundable_time"]
ORDER_ACTIVITY_COLS = ["id", "order_id", "order_detail_id", "activity_id",
                       "activity_rule_id", "sku_id", "create_time"]
ORDER_COUPON_COLS = ["id", "order_id", "order_detail_id", "coupon_id",
                     "coupon_use_id", "sku_id", "create_time"]

# Output of the cart-add fact (14 columns, in order).
CART_ADD_OUT = ["id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name",
                "is_checked", "create_time", "operate_time", "is_ordered",
                "order_time", "source_type", "dic_name", "source_id"]

# Output of the order-detail fact (37 columns, in order).
ORDER_DETAIL_OUT = ["id", "order_id", "sku_id", "sku_name", "order_price", "sku_num",
                    "create_time", "source_type", "dic_name", "source_id",
                    "split_total_amount", "split_activity_amount", "split_coupon_amount",
                    "consignee", "consignee_tel", "total_amount", "order_status",
                    "user_id", "payment_way", "delivery_address", "order_comment",
                    "out_trade_no", "trade_body", "expire_time", "process_status",
                    "tracking_no", "parent_order_id", "province_id",
                    "activity_reduce_amount", "coupon_reduce_amount",
                    "original_total_amount", "feight_fee", "feight_fee_reduce",
                    "activity_id", "activity_rule_id", "coupon_id", "coupon_use_id"]
