"""DWD trade facts: cart additions and the wide order-detail table
(cart-add and order-detail jobs; J1-J3, T15, Q3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart import schemas
from flowmart.operators.cdc import cdc_slice
from flowmart.operators.lookup import lookup_asof, lookup_join

def cart_add(feed: DataFrame, dic: DataFrame) -> DataFrame:
    """Cart additions with the source-type name (14 columns).

    Inner lookup: a cart row whose source_type is not in the dictionary is
    dropped, as in the reference.
    """
    cart = cdc_slice(feed, "cart_info", schemas.CART_INFO_COLS)
    names = dic.select(F.col("dic_code"), F.col("dic_name"))
    return lookup_join(cart, names, "source_type", "dic_code").select(*schemas.CART_ADD_OUT)


def cart_add_asof(feed: DataFrame, dic: DataFrame) -> DataFrame:
    """Cart additions with the source-type name as it was when they came (``dic``:
    ``lookup.dim_versions`` with dic_name)."""
    cart = cdc_slice(feed, "cart_info", schemas.CART_INFO_COLS)
    return lookup_asof(cart, dic, "source_type", F.col("ts") * 1000).select(*schemas.CART_ADD_OUT)


def slices(feed: DataFrame, keep: Sequence[str] = ("ts",)) -> dict[str, tuple[DataFrame, str]]:
    """The four slices of the feed that an order detail is made of, each with its order id column."""
    parts = {"order_detail": (schemas.ORDER_DETAIL_COLS, "order_id"),
             "order_info": (schemas.ORDER_INFO_COLS, "id"),
             "order_detail_activity": (schemas.ORDER_ACTIVITY_COLS, "order_id"),
             "order_detail_coupon": (schemas.ORDER_COUPON_COLS, "order_id")}
    return {t: (cdc_slice(feed, t, cols, keep=keep), key) for t, (cols, key) in parts.items()}


def order_detail(feed: DataFrame, dic: DataFrame) -> DataFrame:
    """Wide order detail (37 columns) of a feed; its stream form is
    :func:`flowmart.streaming.jobs.run_order_detail`."""
    return join_slices({t: rows for t, (rows, _) in slices(feed).items()}, dic)


def _sided(parts: dict[str, DataFrame], keep: Sequence[str] = ()) -> tuple[DataFrame, ...]:
    """The four slices with column names of their own; ``keep`` columns get the side as prefix."""
    kept = lambda p: [F.col(c).alias(f"{p}_{c}") for c in keep]
    od = parts["order_detail"].select(*[F.col(c).alias(f"od_{c}") for c in schemas.ORDER_DETAIL_COLS], *kept("od"))
    oi = parts["order_info"].select(*[F.col(c).alias(f"oi_{c}") for c in schemas.ORDER_INFO_COLS], *kept("oi"))
    oa = parts["order_detail_activity"].select(
        F.col("order_detail_id").alias("oa_odid"), "activity_id", "activity_rule_id", *kept("oa"))
    oc = parts["order_detail_coupon"].select(
        F.col("order_detail_id").alias("oc_odid"), "coupon_id", "coupon_use_id", *kept("oc"))
    return od, oi, oa, oc


def _wide() -> list[Column]:
    """The 37 output columns of the joined sides."""
    own = {"activity_id", "activity_rule_id", "coupon_id", "coupon_use_id", "dic_name"}
    side = lambda c: c if c in own else f"od_{c}" if c in schemas.ORDER_DETAIL_COLS else f"oi_{c}"
    return [F.col(side(c)).alias(c) for c in schemas.ORDER_DETAIL_OUT]


def join_slices(parts: dict[str, DataFrame], dic: DataFrame) -> DataFrame:
    """Detail JOIN order, LEFT JOIN activity, LEFT JOIN coupon, JOIN dictionary.

    The activity and coupon views are joined under their registered names
    (the reference misnames them, Q3).  The dictionary comes first: it drops
    details before any shuffle.  Activity and coupon share the detail-id
    partitioning while the row is narrow; the order, the widest side, is last.
    """
    od, oi, oa, oc = _sided(parts)
    names = dic.select(F.col("dic_code"), F.col("dic_name"))
    return (lookup_join(od, names, "od_source_type", "dic_code")
            .join(oa, F.col("od_id") == F.col("oa_odid"), "left")
            .join(oc, F.col("od_id") == F.col("oc_odid"), "left")
            .join(oi, F.col("od_order_id") == F.col("oi_id"), "inner")).select(*_wide())


# ---- the changelog of the joins

# arrival order of the changes of one transaction place: the source of a detail before what hangs on it
RANK = {"order_info": 0, "order_detail": 1, "order_detail_activity": 2, "order_detail_coupon": 3}
INSERT, BEFORE, AFTER = "+I", "-U", "+U"


def order_detail_changelog(feed: DataFrame, dic: DataFrame) -> DataFrame:
    """Every version of every order detail in the order in which the updating joins emit them.

    A row of the inner join appears when the later of its two sides arrives.  A left join shows it
    with a null side until the first match arrives, takes that version back and puts the matched
    one in its place; further matches add rows.  So each version lives from one arrival to another,
    and both ends follow from the arrivals by joins and minima, without going through the feed row by
    row: a detail with its order starts at the later arrival, its null side ends at its first match.
    A version that starts at the first match of its detail (of a step of its own) replaces the null side,
    which was there before: its detail and order came earlier.  All other versions are new rows.

    Output: ``op`` (+I a new row, -U the version taken back, +U the one in its place), ``ts``, ``xid``,
    ``xoffset``, ``step`` (the arrival that caused it; ``step`` is the slice's place among changes
    that the feed does not order, a take-back comes before its replacement) and the 37 columns.
    Folded (:func:`fold_changelog`), it is :func:`order_detail`.
    """
    parts = {t: rows for t, (rows, _) in slices(feed, _PLACE).items()}
    od, oi, oa, oc = _sided(parts, _PLACE)
    names = dic.select(F.col("dic_code"), F.col("dic_name"))
    # the detail is joined while it is narrow; the order, the widest side, is shuffled and joined once, at the end
    rows = (lookup_join(od, names, "od_source_type", "dic_code")
            .join(_ranked(oa, "oa_odid", "oa"), F.col("od_id") == F.col("oa_odid"), "left")
            .join(_ranked(oc, "oc_odid", "oc"), F.col("od_id") == F.col("oc_odid"), "left")
            .join(oi, F.col("od_order_id") == F.col("oi_id")))
    base = rows.withColumns({"from_": F.greatest(_at("od", "order_detail"), _at("oi", "order_info")),
                             "to_": F.lit(None).cast(_AT)})
    one = _left_versions(base, "oa", "order_detail_activity", ("activity_id", "activity_rule_id"))
    two = _left_versions(one, "oc", "order_detail_coupon", ("coupon_id", "coupon_use_id"))
    # a row is added at its start; its end takes it back
    start = F.col("from_")
    ordered = start["ts"].isNotNull() & start["xid"].isNotNull() & start["xoffset"].isNotNull()
    replaces = ordered & ((start == F.col("oa_from")) | (start == F.col("oc_from")))
    ends = F.array(F.struct(F.when(replaces, AFTER).otherwise(INSERT).alias("op"), start.alias("at")),
                   F.struct(F.lit(BEFORE).alias("op"), F.col("to_").alias("at")))
    events = two.withColumn("e", F.explode(ends)).where("e.at is not null")
    return events.select("e.op", "e.at.*", *_wide())


_AT = "struct<ts:bigint,xid:bigint,xoffset:bigint,step:int>"
_PLACE = ("ts", "xid", "xoffset")


def _at(p: str, table: str, of: str = "") -> Column:
    """The arrival of a side from its place in the feed, which is shuffled as plain columns."""
    return F.struct(*[F.col(f"{p}_{of}{c}").alias(c) for c in _PLACE], F.lit(RANK[table]).alias("step"))


def _ranked(side: DataFrame, key: str, p: str) -> DataFrame:
    """The changes of a side by their order within its key: ``{p}_nth``, and for later ones the place of
    the first."""
    by_key = Window.partitionBy(key).orderBy(*[f"{p}_{c}" for c in _PLACE])
    nth = F.row_number().over(by_key)
    first = lambda c: F.when(nth > 1, F.first(f"{p}_{c}").over(by_key))
    return side.where(F.col(key).isNotNull()).select(
        "*", nth.alias(f"{p}_nth"), *[first(c).alias(f"{p}_first_{c}") for c in _PLACE])


def _left_versions(rows: DataFrame, p: str, table: str, cols: Sequence[str]) -> DataFrame:
    """LEFT JOIN as an updating join, of ``rows`` (alive from ``from_`` until ``to_``, null: for ever)
    that are left-joined with :func:`_ranked`: every match, from the later arrival on, and a null side
    while no match has come, made with the first match of the key.  Adds ``{p}_from``, the first arrival
    for the key; ``cols`` are the side's."""
    nth = F.col(f"{p}_nth")
    at = F.when(nth.isNotNull(), _at(p, table))
    first = F.when(nth == 1, at).when(nth > 1, _at(p, table, "first_"))
    version = lambda from_, to_, match: F.struct(
        from_.alias("from_"), to_.alias("to_"),
        *[(F.col(c) if match else F.lit(None).cast(rows.schema[c].dataType)).alias(c) for c in cols])
    # a null in greatest and least is passed over: no match, no other end
    lone = F.when(nth.isNull() | (nth == 1), version(F.col("from_"), F.least("to_", first), False))
    matched = F.when(nth.isNotNull(), version(F.greatest("from_", at), F.col("to_"), True))
    keep = [c for c in rows.columns if c not in ("from_", "to_", *cols)]
    return (rows.select(*keep, first.alias(f"{p}_from"), F.explode(F.array(lone, matched)).alias("v"))
            .where("v is not null and (v.to_ is null or v.from_ < v.to_)").select(*keep, f"{p}_from", "v.*"))


def fold_changelog(log: DataFrame) -> DataFrame:
    """The rows that a changelog leaves: as often as they were put in and not taken back."""
    row = [F.col(c) for c in schemas.ORDER_DETAIL_OUT]
    n = F.sum(F.when(F.col("op") == BEFORE, -1).otherwise(1))
    left = log.groupBy(*row).agg(n.alias("_n")).where("_n > 0")
    return left.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n"))).select(*row)
