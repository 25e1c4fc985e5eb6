"""DIM layer: route dimension changes by configuration and keep dimension
tables up to date by keyed upsert (R7, P8, J4, K5, K6, Q13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmart.operators import config as cfg

ROUTED_TYPES = ("insert", "update", "bootstrap-insert")
# arrival order of changes: the change's second, its transaction, its place in it
ARRIVAL = ("ts", "xid", "xoffset")


def route(
    feed: DataFrame,
    config: DataFrame,
    types: Sequence[str] = ROUTED_TYPES,
) -> DataFrame:
    """R7 + P8 + P9: dimension records with their target table.

    ``config`` is the current DIM configuration (``fold_changes`` or
    ``snapshot`` output).  Only insert, update and bootstrap-insert changes
    are routed (deletes are not).  Output: ``sink_table``, ``sink_pk`` (with
    its default), ``table``, ``type``, ``ts``, ``xid``, ``xoffset`` and the
    pruned ``data`` map.
    """
    c = config.select("source_table", "sink_table", F.split("sink_columns", ",").alias("_names"), "sink_pk")
    rows = feed.where(F.col("type").isin(*types))
    return routed(rows.join(c, rows["table"] == c["source_table"], "inner"), cfg.kept("data", "_names"))


def route_asof(
    feed: DataFrame,
    rules: DataFrame,
    types: Sequence[str] = ROUTED_TYPES,
    bucket: int = cfg.DAY_MS,
) -> DataFrame:
    """R7 + J4 as of time: each change is routed by the rule that was in force when it came.

    ``rules`` is ``config.rule_versions``: a rule changed or deleted in mid-feed routes what comes
    after it only.  A change's second is its time: of a rule's changes those up to its beginning
    count.  Output as :func:`route`.
    """
    rows = (feed.where(F.col("type").isin(*types))
            .withColumns({"_key": F.col("table"), "_at": F.col("ts") * 1000}))
    return routed(cfg.in_force(rows, rules, bucket))


def routed(joined: DataFrame, data: Column | None = None) -> DataFrame:
    """The output of :func:`route` from changes and the columns of their rule (``data``: as pruned by it)."""
    data = cfg.prune("data", "sink_columns") if data is None else data
    return joined.select(
        "sink_table", cfg.pk_or_default("sink_pk").alias("sink_pk"),
        "table", "type", "ts", "xid", "xoffset", data.alias("data"))


def upsert_fold(
    routed: DataFrame,
    order: Sequence[str] = ARRIVAL,
    null_as_empty: bool = True,
) -> DataFrame:
    """K6 / K4 in batch: the dimension rows after all upserts, long format.

    Each routed record writes only the columns it names; a column keeps its
    last written value (absent columns keep the old value).  Output:
    ``sink_table``, ``pk``, ``column``, ``value`` -- one row per cell.  Null
    values become '' by default, as the reference's statement text does
    (Q13).  The last written value is the last by arrival (``order``).  The fold
    is a ``max`` of (order, value) per cell: partial aggregation, so a hot key
    is combined before the shuffle; the value decides only between changes that
    the feed itself does not order.
    """
    # records are spread first, in partitions of about one size in bytes, keys together: a large file
    # read by one task would otherwise be sorted there as cells, many times its size
    spread = (routed.withColumn("__pk", F.col("data")[F.col("sink_pk")])
              .hint("rebalance", F.col("sink_table"), F.col("__pk")))
    return plain_cells(last_cells(cells_of(spread), order), null_as_empty)


def cells_of(routed: DataFrame) -> DataFrame:
    """One row per written cell: ``sink_table``, ``pk``, ``column``, ``value`` and its arrival."""
    cells = routed.select("sink_table", F.col("data")[F.col("sink_pk")].alias("pk"), *ARRIVAL,
                          F.explode("data").alias("column", "value"))
    return cells.where(F.col("pk").isNotNull())


def last_cells(cells: DataFrame, order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The last written value of each cell by arrival, with the arrival columns."""
    o = F.struct(*[F.col(c) for c in order], F.col("value"))
    return (cells.groupBy("sink_table", "pk", "column").agg(F.max(o).alias("_last"))
            .select("sink_table", "pk", "column", "_last.*"))


def plain_cells(cells: DataFrame, null_as_empty: bool = True) -> DataFrame:
    value = F.coalesce("value", F.lit("")) if null_as_empty else F.col("value")
    return cells.select("sink_table", "pk", "column", value.alias("value"))


def table_schema(sink_columns: str, sink_pk: str | None) -> tuple[T.StructType, str]:
    """K5: all-string schema of a dimension table and its key column."""
    pk = sink_pk if sink_pk else "id"
    return T.StructType([T.StructField(c, T.StringType(), c != pk)
                         for c in sink_columns.split(",")]), pk


def schema_rows(config: DataFrame, schema_name: str = "REALTIME_DIM") -> DataFrame:
    """K5 + F17 as data: one row per column of every configured table, with
    its type, key flag and the table's DDL suffix ('' when null)."""
    pk = cfg.pk_or_default("sink_pk")
    return config.select(
        "sink_table", pk.alias("sink_pk"),
        F.coalesce("sink_extend", F.lit("")).alias("sink_extend"),
        F.posexplode(F.split("sink_columns", ",")).alias("pos", "column_name"),
    ).select(
        F.lit(schema_name).alias("schema_name"), "sink_table",
        (F.col("pos") + 1).alias("position"), "column_name",
        F.lit("varchar").alias("column_type"),
        (F.col("column_name") == F.col("sink_pk")).alias("is_pk"), "sink_extend")


def ddl(schema_rows_df: DataFrame) -> DataFrame:
    """The create-table text per table, columns in configured order."""
    col_def = F.concat(F.col("column_name"), F.lit(" varchar"),
                       F.when(F.col("is_pk"), F.lit(" primary key")).otherwise(F.lit("")))
    return (schema_rows_df.groupBy("schema_name", "sink_table", "sink_extend")
            .agg(F.array_sort(F.collect_list(F.struct("position", col_def.alias("d")))).alias("cols"))
            .select("sink_table", F.concat(
                F.lit("create table if not exists "), F.col("schema_name"), F.lit("."),
                F.col("sink_table"), F.lit(" ("),
                F.array_join(F.transform("cols", lambda c: c["d"]), ", "),
                F.lit(") "), F.col("sink_extend")).alias("ddl")))


def merge_into(current: DataFrame, cells: DataFrame, columns: Sequence[str],
               sink_pk: str | None = None) -> DataFrame:
    """K6 against an existing table: new values win per cell, untouched cells
    keep the current value.  ``sink_pk`` names the key column (``id`` when null
    or empty, F17).  Returns the new table (write it to a new path)."""
    pk = sink_pk or "id"
    cur_cells = current.select(F.col(pk).alias("pk"), F.explode(F.create_map(
        *[x for c in columns for x in (F.lit(c), F.col(c))])).alias("column", "value"))
    merged = (cur_cells.withColumn("_src", F.lit(0))
              .unionByName(cells.select("pk", "column", "value").withColumn("_src", F.lit(1)))
              .groupBy("pk", "column").agg(F.max_by("value", "_src").alias("value")))
    wide = merged.groupBy("pk").pivot("column", list(columns)).agg(F.first("value"))
    rest = [c for c in columns if c != pk]
    return wide.select(F.col("pk").alias(pk), *rest).select(*columns) if pk in columns else wide

