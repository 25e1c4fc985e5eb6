"""DWD log layer: parse, repair and split the behaviour log (log-split job; R1-R6, T5).

One parsed DataFrame feeds five selections.  In a stream they are written
from one ``foreachBatch`` (see :func:`flowmart.streaming.jobs.run_log_split`)
so the source is read and parsed once per micro-batch.

Beside the typed fields every output keeps the whole ``record`` (a map of
variants): fields that no schema lists pass through, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart import schemas
from flowmart.operators import daily, parse
from flowmart.session import DEFAULT_TZ

OUTPUTS = ("page", "start", "display", "action", "error")


def parse_log(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """P1 + Q15: (valid log records, dirty lines).  Lines that parse but lack
    a required field join the dirty output with their raw text."""
    keep = [c for c in raw.columns if c != value]
    r = F.col(parse.RECORD)
    typed = {f.name: c for f, c in zip(schemas.LOG.fields, parse.log_fields(r), strict=True)}
    read = {f"__{n}": typed[n] for n in ("common", "page", "start", "ts")}
    complete = (F.col("__common.mid").isNotNull() & F.col("__common.is_new").isNotNull() & F.col("__ts").isNotNull()
                & (F.col("__start").isNotNull() | F.col("__page").isNotNull()))
    good, dirty = parse.split_valid(raw, complete, value, **read)
    return good.select(*keep, *[F.col(f"__{n}").alias(n) if f"__{n}" in read else c for n, c in typed.items()],
                       parse.fields(r).alias(parse.RECORD)), dirty.select(*keep, value)


def with_flag(log: DataFrame) -> DataFrame:
    """The repaired ``common.is_new`` put back into the record, whose ``common``
    loses its nulls."""
    if parse.RECORD not in log.columns:
        return log
    r = F.col(parse.RECORD)
    common = parse.put(parse.drop_nulls(parse.entry(r, "common", "map<string,variant>")),
                       is_new=F.col("common.is_new"))
    return log.withColumn(parse.RECORD, parse.put(r, common=parse.as_variant(common)))


def split_log(log: DataFrame) -> dict[str, DataFrame]:
    """The five outputs of one record stream.

    * error (R2): records with ``err``, whole (``err`` included);
    * start (R3): start records without ``err``; they yield nothing else;
    * display (R4): one row per display of a page record, + page_id and ts;
    * action (R5): one row per action of a page record, + page_id (no ts);
    * page (R6): page records without err, displays and actions.
    Display and action rows carry the element map and typed page_id / ts.
    """
    whole = parse.RECORD in log.columns

    def without(df: DataFrame, *fields: str) -> DataFrame:
        df = df.drop(*fields)
        return df.withColumn(parse.RECORD, F.map_filter(
            parse.RECORD, lambda k, v: ~k.isin(*fields))) if whole else df

    error = log.where(F.col("err").isNotNull())
    rest = without(log, "err")
    start = rest.where(F.col("start").isNotNull())
    pages = rest.where(F.col("start").isNull())
    extra = [c for c in log.columns if c not in {f.name for f in schemas.LOG.fields} | {parse.RECORD}]
    display = (
        pages.select(*extra, F.explode("displays").alias("display"),
                     F.col("page.page_id").alias("page_id"), F.col("ts"))
        .withColumn("display", F.map_filter("display", lambda k, v: ~k.isin("page_id", "ts"))))
    action = (
        pages.select(*extra, F.explode("actions").alias("action"),
                     F.col("page.page_id").alias("page_id"))
        .withColumn("action", F.map_filter("action", lambda k, v: k != "page_id")))
    page = without(pages, "displays", "actions").drop("start")
    return {"page": page, "start": start, "display": display, "action": action, "error": error}


def json_outputs(out: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The five outputs as JSON lines (``value``): whole page, start and error records;
    display elements with page_id and ts (a number), action elements with page_id."""
    fields = {"display": lambda: parse.put(F.col("display"), page_id=F.col("page_id"), ts=F.col("ts")),
              "action": lambda: parse.put(F.col("action"), page_id=F.col("page_id"))}
    typed = {f.name for f in schemas.LOG.fields} | {parse.RECORD, "display", "action", "page_id"}
    lines = {}
    for kind in OUTPUTS:
        record = fields[kind]() if kind in fields else F.col(parse.RECORD)
        keep = [c for c in out[kind].columns if c not in typed]
        lines[kind] = out[kind].select(*keep, parse.json_text(record).alias("value"))
    return lines


def log_layer(raw: DataFrame, value: str = "value", tiebreak: str | None = None,
              tz: str = DEFAULT_TZ) -> dict[str, DataFrame]:
    """The log-split job end to end: parse -> new-visitor repair by mid (T5) -> split.

    Returns the five outputs plus ``dirty``.  The repair's own side reads only the
    three fields it needs of each line.
    """
    valid, dirty = parse_log(raw, value)
    r = F.col(parse.RECORD)
    keep = [tiebreak] if tiebreak else []
    read = {"__mid": parse.field(r, "common", path="$.mid"), "__is_new": parse.field(r, "common", path="$.is_new"),
            "__ts": parse.field(r, "ts", "bigint")}
    complete = (F.col("__mid").isNotNull() & F.col("__is_new").isNotNull() & F.col("__ts").isNotNull()
                & (parse.field(r, "start").isNotNull() | parse.field(r, "page", "struct<>").isNotNull()))
    good, _ = parse.split_valid(raw.select(*keep, value), complete, value, **read)
    flags = good.select(*keep, *[F.col(c).alias(c[2:]) for c in read])
    fixed = daily.fix_is_new(valid, "common.mid", "common.is_new", "ts", tiebreak, tz,
                             states=daily.visitor_states(flags, "mid", "is_new", "ts", tiebreak, tz))
    out = split_log(with_flag(fixed))
    out["dirty"] = dirty
    return out
