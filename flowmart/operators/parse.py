"""Parsing of JSON text records (P1, P2, P17) and required-field checks (Q15).

A line is read to VARIANT, so a record keeps every field with its own type
whether or not a schema lists it, and numbers may come quoted.  Exactly one
JSON object makes a record: text after it, a list or a bare value does not.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart import schemas

RECORD = "record"
# closes the list that a line is read in: what follows a complete record cannot pass for it
_END = "end-of-record"


def _line(value: Column) -> Column:
    """The line as VARIANT, read as the first item of a list, with what follows it."""
    return F.try_parse_json(F.concat(F.lit("["), value, F.lit(f',"{_END}"]')))


def _only_record(line: Column) -> Column:
    """The first item; null unless it is an object and all there is (duplicate keys count as malformed)."""
    at = lambda path, kind: F.try_variant_get(line, path, kind)
    whole = (at("$[1]", "string") == _END) & at("$[2]", "variant").isNull() & at("$[0]", "struct<>").isNotNull()
    return F.when(whole, at("$[0]", "variant"))


def bind(df: DataFrame, **columns: Column) -> DataFrame:
    """Sets columns through a one-row generator.  Catalyst copies a projected expression into every
    place that reads it; what a generator makes is worked out once per row."""
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(F.struct(*(v.alias(k) for k, v in columns.items())))))


def field(record: Column, name: str, kind: str = "string", path: str = "$") -> Column:
    """One field of a record as ``kind``; null when absent or not convertible.  An object or
    list read as string gives its JSON text."""
    return F.try_variant_get(record, f"$.{name}{path[1:]}", kind)


def entry(m: Column, name: str, kind: str = "string") -> Column:
    """:func:`field` of a ``map<string,variant>``."""
    return F.try_variant_get(m[name], "$", kind)


def fields(record: Column) -> Column:
    """The top-level fields of a record as ``map<string,variant>``."""
    return F.try_variant_get(record, "$", "map<string,variant>")


def with_record(df: DataFrame, value: str = "value", strict: bool = False, blank: bool = True) -> DataFrame:
    """Adds ``record``: the line as a VARIANT object, null unless the line is exactly one JSON object.
    ``strict=True`` (P2) fails the job on the first malformed line, as the reference's DWS jobs do.
    ``blank=False`` leaves null and blank lines out; they are looked for in the bound line, as a filter on
    an expression would make each line a second time.

    The line, the list it is read in and the record are bound one after the other, so a line that
    is itself an expression is made once and parsed once.  Fields are read from the record by their
    paths: a map of variants would hold the names of all keys once for each field.
    """
    lines = bind(df, **{value: F.col(value)})
    bound = bind(lines if blank else lines.where(F.trim(value) != ""), __line=_line(F.col(value)))
    rec = _only_record(F.col("__line"))
    if strict:
        rec = F.coalesce(rec, F.raise_error(F.concat(F.lit("malformed record: "), F.col(value)))
                         .cast("variant"))
    return bind(bound, **{RECORD: rec}).drop("__line")


def drop_nulls(m: Column) -> Column:
    """A ``map<string,variant>`` without JSON nulls (the reference's writer leaves them out)."""
    return F.map_filter(m, lambda k, v: ~F.call_function("is_variant_null", v))


def put(m: Column, **values: Column) -> Column:
    """A map of variants with these fields set (null values are left out)."""
    keep = F.map_filter(m, lambda k, v: ~k.isin(*values))
    new = F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("variant"))])
    return F.map_concat(keep, F.map_filter(new, lambda k, v: v.isNotNull()))


def as_variant(m: Column) -> Column:
    return F.call_function("to_variant_object", m)


def json_text(m: Column) -> Column:
    """A record as JSON text, keys in order, without top-level nulls."""
    return F.to_json(as_variant(drop_nulls(m)))


def log_fields(record: Column) -> list[Column]:
    """The typed fields of a behaviour-log record (``schemas.LOG``)."""
    lists = "array<map<string,variant>>"
    return [field(record, "common", schemas.COMMON.simpleString()).alias("common"),
            field(record, "page", schemas.PAGE.simpleString()).alias("page"),
            field(record, "start").alias("start"), field(record, "displays", lists).alias("displays"),
            field(record, "actions", lists).alias("actions"), field(record, "err").alias("err"),
            field(record, "ts", "bigint").alias("ts")]


def log_complete(record: Column) -> Column:
    """Q15: a behaviour-log record needs a mid, an is_new flag, a time and a start or page."""
    return (field(record, "common", path="$.mid").isNotNull()
            & field(record, "common", path="$.is_new").isNotNull()
            & field(record, "ts", "bigint").isNotNull()
            & (field(record, "start").isNotNull()
               | field(record, "page", "struct<page_id:string>").isNotNull()))


def split_valid(df: DataFrame, complete: Column, value: str = "value",
                **read: Column) -> tuple[DataFrame, DataFrame]:
    """(rows with a complete record, dirty lines) from one parse.  Null and blank lines give
    neither (the reference parses them to nothing).  ``read`` are fields of the record that are read
    once per line for ``complete`` and all that follows, under these names."""
    p = with_record(df, value, blank=False)
    if read:
        p = bind(p, **read)
    ok = F.col(RECORD).isNotNull() & F.coalesce(complete, F.lit(False))
    return p.where(ok), p.where(~ok).drop(RECORD, *read)


def parse_cdc(raw: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """S3: (changes with ``schemas.CDC`` fields, dirty lines).  A change needs its database, table
    and type; they are read first, so a slice reads the rest of its own changes only."""
    r = F.col(RECORD)
    keep = [c for c in raw.columns if c != value]
    need = ("database", "table", "type")
    good, dirty = split_valid(raw, reduce(and_, (F.col(f"__{n}").isNotNull() for n in need)), value,
                              **{f"__{n}": field(r, n) for n in need})
    return good.select(*keep, *[(F.col(f"__{f.name}") if f.name in need else field(
        r, f.name, f.dataType.simpleString())).alias(f.name) for f in schemas.CDC]), dirty
