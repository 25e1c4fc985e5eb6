"""Sharding by sampled splitters (operator 5), DataFrame functions only.

Rows are ordered by (hash of the text, doc_id, a number of the row).  A size-weighted sample of
these keys gives quantile boundaries ("splitters") of many key ranges; ranges that hold too many
bytes all the same are subdivided by splitters drawn inside them, each round by another sample at a
higher rate.  Consecutive ranges then fill the shards: exact byte counts per range (a partial
aggregate) give every range its offset, and a running sum inside each range places every row.
Shard sizes differ by about one row's bytes.

A group of equal texts shares the hash but not the doc_id, and rows alike in both still have numbers
of their own, so a hot group is cut like any other part of the key space.  The numbers are drawn
once: the rows are written with their keys before anything is counted.  The work per task is one
range, whose size is set by the splitters and not by any group.  Only the splitters (at most
``MAX_RANGES`` keys at first) and one row of totals reach the driver.

Defined cases: a null text has size 1 and the checksum of no bytes; a null doc_id sorts first;
rows alike in both columns get slots next to each other, in any order; an empty table gives an empty
result.  A column named like an output is replaced; any other name is kept.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm import common as C

LAW = "bytes"
#: rows that a range should hold, its bounds in number, and sample keys drawn for each range
RANGE_ROWS = 20_000
MIN_RANGES = 64
MAX_RANGES = 32_768
SAMPLES = 24
#: a range beyond so many times its due bytes is subdivided, in so many rounds at most
OVERFULL = 2.0
ROUNDS = 3

#: each round draws so many times the sample keys per byte of the one before
FINER = 4

_KEYS = "array<struct<k:bigint,i:struct<i:bigint,n:bigint>>>"


def size_of(text: str | Column = "text") -> Column:
    """UTF-8 bytes of the text plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def _keyed(docs: DataFrame, p: str = "__") -> DataFrame:
    """The rows with their size and their key: ``k`` (hash of the text) and ``i`` (doc_id, number)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    number = F.xxhash64(F.monotonically_increasing_id())
    doc_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63)))
    return docs.withColumns({f"{p}size": size_of(text), f"{p}k": F.xxhash64(text),
                             f"{p}i": F.struct(doc_id.alias("i"), number.alias("n"))})


def _range_of(splitters: list[tuple], p: str = "__") -> Column:
    """The number of splitters up to the row's key, by binary search."""
    keys = F.from_json(F.lit(json.dumps([{"k": k, "i": {"i": i, "n": n}} for k, (i, n) in splitters])), _KEYS)
    steps = [1 << b for b in reversed(range(max(1, len(splitters).bit_length())))]
    key = F.struct(F.col(f"{p}k").alias("k"), F.col(f"{p}i").alias("i"))
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        F.get(keys, at + step - 1) <= key, at + step).otherwise(at))


def _draw(rows: DataFrame, rate: float, ranges: Column, salt: int, p: str) -> list[tuple]:
    """Quantile boundaries of a sample in which each row counts in proportion to its size:
    ``rate`` is sample keys per byte, ``ranges`` how many ranges the row's group is cut into."""
    u = F.pmod(F.xxhash64(f"{p}k", f"{p}i", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)
    sample = (rows.withColumn("w", F.floor(F.col(f"{p}size") * rate + u)).where("w > 0")
              .select("g", "w", ranges.alias("r"), F.col(f"{p}k").alias("k"), F.col(f"{p}i").alias("i")))
    run = Window.partitionBy("g").orderBy("k", "i").rowsBetween(Window.unboundedPreceding, 0)
    part = F.floor((F.sum("w").over(run) - 1) * F.col("r") / F.sum("w").over(Window.partitionBy("g")))
    first = (sample.withColumn("part", part).where("part > 0").groupBy("g", "part")
             .agg(F.min(F.struct("k", "i")).alias("s")))
    return [(r.s["k"], (r.s["i"]["i"], r.s["i"]["n"])) for r in first.select("s").collect()]


def splitters(rows: DataFrame, total: int, n_rows: int, p: str = "__") -> list[tuple]:
    """Sorted keys that cut the rows into ranges of about equal bytes.  Bounded by
    ``MAX_RANGES`` at first, and by the bytes of overfull ranges in each later round."""
    ranges = min(MAX_RANGES, max(MIN_RANGES, -(-n_rows // RANGE_ROWS)))
    due = total / ranges
    found = sorted(set(_draw(rows.withColumn("g", F.lit(0)), SAMPLES / due, F.lit(ranges), 5, p)))
    for round_ in range(1, ROUNDS + 1):
        placed = rows.withColumn("g", _range_of(found, p))
        over = (placed.groupBy("g").agg(F.sum(f"{p}size").alias("b"), F.count("*").alias("n"),
                                        F.max(f"{p}size").alias("most"))
                .where((F.col("b") > OVERFULL * due) & (F.col("n") > 1) & (F.col("most") < F.col("b") / 2)))
        over = over.select("g", "b").collect()  # fewer than there are ranges
        if not over:
            break
        bytes_of = F.create_map(*[F.lit(x) for r in over for x in (r.g, r.b)])
        inside = placed.withColumn("b", bytes_of[F.col("g")]).where("b is not null")
        found = sorted({*found, *_draw(inside, SAMPLES / due * FINER ** round_, F.ceil(F.col("b") / due),
                                       5 + round_, p)})
    return found


def shard(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """All rows and columns of ``docs`` with ``size``, ``law``, ``shard`` (0-based, in key order)
    and ``slot`` (place in the shard, gapless from 0)."""
    p = C.prefix(docs)
    size, k, i, r, run, at, before, first = (f"{p}{c}" for c in "size k i r run at before first".split())
    rows = C.written(_keyed(docs, p), "op5-rows")
    narrow = rows.select(size, k, i)
    total, n_rows = narrow.agg(F.coalesce(F.sum(size), F.lit(0)), F.count("*")).first()
    cuts = splitters(narrow, total, n_rows, p) if n_rows else []
    total = max(total, 1)

    ahead = Window.orderBy(r).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (narrow.withColumn(r, _range_of(cuts, p)).groupBy(r).agg(F.sum(size).alias("b"))
               .select(r, F.coalesce(F.sum("b").over(ahead), F.lit(0)).alias(before)))

    def placed(df: DataFrame) -> DataFrame:
        upto = Window.partitionBy(r).orderBy(k, i).rowsBetween(Window.unboundedPreceding, 0)
        # the shard of a row is where the middle of its bytes falls
        middle = (F.col(before) + F.col(run)) * 2 - F.col(size)
        place = F.floor(middle / F.lit(2) * n_shards / F.lit(total)).cast("int")
        return (df.withColumn(r, _range_of(cuts, p)).join(F.broadcast(offsets), r)
                .withColumn(run, F.sum(size).over(upto))
                .withColumn(at, F.least(place, F.lit(n_shards - 1))))

    counts = (placed(narrow).groupBy(r, at).agg(F.count("*").alias("n"))
              .select(r, at, F.coalesce(F.sum("n").over(
                  Window.partitionBy(at).orderBy(r)
                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(first)))
    in_part = Window.partitionBy(r, at).orderBy(k, i)
    slot = (F.col(first) + F.row_number().over(in_part) - 1).cast("bigint")
    out = {"size": F.col(size), "law": F.lit(LAW), "shard": F.col(at), "slot": slot}
    return (placed(rows).join(F.broadcast(counts), [r, at])
            .select(*[c for c in docs.columns if c not in out], *[v.alias(c) for c, v in out.items()]))
