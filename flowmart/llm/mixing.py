r"""Mixing sources to target weights by a low-discrepancy schedule (operator 9).

Each source's documents are put in a shuffled order (by a hash of id and text) and laid end to
end as one stream of words, cut into blocks of ``BLOCK_WORDS`` words.  A source needs as many slots
as its target has real block words (the last block of its stream may be short).  The needs of all
sources, laid end to end, are the cumulative weights: point i of a low-discrepancy sequence, frac((i +
0.5) * golden ratio) or van der Corput's, falls on one source, which gets slot i.  A source's slots are
ranked; the slot of rank r takes block r mod blocks (so every block is used once before any is used
again), and the last one a part block.  The sequence runs until the needs of all sources are met;
points of a source that has all it needs are passed over.  So the mix in slot order is near its
weights in every stretch, and every source gets its target, rounded to a whole word, at any size.

A document's copy stands in the mix at the slot of its first block.

Sources in code point order, null last, weigh 5, 2, 1, repeating, and share 150 % of all words.
A target stops at twice its source's words; the excess goes to the others by weight until none is
above: target = min(2 * words, level * weight) with the one level at which the targets add up.

Ranks and running sums are computed in two steps (per bucket of rows, then over buckets), so a
source with a third of all rows is spread over many tasks.  Reruns agree: every order is total.

Defined cases: a null text has size 0 and takes nothing; a null source is a source of its own; rows
alike in id and text count separately; an empty table gives an empty result.  Other columns may have
any names.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm import common as C

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 128
GOLDEN = 0.6180339887498949
_SPLIT = 20
_GOLDEN_HIGH = float(Decimal("0.61803398874989484820458683436563811772") * (1 << _SPLIT) % 1)
#: rows or slots of one window task
BUCKET = 16_384
#: slots of one cell, in which points and sources are matched
CELL = 16

WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str | Column = "text") -> Column:
    """Number of words in the text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size -> target, weight and place ``src`` of every source (one row each)."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(rank, len(WEIGHTS)) + 1).cast("int"))
    t = sizes.select("source", "source_size", rank.cast("int").alias("src"), weight.alias("weight"))
    cap = F.col("source_size") * MOST
    total = F.sum("source_size").over(Window.partitionBy()) * SHARE
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # the level if this source and all that fill later were below their caps, the earlier ones at them
    level = ((F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / F.sum("weight").over(rest))
    t = t.withColumns({"cap": cap, "total": total}).withColumn("level", level)
    # full sources come first in this order; the first that isn't full gives the level of all others
    free = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))
    common = F.first(free, ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return t.select("source", "source_size", "src", "weight", F.coalesce(
        F.least(F.col("cap"), common * F.col("weight")), F.col("cap")).alias("target"))


def _before(df: DataFrame, group: str, bucket: str, amount: Column) -> DataFrame:
    """group, bucket -> the sum of ``amount`` in the group's earlier buckets."""
    w = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return (df.groupBy(group, bucket).agg(F.sum(amount).alias("__in"))
            .select(group, bucket, F.coalesce(F.sum("__in").over(w), F.lit(0)).alias("__before")))


def laid_out(docs: DataFrame, src: DataFrame) -> DataFrame:
    """The rows with their source's ``src``, ``source_size`` and ``target`` and the place ``start``
    of their first word in the source's shuffled stream."""
    buckets = max(1, -(-docs.count() // BUCKET))
    rows = (docs.join(src, F.col("__source").eqNullSafe(src["source"]), "left").drop(src["source"])
            .withColumn("__b", F.pmod(F.shiftrightunsigned("__key", 20), F.lit(buckets))))
    run = (Window.partitionBy("src", "__b").orderBy("__key", "__id")
           .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.join(_before(rows, "src", "__b", F.col("__size")), ["src", "__b"])
            .withColumn("start", F.col("__before") + F.coalesce(F.sum("__size").over(run), F.lit(0)))
            .drop("__before", "__b"))


def points(kind: str = "golden") -> Column:
    """Point ``id`` of the sequence, from 0 up to 1."""
    if kind == "corput":  # the binary digits of id + 1 behind the point, in reverse order
        return (F.conv(F.rpad(F.reverse(F.bin(F.col("id") + 1)), 52, "0"), 2, 10).cast("double")
                / float(1 << 52))
    # frac((id + 0.5) * golden), in two parts to keep all digits for large ids
    high, low = F.shiftright("id", _SPLIT), F.pmod(F.col("id"), F.lit(1 << _SPLIT))
    return F.pmod(F.pmod(high * _GOLDEN_HIGH, F.lit(1.0)) + (low + 0.5) * GOLDEN, F.lit(1.0))


def needs(src: DataFrame, block: int) -> DataFrame:
    """The slots that each source needs, and the part ``lo`` to ``hi`` of all needs that is its own."""
    one = (src.where("source_size > 0")
           .select("src", "source_size", F.floor(F.col("target") + 0.5).alias("want"),
                   F.ceil(F.col("source_size") / block).alias("blocks"))
           .withColumn("need", F.expr("want div source_size") * F.col("blocks")
                       + F.ceil(F.pmod("want", "source_size") / block)).where("need > 0"))
    upto = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    return one.withColumn("hi", F.sum("need").over(upto)).withColumn("lo", F.col("hi") - F.col("need"))


def schedule(src: DataFrame, block: int, kind: str = "golden") -> DataFrame:
    """slot, src, use, block, words: what each slot of the mix takes, from the block's first word on.

    Points and sources meet in cells of ``CELL`` slots; every source is at least one slot wide, so a
    cell has few of either, however many sources there are.
    """
    spark = src.sparkSession
    need = C.written(needs(src, block), "op9-needs")
    n, count = need.agg(F.coalesce(F.sum("need"), F.lit(0)), F.count("*")).first()
    cells = need.withColumn("cell", F.explode(F.sequence(
        F.expr(f"lo div {CELL}"), F.expr(f"(hi - 1) div {CELL}"))))
    length = n + n // 64 + 16
    while True:
        x = F.least(F.floor(points(kind) * F.lit(float(n))), F.lit(max(n - 1, 0))).cast("bigint")
        at = spark.range(length if n else 0).withColumn("x", x).withColumn("cell", F.expr(f"x div {CELL}"))
        slots = (at.join(cells, "cell").where("x >= lo and x < hi")
                 .withColumn("__b", F.floor(F.col("id") / BUCKET)))
        met = slots.groupBy("src", "need").agg(F.count("*").alias("c")).where("c >= need").count()
        if met == count:
            break
        length *= 2
    rank = Window.partitionBy("src", "__b").orderBy("id")
    ranked = (slots.join(_before(slots, "src", "__b", F.lit(1)), ["src", "__b"])
              .withColumn("rank", F.col("__before") + F.row_number().over(rank) - 1).where("rank < need")
              .withColumns({"use": F.expr("rank div blocks"), "block": F.pmod("rank", "blocks")}))
    words = F.least(F.lit(block), F.col("source_size") - F.col("block") * block,
                    F.col("want") - F.col("use") * F.col("source_size") - F.col("block") * block)
    return ranked.select(F.col("id").alias("slot"), "src", "use", "block", words.alias("words"))


def takings(docs: DataFrame, block: int = BLOCK_WORDS, kind: str = "golden") -> DataFrame:
    """One row per row of ``docs``: doc_id, key (hash of id and text), size, source_size, target,
    taken, and for each copy of the document in the mix ``copies``, its words from the first on
    (blocks are taken in stream order, so a cut copy is a beginning), and ``slots``, its place."""
    text = F.col("text").cast("string")
    narrow = C.written(docs.select(
        size_of(text).alias("__size"), F.col("source").cast("string").alias("__source"),
        F.col("doc_id").cast("bigint").alias("__id"), key_of().alias("__key")), "op9-sizes")
    sizes = narrow.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size"))
    src = C.written(targets(sizes), "op9-targets")
    of_use = lambda c: F.array(*(F.max(F.when(F.col("use") == e, F.col(c))) for e in range(int(MOST))))
    uses = schedule(src, block, kind).groupBy("src", "block").agg(
        of_use("words").alias("uses"), of_use("slot").alias("at"))
    C.tidy(docs.sparkSession)
    flat = laid_out(narrow, src)
    blocks = F.sequence(F.floor(F.col("start") / block),
                        F.floor((F.col("start") + F.col("__size") - 1) / block))
    pieces = (flat.where("__size > 0").withColumn("block", F.explode(blocks))
              .join(uses, ["src", "block"]))
    first = F.col("block") * block

    def words(e: int) -> Column:
        last = F.least(first + F.coalesce(F.col("uses")[e], F.lit(0)), F.col("start") + F.col("__size"))
        return F.greatest(last - F.greatest(first, F.col("start")), F.lit(0))

    copies = F.array(*(F.sum(words(e)) for e in range(int(MOST))))
    got = pieces.groupBy("src", "start").agg(copies.alias("copies"), F.min(F.struct("block", "at")).alias("first"))
    full = flat.where("__size > 0").join(got, ["src", "start"], "left")
    empty = flat.where("__size = 0").withColumns({
        "copies": F.lit(None).cast("array<bigint>"),
        "first": F.lit(None).cast("struct<block:bigint,at:array<bigint>>")})
    taken = F.aggregate(F.coalesce("copies", F.array().cast("array<bigint>")), F.lit(0).cast("bigint"),
                        lambda a, x: a + x)
    return full.unionByName(empty).select(
        F.col("__id").alias("doc_id"), F.col("__key").alias("key"), F.col("__size").alias("size"),
        "source_size", "target", taken.alias("taken"), "copies", F.col("first.at").alias("slots"), "start")


def key_of() -> Column:
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.lit(9))


def mixed(docs: DataFrame, block: int = BLOCK_WORDS, kind: str = "golden", slot: str | None = None) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per copy, in the order of the slots (of one
    slot: in stream order), which ``slot`` names a column for.  A whole copy keeps its text; a cut one
    has its first words joined by one space, and its n_chars.  Rows alike in id and text all get the
    copies of the first of them."""
    p = C.prefix(docs)
    own = {c: f"{p}{c}" for c in ("id", "key", "t", "c")}
    took = (takings(docs, block, kind).where("taken > 0").groupBy("doc_id", "key")
            .agg(F.min_by(F.struct("size", "start", F.arrays_zip("copies", "slots").alias("copies")), "start")
                 .alias(own["t"]))
            .select(F.col("doc_id").alias(own["id"]), F.col("key").alias(own["key"]), own["t"]))
    rows = docs.join(took, F.col("doc_id").cast("bigint").eqNullSafe(F.col(own["id"]))
                     & (key_of() == F.col(own["key"])))
    rows = rows.withColumn(own["c"], F.explode(f"{own['t']}.copies"))
    n, whole = F.col(f"{own['c']}.copies"), F.col(f"{own['c']}.copies") == F.col(f"{own['t']}.size")
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), n.cast("int")), " ")
    new = {"text": F.when(whole, F.col("text")).otherwise(cut),
           "n_chars": F.when(whole, F.col("n_chars")).otherwise(F.char_length(cut).cast("bigint"))
           if "n_chars" in docs.columns else None}
    place, start = F.col(f"{own['c']}.slots"), F.col(f"{own['t']}.start")
    # range partitions of the slots, sorted: read one after the other, the files are the mix
    parts = rows.where(n > 0).repartitionByRange(place, start, own["id"]).sortWithinPartitions(place, start, own["id"])
    return parts.select(*[(new[c] if c in new else F.col(c)).alias(c) for c in docs.columns],
                        *([place.alias(slot)] if slot else []))
