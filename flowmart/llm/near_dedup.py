r"""Near-duplicate detection by MinHash with tensored banding (operator 4).

Texts are lower-cased (A-Z); words are ``[^\x20\x09-\x0D]+``; a document's set holds the hashes of
its distinct ``k``-word shingles (the whole sequence if it has fewer words).  Two documents are
linked if their sets have a Jaccard similarity of ``percent`` % or more.

Tensored banding: two small collections of ``KEYS`` keys each, a key being ``ROWS`` minhashes;
a table key combines one key of each collection, so KEYS^2 tables of 2 * ROWS minhashes come from
2 * KEYS * ROWS minhashes instead of KEYS^2 * 2 * ROWS.  A pair of similarity s shares a table
with probability (1 - (1 - s^ROWS)^KEYS)^2: 0.9996 at 0.8, 0.99997 at 0.85.

Candidates are confirmed on the full sets.  Documents with equal sets are one node from the start,
so a group of copies costs one row.  A node enters only the tables whose two keys it shares, each
for itself, with some other node; most nodes share none.  Not all pairs of a table bucket are made.
First each member is compared with its bucket's centre (the least node), and the components of
these links are found.  Members of buckets that still hold several components go to an exact join
by prefix filter: with shingles ordered from rare to common, two sets of the wanted similarity share
one of their first (1 - percent) * size + 1 shingles, and its places bound their overlap.  Shingles of
a passage that many texts share come last, so they make no pairs; pairs inside a component are passed
over, as a link there changes nothing.  The links that this adds join components, few by then.

Nodes are sums of 64-bit hashes of the set with its size.  A document without words has an empty
set and is linked with nothing; null counts as empty text; rows alike are one node; the component
of a row is the smallest doc_id reachable (null if all are null); an empty table gives an empty
result.  Only doc_id and text are read.  The stage keeps one row of each group, also of groups whose
ids are all null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from flowmart.llm import common as C

SHINGLE = 5
PERCENT = 80
ROWS = 4
KEYS = 16

_SIGNED = "doc_id bigint, key bigint, n_shingles bigint, node bigint, a array<bigint>, b array<bigint>"


def shingles(c: C.Chunk, k: int):
    """Shingle hashes of all rows (not distinct), and each one's row."""
    low = C.LOWER[c.buf]
    s, e, first = C.word_spans(low, c.off, C.NON_SPACE)
    word = C.span_hashes(low, s, e)
    row = C.rows_of_words(first)
    start, h = C.window_hashes(word, row, k)
    at = row[start]
    n = np.diff(first)
    for r in np.flatnonzero((n > 0) & (n < k)):  # the whole sequence of a short text is one shingle
        _, one = C.window_hashes(word[first[r]:first[r + 1]], row[first[r]:first[r + 1]], n[r])
        place = np.searchsorted(at, r)
        h = np.insert(h, place, one)
        at = np.insert(at, place, r)
    return h, at


def distinct(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A mask of one occurrence of each hash in each row."""
    with np.errstate(over="ignore"):
        key = h ^ C.mix64(at.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    new = np.ones(len(h), dtype=bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    mask = np.zeros(len(h), dtype=bool)
    mask[order[new]] = True
    return mask


def _short(c: C.Chunk, k: int):
    h, at = shingles(c, k)
    m = distinct(h, at)
    h, at = h[m], at[m]
    bounds = np.searchsorted(at, np.arange(c.rows + 1))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(h) + 1, dtype=np.uint64)
        np.cumsum(C.mix64(h ^ np.uint64(0x5DEECE66D)), out=sums[1:])
        n = np.diff(bounds)
        node = C.mix64(sums[bounds[1:]] - sums[bounds[:-1]] + n.astype(np.uint64)).view(np.int64)
    return h, bounds, n, node


def _sign(k: int, keys: int, per_key: int):
    mult = C.seeds(2 * keys * per_key, 41) | np.uint64(1)
    salt = C.seeds(2 * keys, 43)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in C.chunks(batch.column("text")):
                h, bounds, n, node = _short(c, k)
                full = np.flatnonzero(n)
                sig = np.zeros((len(full), 2 * keys), dtype=np.uint64)
                with np.errstate(over="ignore"):
                    if len(full):
                        for i in range(2 * keys):
                            acc = np.full(len(full), salt[i], dtype=np.uint64)
                            for m in mult[i * per_key:(i + 1) * per_key]:
                                acc = C.mix64(acc ^ np.minimum.reduceat(h * m, bounds[full]))
                            sig[:, i] = acc
                lists = np.zeros(c.rows + 1, dtype=np.int64)
                lists[full + 1] = keys
                lists = np.cumsum(lists)
                own = [name for name in batch.schema.names if name != "text"]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name).slice(c.lo, c.rows) for name in own), pa.array(n, pa.int64()),
                     pa.array(node), C.lists(sig[:, :keys].ravel().view(np.int64), lists, pa.int64()),
                     C.lists(sig[:, keys:].ravel().view(np.int64), lists, pa.int64())],
                    names=[*own, "n_shingles", "node", "a", "b"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in C.chunks(batch.column("text")):
                h, bounds, _, node = _short(c, k)
                data = [np.sort(h[bounds[i]:bounds[i + 1]]).tobytes() for i in range(c.rows)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node), pa.array(data, pa.binary())], names=["node", "hashes"])
    return run


def _confirm(percent: int):
    """Rows with the sets ``x`` and ``y`` -> those that are similar enough, without the sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column("x"), b.column("y")):
                p, q = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[at] == p).sum())
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield b.select([c for c in b.schema.names if c not in "xy"]).filter(pa.array(keep, pa.bool_()))
    return run


def _star(e: DataFrame) -> DataFrame:
    """One large-star and one small-star step."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = (both.join(low, "u").where("v > u and v <> m")
             .select(F.col("v").alias("u"), F.col("m").alias("v")))
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    return (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a written table, with their number and a sum of their hashes."""
    seen, h = Observation(), F.xxhash64("u", "v")
    table = C.written(edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.shiftright(h, 20)).alias("high"),
                                    F.sum(F.pmod(h, F.lit(1 << 40))).alias("low")), "op4-edges")
    return table, tuple(seen.get.get(c) for c in ("n", "high", "low"))


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the least node reachable) of every node of an edge table (u, v), by alternating
    large-star and small-star steps, until nothing changes."""
    e, mark = _marked(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while mark[0]:
        nxt, new = _marked(_star(e))
        C.drop(e)
        e, same, mark = nxt, new == mark, new
        if same:  # the same edges: stars around least nodes
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _table_keys() -> Column:
    """All combinations of one key of either collection."""
    return F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))


def _shared_keys(nodes: DataFrame) -> DataFrame:
    """node, n and its keys ``a`` and ``b`` that some other node has as well, if there are some of both."""
    side = lambda c, i: F.transform(c, lambda x: F.struct(F.lit(i).alias("side"), x.alias("x")))
    keys = nodes.select("node", F.col("n_shingles").alias("n"),
                        F.explode(F.concat(side("a", 0), side("b", 1))).alias("k")).select("node", "n", "k.*")
    shared = keys.groupBy("side", "x").agg(F.count("*").alias("c")).where("c > 1").select("side", "x")
    own = lambda i: F.collect_list(F.when(F.col("side") == i, F.col("x")))
    return (keys.join(shared, ["side", "x"]).groupBy("node", "n").agg(own(0).alias("a"), own(1).alias("b"))
            .where("size(a) > 0 and size(b) > 0"))


def classes(signed: DataFrame, docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The components of the nodes by their confirmed links, in two tables (node, comp): nodes to
    components of the first links, and those to whole components.  Nodes that are in neither are alone."""
    nodes = (signed.where("n_shingles > 0").groupBy("node", "n_shingles")
             .agg(F.min(_order()).alias("one"), F.first("a").alias("a"), F.first("b").alias("b")))
    nodes = C.written(nodes, "op4-nodes")
    keys = C.written(_shared_keys(nodes), "op4-keys")
    tables = keys.select("node", "n", F.explode(F.array_distinct(_table_keys())).alias("x"))
    buckets = (tables.groupBy("x").agg(F.count("*").alias("c"), F.min(F.struct("node", "n")).alias("centre"))
               .where("c > 1").select("x", F.col("centre.node").alias("u"), F.col("centre.n").alias("m")))
    members = C.written(tables.join(buckets, "x"), "op4-members")

    wanted = members.select("node").distinct()
    # one row of each node, known by id and key as ids may be null or shared
    source = (nodes.join(wanted, "node")
              .select(F.col("one.doc_id").alias("__d"), F.col("one.key").alias("__k")).distinct())
    texts = docs.join(source, F.col("doc_id").eqNullSafe(F.col("__d"))
                      & (F.col("key") == F.col("__k")), "left_semi")
    sets = texts.select("text").mapInArrow(_sets(k), "node bigint, hashes binary")
    sets = C.written(sets.dropDuplicates(["node"]), "op4-sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The rows of ``pairs`` (u, v, n, m and others) that are links, without the sizes."""
        near = pairs.where(F.least("n", "m") * 100 >= F.greatest("n", "m") * percent).drop("n", "m")
        out = near.join(sets.select(F.col("node").alias("u"), F.col("hashes").alias("x")), "u").join(
            sets.select(F.col("node").alias("v"), F.col("hashes").alias("y")), "v")
        return out.mapInArrow(_confirm(percent), ", ".join(f"{c} bigint" for c in out.columns if c not in "xy"))

    C.tidy(docs.sparkSession)
    first = components(confirmed(members.where("node <> u").select("u", F.col("node").alias("v"), "n", "m").distinct()))

    C.tidy(docs.sparkSession)

    # members of buckets that hold several components
    at = (members.select("x", "node", "n").join(first, "node", "left")
          .withColumn("comp", F.coalesce("comp", "node")))
    open_ = at.groupBy("x").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2")
    rest = C.written(at.join(open_.select("x"), "x", "left_semi").select("node", "n", "comp").distinct(), "op4-rest")
    more, used = prefix_pairs(rest, sets, percent)
    C.tidy(docs.sparkSession)
    joined = confirmed(more).select(F.col("u_comp").alias("u"), F.col("v_comp").alias("v"))
    second = components(joined)
    for t in (nodes, keys, members, sets, rest, *used):
        C.drop(t)
    C.tidy(docs.sparkSession)
    return first, second


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            h = np.frombuffer(b.column("hashes")[i].as_buffer(), dtype=np.int64)
            same = [pa.array(np.full(len(h), b.column(c)[i].as_py())) for c in ("node", "n", "comp")]
            yield pa.RecordBatch.from_arrays([*same, pa.array(h)], names=["node", "n", "comp", "h"])


def prefix_pairs(rest: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """All pairs (u, v, n, m, u_comp, v_comp) of nodes of ``rest`` (node, n, comp) in different
    components that can reach the similarity, by prefix filter with length and place bounds: exact,
    none is missed.  Also the tables that were written for it."""
    rows = (rest.join(sets, "node").select("node", "n", "comp", "hashes")
            .mapInArrow(_shingle_rows, "node bigint, n bigint, comp bigint, h bigint"))
    rows = C.written(rows, "op4-shingles")
    shared = rows.groupBy("h").agg(F.count("*").alias("f")).where("f > 1")
    # a set's unshared shingles come first; they use up places of its prefix
    own = Window.partitionBy("node").orderBy("f", "h")
    all_of = Window.partitionBy("node")
    place = F.row_number().over(own) + F.col("n") - F.count("*").over(all_of)
    first = (rows.join(shared, "h").withColumn("p", place)
             .where(F.col("p") <= F.col("n") - F.ceil(F.col("n") * percent / F.lit(100.0) - 1e-9) + 1))
    first = C.written(first.select("h", "node", "n", "comp", "p"), "op4-prefixes")
    other = first.select("h", F.col("node").alias("v"), F.col("n").alias("m"),
                         F.col("comp").alias("v_comp"), F.col("p").alias("q"))
    # of n + m shingles, 100 * both >= percent * (n + m - both) must be in both sets
    need = f"({percent} * (n + m)) / {100.0 + percent} - 1e-9"
    pairs = (first.withColumnRenamed("node", "u").withColumnRenamed("comp", "u_comp").join(other, "h")
             .where(F.expr(f"u < v and u_comp <> v_comp and least(n, m) * 100 >= greatest(n, m) * {percent} "
                           f"and least(n - p, m - q) + 1 >= {need}"))
             .select("u", "v", "n", "m", "u_comp", "v_comp").distinct())
    return pairs, [rows, first]


def _keyed(docs: DataFrame, key: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), key.alias("key"))


def _order() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "key")


def _grouped(rows: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, text, key) signed, and for every node with words the ``first`` row of its
    component: the least by doc_id (null last), then key."""
    signed = C.written(rows.mapInArrow(_sign(k, KEYS, ROWS), _SIGNED), "op4-signed")
    first, second = classes(signed, rows, k, percent)
    least = (signed.where("n_shingles > 0").groupBy("node").agg(F.min(_order()).alias("least"))
             .join(first, "node", "left").withColumn("comp", F.coalesce("comp", "node")))
    whole = second.select(F.col("node").alias("comp"), F.col("comp").alias("whole"))
    least = least.join(whole, "comp", "left").withColumn("whole", F.coalesce("whole", "comp"))
    smallest = least.groupBy("whole").agg(F.min("least").alias("first"))
    return signed, least.join(smallest, "whole").select("node", "first")


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    signed, of_node = _grouped(_keyed(docs, F.xxhash64(F.col("text").cast("string"))), k, percent)
    full = signed.where("n_shingles > 0").select("doc_id", "n_shingles", "node").join(
        of_node.select("node", F.col("first.doc_id").alias("component_id")), "node")
    empty = signed.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    out = ["doc_id", "n_shingles", "component_id"]
    return (full.select(*out).unionByName(empty.select(*out))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def stage(docs: DataFrame) -> DataFrame:
    """Pipeline stage: one row of each group, unchanged: the one with the smallest doc_id (null
    last), then the smallest hash of the row; of rows alike in all columns any one.  Rows without
    words all stay."""
    gone, again = (f"{C.prefix(docs)}{c}" for c in ("gone", "again"))
    key = C.row_key([F.col("doc_id").cast("bigint"), *(
        F.col(f.name) for f in docs.schema if f.name != "doc_id"
        and not any(t in f.dataType.simpleString() for t in ("map<", "variant")))])  # these have no hash
    signed, of_node = _grouped(_keyed(docs, key), SHINGLE, PERCENT)
    rows = (signed.where("n_shingles > 0").select("key", "node").join(of_node, "node")
            .groupBy("key", (F.col("key") == F.col("first.key")).alias("kept")).agg(F.count("*").alias("n")))
    rows = C.written(rows.where("not kept or n > 1"), "op4-rows")
    left = docs.join(rows.where(~F.col("kept")).select(F.col("key").alias(gone)), key == F.col(gone), "left_anti")
    more = rows.where("kept").select(F.col("key").alias(again))
    if not more.head(1):
        return left
    same = key == F.col(again)
    once = (left.join(more, same, "left_semi").withColumn(again, key).dropDuplicates([again]).drop(again))
    return left.join(more, same, "left_anti").unionByName(once)
