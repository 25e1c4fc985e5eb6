r"""Benchmark decontamination by training suffix arrays (operator 6).

Texts are lower-cased (A-Z) and cut into words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.  Each task
holds shards of training documents; for a shard it builds a suffix array over word ids and
binary-searches every suffix of the test items in it.  All test suffixes are searched at once:
the first words through packed keys, then one more word per step inside the interval found so
far.  The interval at window depth gives all locations of that window, the deepest one the
longest verbatim match.

Test items travel to the tasks in blocks of at most ``BLOCK_BYTES`` of text, so what is broadcast
is bounded whatever the benchmark's size; with more blocks the documents are searched once per
block and the hits are united.  Documents are never shuffled for the search.  Suffixes that start
with a word that no test item of the block has cannot match and are left out of the array.

Defined cases: a null text has no words; an item of fewer than ``window`` words, but not none, is
one window; a null item_id counts as the empty string; repeated rows are judged alike; a document
or benchmark table without rows gives no rows, or no hits.  Only doc_id, text, item_id are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm import common as C

WINDOW = 10
CHUNK = 2 << 20
BLOCK_BYTES = 4 << 20
_BITS = 21


class TestBlock:
    """Items of a benchmark: word ids (by sorted distinct word hash), and every suffix."""

    def __init__(self, ids: list[str], texts: list[str], window: int = WINDOW):
        col = pa.array(texts, pa.large_string())
        self.items = ids
        parts, counts = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
        for c in C.chunks(col):
            h, first = lowered_words(c.buf, c.off)
            parts.append(h)
            counts.append(np.diff(first))
        words, counts = np.concatenate(parts), np.concatenate(counts)
        self.vocab, word = np.unique(words, return_inverse=True)
        # word ids in packed keys: three to a key, or two if there are too many for that
        self.packed, self.bits = (3, _BITS) if len(self.vocab) < (1 << _BITS) - 1 else (2, 31)
        self.longest = int(counts.max(initial=0))
        # one end mark after each item, and some spare ones to read beyond the last
        item = np.repeat(np.arange(len(counts)), counts)
        self.seq = np.full(len(words) + len(counts) + 4, -1, dtype=np.int64)
        self.suffix = np.arange(len(words)) + item
        self.seq[self.suffix] = word
        self.item = item
        ends = np.cumsum(counts)
        self.offset = np.arange(len(words)) - (ends - counts)[item]
        self.left = ends[item] - np.arange(len(words))  # words from here to the item's end
        self.depth = np.minimum(counts, window)[item]  # window length of the suffix's item

    def ids_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocab):
            return np.full(len(hashes), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        return np.where(self.vocab[at] == hashes, at, -1)


def lowered_words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words and the first word of each row."""
    low = C.LOWER[buf]
    s, e, first = C.word_spans(low, off, C.ALNUM_LOWER)
    return C.span_hashes(low, s, e), first


def _pack(seq: np.ndarray, at: np.ndarray, block: TestBlock) -> np.ndarray:
    key = seq[at] + 1
    for i in range(1, block.packed):
        key = (key << block.bits) | (seq[at + i] + 1)
    return key


class Shard:
    """A suffix array over the words of some documents, deep enough for the block's items."""

    def __init__(self, words: np.ndarray, first: np.ndarray, block: TestBlock):
        row = C.rows_of_words(first)
        at = np.arange(len(words)) + row
        self.seq = np.full(len(words) + len(first) + 4, -1, dtype=np.int64)
        self.seq[at] = block.ids_of(words)
        self.word = np.zeros(len(self.seq), dtype=np.int64)  # place in seq -> word index
        self.word[at] = np.arange(len(words))
        self.row = row
        at = at[self.seq[at] >= 0]
        key = _pack(self.seq, at, block)
        order = np.argsort(key)
        self.sa, self.key = at[order], key[order]
        self._refine(block)

    def _refine(self, block: TestBlock) -> None:
        """Prefix doubling: sort suffixes that agree so far by the rank of what follows."""
        new = np.ones(len(self.sa), dtype=bool)
        new[1:] = self.key[1:] != self.key[:-1]
        group = np.cumsum(new)
        rank = np.zeros(len(self.seq) + block.longest + 8, dtype=np.int64)
        rank[self.sa] = group
        done = (self.key & ((1 << block.bits) - 1)) == 0  # ends within the packed words
        k = block.packed
        while k < block.longest:
            size = np.bincount(group)
            tied = np.flatnonzero((size[group] > 1) & ~done)
            if not len(tied):
                break
            follow = rank[self.sa[tied] + k]
            order = np.lexsort((follow, group[tied]))
            self.sa[tied] = self.sa[tied][order]
            g, follow = group[tied], follow[order]
            fresh = np.zeros(len(self.sa), dtype=bool)
            fresh[np.flatnonzero(np.diff(group, prepend=0))] = True
            fresh[tied[1:]] |= (g[1:] == g[:-1]) & (follow[1:] != follow[:-1])
            done[tied] = follow == 0
            group = np.cumsum(fresh)
            rank[self.sa] = group
            k *= 2

    def _bound(self, lo: np.ndarray, hi: np.ndarray, d: int, target: np.ndarray, after: bool) -> np.ndarray:
        """First place in [lo, hi) whose d-th word is not below (``after``: is above) the target."""
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            v = self.seq[self.sa[mid] + d]
            go = v <= target[open_] if after else v < target[open_]
            lo[open_] = np.where(go, mid + 1, lo[open_])
            hi[open_] = np.where(go, hi[open_], mid)

    def search(self, block: TestBlock):
        """For every test suffix: its interval at window depth (empty if there is none), the length
        of its longest match, and the interval of that match."""
        n = len(block.suffix)
        wlo, whi, best = (np.zeros(n, dtype=np.int64) for _ in range(3))
        blo, bhi = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        act = np.arange(n)
        lo, hi = np.zeros(n, dtype=np.int64), np.full(n, len(self.sa), dtype=np.int64)
        # packed start: only for suffixes of as many words as a key holds, or more
        key = _pack(block.seq, block.suffix, block)
        plo, phi = np.searchsorted(self.key, key), np.searchsorted(self.key, key, side="right")
        skip = (block.left >= block.packed) & (block.depth >= block.packed)
        lo[skip], hi[skip] = plo[skip], phi[skip]
        best[skip & (phi > plo)] = block.packed
        d = np.where(skip, block.packed, 0)
        alive = hi > lo
        act, lo, hi, d = act[alive], lo[alive], hi[alive], d[alive]
        blo[act], bhi[act] = lo, hi
        while len(act):
            at = d == block.depth[act]
            wlo[act[at]], whi[act[at]] = lo[at], hi[at]
            more = d < block.left[act]
            act, lo, hi, d = act[more], lo[more], hi[more], d[more]
            out_lo, out_hi = lo.copy(), hi.copy()
            for depth in np.unique(d):
                m = d == depth
                target = block.seq[block.suffix[act[m]] + depth]
                out_lo[m] = self._bound(lo[m], hi[m], depth, target, after=False)
                out_hi[m] = self._bound(out_lo[m], hi[m], depth, target, after=True)
            found = out_hi > out_lo
            act, lo, hi, d = act[found], out_lo[found], out_hi[found], d[found] + 1
            best[act], blo[act], bhi[act] = d, lo, hi
        return wlo, whi, best, blo, bhi


def shard_hits(c: C.Chunk, block: TestBlock):
    """Words per row, hit word indices (row-relative, as lists with bounds) and items per row."""
    words, first = lowered_words(c.buf, c.off)
    shard = Shard(words, first, block)
    wlo, whi, *_ = shard.search(block)
    # suffixes too short for their window have no interval at its depth; equal windows share one
    full = np.flatnonzero((whi > wlo) & (block.left >= block.depth))
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    pairs = [np.zeros((0, 2), dtype=np.int64)]
    if len(full):
        spans, window = np.unique(np.stack([wlo[full], whi[full], block.depth[full]], axis=1), axis=0,
                                  return_inverse=True)
        window = window.ravel()
        size = spans[:, 1] - spans[:, 0]
        which = np.repeat(np.arange(len(spans)), size)
        place = np.repeat(spans[:, 0] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        at = shard.word[shard.sa[place]]
        np.add.at(edge, at, 1)
        np.add.at(edge, at + spans[which, 2], -1)
        # rows of each window, then the items that have it
        rw = np.unique(np.stack([which, shard.row[at]], axis=1), axis=0)
        wi = np.unique(np.stack([window, block.item[full]], axis=1), axis=0)
        a, z = np.searchsorted(wi[:, 0], rw[:, 0]), np.searchsorted(wi[:, 0], rw[:, 0], side="right")
        n = z - a
        item = wi[np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()), 1]
        pairs.append(np.unique(np.stack([np.repeat(rw[:, 1], n), item], axis=1), axis=0))
    hit = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    pairs = np.concatenate(pairs)
    rows = np.arange(c.rows + 1)
    hit_bounds = np.searchsorted(hit, first)
    return (np.diff(first), hit - first[shard.row[hit]], hit_bounds,
            pairs[:, 1], np.searchsorted(pairs[:, 0], rows))


def _search(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        names = np.array(block.items, dtype=object)
        for b in batches:
            for c in C.chunks(b.column("text"), CHUNK):
                n, hits, hb, items, ib = shard_hits(c, block)
                part = b.slice(c.lo, c.rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(n, pa.int64()),
                     C.lists(hits, hb, pa.int32()), C.lists(names[items], ib, pa.string())],
                    names=["doc_id", "key", "n_words", "hits", "items"])
    return run


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, window: int = WINDOW) -> Iterator[TestBlock]:
    """The items in blocks of about ``block_bytes`` of text.  A block is all of the benchmark that
    the driver ever holds."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // block_bytes))
    for i in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()
        yield TestBlock([r["item_id"] for r in rows], [r["text"] for r in rows], window)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, ``hits`` (word indices inside any occurrence of
    a window) and ``items`` (items with an occurring window)."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    schema = "doc_id bigint, key bigint, n_words bigint, hits array<int>, items array<string>"
    passes = [rows.mapInArrow(_search(sc.broadcast(b)), schema) for b in blocks(benchmark, block_bytes, window)]
    if len(passes) == 1:
        return passes[0].drop("key")
    # one row per row and block: unite the blocks, then restore rows alike in id and text
    one = passes[0]
    for p in passes[1:]:
        one = one.unionByName(p)
    found = one.groupBy("doc_id", "key").agg(
        F.max("n_words").alias("n_words"), (F.count("*") / len(passes)).cast("int").alias("times"),
        F.array_distinct(F.flatten(F.collect_set("hits"))).alias("hits"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    return found.withColumn("times", F.explode(F.sequence(F.lit(1), "times"))).drop("key", "times")


def longest_matches(docs: DataFrame, benchmark: DataFrame, least: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Longest verbatim matches: item_id, offset, length (words), doc_id and start (word index) of
    every location of the longest match of each test suffix that has ``least`` words or more."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run_with(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            for b in batches:
                for c in C.chunks(b.column("text"), CHUNK):
                    words, first = lowered_words(c.buf, c.off)
                    shard = Shard(words, first, block)
                    _, _, best, lo, hi = shard.search(block)
                    at = np.flatnonzero(best >= least)
                    size = (hi - lo)[at]
                    which = np.repeat(at, size)
                    place = (np.repeat(lo[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
                             + np.arange(size.sum())) if len(at) else which
                    word = shard.word[shard.sa[place]]
                    row = shard.row[word]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.items[i] for i in block.item[which]], pa.string()),
                         pa.array(block.offset[which], pa.int64()), pa.array(best[which], pa.int64()),
                         b.column("doc_id").slice(c.lo, c.rows).take(pa.array(row)),
                         pa.array(word - first[row], pa.int64())],
                        names=["item_id", "offset", "length", "doc_id", "start"])
        return run

    found = None
    for b in blocks(benchmark, block_bytes):
        part = rows.mapInArrow(run_with(sc.broadcast(b)),
                               "item_id string, offset bigint, length bigint, doc_id bigint, start bigint")
        found = part if found is None else found.unionByName(part)
    top = found.groupBy("item_id", "offset").agg(F.max("length").alias("length"))
    return found.join(top, ["item_id", "offset", "length"])


def stage(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: the rows without any hit, unchanged.  A row is known by a hash of its
    doc_id and text, as ids may be null or shared."""
    bad = f"{C.prefix(docs)}bad"
    key = C.row_key([F.col("doc_id").cast("bigint"), F.col("text").cast("string")])
    gone = (contamination(docs.select(key.alias("doc_id"), "text"), benchmark).where(F.size("hits") > 0)
            .select(F.col("doc_id").alias(bad)).distinct())
    return docs.join(gone, key == F.col(bad), "left_anti")
