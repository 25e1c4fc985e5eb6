r"""Substring de-duplication by Rabin-Karp window hashes (operator 10).

Words are ``[^\x20\x09-\x0D]+``.  Every window of ``k`` consecutive words of a document gets a
rolling polynomial hash over its word hashes.  The hashes of all windows are counted across the
corpus; a window seen more than once is repeated, and overlapping repeated windows merge into
maximal intervals of words, which are removed.

How the count runs.  Documents are first written as chunks (compressed texts of some rows, one
table row each).  Each chunk sends every distinct window hash once, as one packed row per hash
bucket, so a passage that a third of all documents share is combined before the shuffle.  A
bucket's task sorts its hashes and answers every chunk with one bit per hash: seen elsewhere or
not.  The answers meet their chunk again, which turns them into intervals.  A window moves as
8 bytes out and 1 bit back; texts move once.  The number of buckets follows the number of words,
so a task's share stays the same at any size.

Two windows count as equal if 64 hash bits and their bucket (an independent hash) agree.

Defined cases: a null text has no words and keeps the empty text; a text of fewer than ``k`` words
has no window; repeated rows are documents of their own, so all their windows are repeated; an
empty table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm import common as C

WINDOW = 35
CHUNK = 4 << 20
#: windows that one bucket should hold
BUCKET_WINDOWS = 4_000_000

_CHUNKS = "chunk bigint, ids array<bigint>, lengths array<int>, words bigint, texts binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows -> chunks.  Texts are joined with a newline after each."""
    zip_ = zstandard.ZstdCompressor(level=1)
    for b in batches:
        ids = b.column("doc_id")
        for c in C.chunks(b.column("text"), CHUNK):
            data = np.insert(c.buf, c.off[1:], 10).tobytes()
            _, _, first = C.word_spans(c.buf, c.off, C.NON_SPACE)
            name = hashlib.blake2b(data, digest_size=8, key=repr(ids[c.lo].as_py()).encode()).digest()
            yield pa.RecordBatch.from_arrays([
                pa.array([int.from_bytes(name, "little", signed=True)], pa.int64()),
                C.lists(ids.slice(c.lo, c.rows), np.array([0, c.rows]), pa.int64()),
                C.lists(np.diff(c.off), np.array([0, c.rows]), pa.int32()),
                pa.array([int(first[-1])], pa.int64()),
                pa.array([zip_.compress(data)], pa.binary())],
                names=["chunk", "ids", "lengths", "words", "texts"])


class Windows:
    """The windows of a chunk, and the order in which their distinct hashes travel."""

    def __init__(self, lengths: np.ndarray, texts: bytes, k: int, buckets: int):
        size = int(lengths.sum()) + len(lengths)
        data = zstandard.ZstdDecompressor().decompress(texts, max_output_size=size)
        self.buf = np.frombuffer(data, dtype=np.uint8).copy()
        self.off = np.zeros(len(lengths) + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=self.off[1:])
        self.s, self.e, self.first = C.word_spans(self.buf, self.off, C.NON_SPACE)
        row = C.rows_of_words(self.first)
        word = C.span_hashes(self.buf, self.s, self.e)
        self.start, h = C.window_hashes(word, row, k)
        _, other = C.window_hashes(C.mix64(word), row, k)
        order = np.argsort(h)
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[order[1:]] != h[order[:-1]]
        group = np.cumsum(new) - 1
        lead = order[new]
        self.count = np.bincount(group, minlength=len(lead))
        bucket = ((other[lead] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        sent = np.argsort(bucket, kind="stable")
        self.bounds = np.searchsorted(bucket[sent], np.arange(buckets + 1))
        self.hashes = h[lead][sent]
        place = np.empty(len(lead), dtype=np.int64)
        place[sent] = np.arange(len(lead))
        self.place = np.empty(len(h), dtype=np.int64)  # window -> its hash in travel order
        self.place[order] = place[group]
        self.here = np.empty(len(lead), dtype=bool)  # seen more than once in this chunk
        self.here[place] = self.count > 1


def _send(k: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                w = Windows(b.column("lengths")[row].values.to_numpy(), b.column("texts")[row].as_py(),
                            k, buckets)
                full = np.flatnonzero(np.diff(w.bounds))
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int32()),
                    pa.array(np.full(len(full), b.column("chunk")[row].as_py()), pa.int64()),
                    pa.array([w.hashes[w.bounds[i]:w.bounds[i + 1]].tobytes() for i in full], pa.binary())],
                    names=["bucket", "chunk", "data"])
    return run


def _answer(table: pa.Table) -> pa.Table:
    """A bucket's hashes -> per chunk, which of them came from two chunks or more."""
    blobs = [np.frombuffer(v, dtype=np.uint64) for v in
             (x.as_buffer() for x in table.column("data"))]
    both = np.sort(np.concatenate(blobs))
    twice = both[1:][both[1:] == both[:-1]]
    bits = []
    for h in blobs:
        at = np.searchsorted(twice, h)
        hit = np.zeros(len(h), dtype=bool)
        inside = at < len(twice)
        hit[inside] = twice[at[inside]] == h[inside]
        bits.append(np.packbits(hit).tobytes())
    return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"),
                     "data": pa.array(bits, pa.binary())})


def _remove(k: int, buckets: int):
    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"doc_id": [], "n_words": [], "n_removed": [], "kept": []}
        for row in range(chunk.num_rows):
            w = Windows(chunk.column("lengths")[row].values.to_numpy(),
                        chunk.column("texts")[row].as_py(), k, buckets)
            hit = w.here.copy()
            for i, data in zip(answers.column("bucket").to_pylist(), answers.column("data").to_pylist()):
                lo, hi = w.bounds[i], w.bounds[i + 1]
                hit[lo:hi] |= np.unpackbits(np.frombuffer(data, np.uint8), count=hi - lo).astype(bool)
            start = w.start[hit[w.place]]
            edge = np.zeros(len(w.s) + 1, dtype=np.int32)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + k, -1)
            gone = np.cumsum(edge[:-1]) > 0
            out["doc_id"].append(chunk.column("ids")[row].values)
            out["n_words"].append(np.diff(w.first))
            out["n_removed"].append(C.sums_by_row(gone, w.first))
            out["kept"].append(_kept(w, ~gone))
        n = {k: np.concatenate(out[k]) for k in ("n_words", "n_removed")}
        return pa.table({"doc_id": pa.concat_arrays(out["doc_id"]), "n_words": pa.array(n["n_words"], pa.int64()),
                         "n_removed": pa.array(n["n_removed"], pa.int64()),
                         "kept": pa.concat_arrays(out["kept"])})
    return run


def _kept(w: Windows, keep: np.ndarray) -> pa.StringArray:
    """The kept words of each row, joined by one space."""
    s, e = w.s[keep], w.e[keep]
    edge = np.zeros(len(w.buf) + 1, dtype=np.int8)
    edge[s] = 1
    edge[e + 1] -= 1  # each word with the byte after it, which becomes a space
    mask = np.cumsum(edge[:-1], dtype=np.int8) > 0
    w.buf[e] = 32
    total = np.zeros(len(w.buf) + 1, dtype=np.int64)
    np.cumsum(mask, out=total[1:])
    # drop the space after each row's last word
    per_row = np.searchsorted(s, w.off)
    last = e[per_row[1:][np.diff(per_row) > 0] - 1]
    mask[last] = False
    np.cumsum(mask, out=total[1:])
    data = w.buf[mask]
    return pa.StringArray.from_buffers(len(w.off) - 1, pa.py_buffer(total[w.off].astype(np.int32)),
                                       pa.py_buffer(data))


def remove_repeats(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, and ``kept``, the text that is left
    (its words joined by one space)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunks = C.written(rows.mapInArrow(_pack, _CHUNKS), "op10-chunks")
    words = chunks.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // BUCKET_WINDOWS))
    sent = chunks.select("chunk", "lengths", "texts").mapInArrow(
        _send(k, buckets), "bucket int, chunk bigint, data binary")
    answers = sent.groupBy("bucket").applyInArrow(_answer, "bucket int, chunk bigint, data binary")
    return (chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(_remove(k, buckets), "doc_id bigint, n_words bigint, n_removed bigint, kept string"))
