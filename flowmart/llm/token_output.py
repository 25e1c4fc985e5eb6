r"""Token ids as canonical, length-limited Huffman code (operator 3).

Writing.  Texts are encoded with the ``tokenizers`` library; each document's ids end with the end
id.  Global id counts (partial counts per task, summed in Spark, at most one row per vocabulary
entry) give a code of at most ``MAX_BITS`` bits by package-merge, in canonical order.  Documents
are dealt to parts by ranges of doc_id and of a number that each row has of its own, so rows that
share an id are spread as well, sorted there and coded one by one, each from a byte boundary.

File format, a folder of two Parquet tables:

* ``code``: id, bits (code length) and n (count) of every id in use.  Codes are canonical: by
  (length, id), counting up, most significant bit first.
* ``segments``: consecutive documents, in ascending doc_id order over parts and, inside a part,
  over ``seq``; with their doc_ids, numbers of ids, byte offsets into ``payload``, and for every
  run of ``BLOCK`` ids in a document the bit where it starts (``checkpoints``).

Reading.  A table of 2^bits entries maps the next bits to an id and its length.  Every block
between two checkpoints decodes on its own; the blocks of a segment advance in lockstep, one id
each per numpy step.

Words repeat, so each Python worker keeps the ids of pieces it has met (at most ``CACHE``).
Pieces end where no pre-token of a byte-level tokenizer can go on: before a space that follows a
visible character, and before . , ; : ! ? after a letter.

Defined cases: a null text counts as empty (its only id is the end id); a null doc_id comes first;
rows alike are documents of their own, in any order among themselves; an empty table writes no
segments.  Only doc_id and text are read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmart.llm import common as C
from flowmart.llm import sharding
from flowmart.session import checkpoint_dir

END_ID = 2
MAX_BITS = 16
BLOCK = 512
SEGMENT_IDS = 1 << 20
CACHE = 600_000
CHUNK = 1 << 20


# ---- text -> ids

_PUNCT = C._byte_class([ord(c) for c in ".,;:!?"])
_VISIBLE = C._byte_class(list(range(0x21, 0x7F)))
_LETTER = C._byte_class([*range(65, 91), *range(97, 123)])


def _byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: visible Latin-1 characters
    stand for themselves, the others for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Encoder:
    """One tokenizer with a bounded memory of pieces."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.chars = _byte_chars()
        self.known: dict[bytes, bytes] = {}
        self.kind = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        spec = self.tok.to_str()
        # pieces hold only for plain byte-level tokenizers; others get whole texts
        import json
        pre = json.loads(spec)
        self.pieces = (pre["normalizer"] is None and pre["pre_tokenizer"]["type"] == "ByteLevel"
                       and not pre["pre_tokenizer"]["add_prefix_space"]
                       and pre["pre_tokenizer"].get("use_regex", True))
        self.special = [t["content"].encode() for t in pre["added_tokens"]]

    def _learn(self, new: list[bytes]) -> list[bytes]:
        """The packed ids of new pieces."""
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
        kind, tokenize, space = np.dtype(self.kind).char, self.model.tokenize, self.chars[32]
        out: list[bytes | None] = [None] * len(new)
        rest = []
        for i, p in enumerate(new):
            s = p.decode()
            body = s[1:] if s[0] == " " else s
            if not body.isalpha():
                rest.append((i, s))
                continue
            # one pre-token: the model alone decides
            if p.isascii():
                s = space + body if body is not s else s
            else:
                s = p.decode("latin-1").translate(self.chars)
            out[i] = array(kind, [t.id for t in tokenize(s)]).tobytes()
        for (i, _), e in zip(rest, self.tok.encode_batch_fast([s for _, s in rest], add_special_tokens=False)):
            out[i] = array(kind, e.ids).tobytes()
        self.known.update(zip(new, out))
        return out

    def encode(self, c: C.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows (without end ids), and the bounds of each row."""
        text = c.buf.tobytes()
        if not self.pieces or any(s in text for s in self.special):
            got = self.tok.encode_batch([c.raw(i).decode() for i in range(c.rows)], add_special_tokens=False)
            ids = [np.array(e.ids, dtype=self.kind) for e in got]
            return (np.concatenate([np.zeros(0, self.kind), *ids]),
                    np.cumsum([0, *map(len, ids)]))
        s = _piece_starts(c.buf, c.off)
        e = np.append(s[1:], len(c.buf))
        h = C.span_hashes(c.buf, s, e)
        which, _ = pd.factorize(h)  # numbered by first appearance
        lead = np.flatnonzero(np.diff(np.maximum.accumulate(which), prepend=-1))
        keys = [text[a:b] for a, b in zip(s[lead].tolist(), e[lead].tolist())]
        got = list(map(self.known.get, keys))
        missing = [i for i, ids in enumerate(got) if ids is None]
        for i, ids in zip(missing, self._learn([keys[i] for i in missing])):
            got[i] = ids
        size = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // np.dtype(self.kind).itemsize
        flat = np.frombuffer(b"".join(got), dtype=self.kind)
        at = np.concatenate([[0], np.cumsum(size)])
        n = size[which]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(n) else 0
        take = np.repeat(at[which] - (ends - n), n) + np.arange(total)
        bounds = np.concatenate([[0], ends])[np.searchsorted(s, c.off)]
        return flat[take], bounds


def _piece_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    n = len(buf)
    if not n:
        return np.zeros(0, dtype=np.int64)
    visible, letter = _VISIBLE[buf], _LETTER[buf]
    # last bytes of Latin letters: lead C3, without the multiplication and division signs
    latin = np.zeros(n, dtype=bool)
    latin[1:] = (buf[:-1] == 0xC3) & (buf[1:] != 0x97) & (buf[1:] != 0xB7)
    # last bytes of other characters that are no white space: two bytes (C3 to DF), three (E4 to EF)
    wide = np.zeros(n, dtype=bool)
    wide[1:] = (buf[:-1] >= 0xC3) & (buf[:-1] <= 0xDF)
    wide[2:] |= (buf[:-2] >= 0xE4) & (buf[:-2] <= 0xEF)
    cut = np.zeros(n, dtype=bool)
    cut[1:] = (buf[1:] == 0x20) & (visible | wide)[:-1]
    cut[1:] |= _PUNCT[buf[1:]] & (letter | latin)[:-1]
    cut[off[:-1][off[:-1] < n]] = True
    return np.flatnonzero(cut)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


_IDS = "doc_id bigint, n bigint, size int, width int, ids binary, counts binary"


def _tokenize(path: str, end_id: int):
    """Rows (doc_id, text) -> their ids, each with a number of its own (spread over all values), and as
    its last row every task's count of each id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc = _encoder(path)
        width = np.dtype(enc.kind).itemsize
        at, total = TaskContext.get().partitionId() << 33, np.zeros(0, dtype=np.int64)
        for b in batches:
            for c in C.chunks(b.column("text"), CHUNK):
                ids, bounds = enc.encode(c)
                ids = np.insert(ids, bounds[1:], end_id)
                bounds = bounds + np.arange(c.rows + 1)
                used = np.bincount(ids, minlength=len(total))
                used[:len(total)] += total
                total = used
                data = pa.Array.from_buffers(pa.binary(), c.rows, [
                    None, pa.py_buffer((bounds * width).astype(np.int32)), pa.py_buffer(ids)])
                number = C.mix64(np.arange(at, at + c.rows, dtype=np.uint64)).view(np.int64)
                at += c.rows
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.lo, c.rows), pa.array(number), pa.array(np.diff(bounds), pa.int32()),
                     pa.array(np.full(c.rows, width), pa.int32()), data, pa.nulls(c.rows, pa.binary())],
                    names=["doc_id", "n", "size", "width", "ids", "counts"])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()),
             pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())],
            names=["doc_id", "n", "size", "width", "ids", "counts"])
    return run


def _flat(col: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and the bounds of each row."""
    kind = np.uint16 if width == 2 else np.uint32
    off = np.frombuffer(col.buffers()[1], dtype=np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(col.buffers()[2], dtype=np.uint8)[off[0]:off[-1]]
    return np.frombuffer(raw.tobytes(), dtype=kind), (off - off[0]) // width


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for raw in b.column("counts"):
            total = np.frombuffer(raw.as_buffer(), dtype=np.int64)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())],
                                             names=["id", "n"])


# ---- the code

def code_lengths(counts: np.ndarray, most: int = MAX_BITS) -> np.ndarray:
    """Code lengths of at most ``most`` bits for symbols with these counts (all above 0), of least
    total size: package-merge.  Since cheaper symbols enter every level first, a level is described
    by how many symbols it takes."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, dtype=np.int64)
    if n > 1 << most:
        raise ValueError("more symbols than codes")
    order = np.argsort(counts, kind="stable")
    leaf = counts[order].astype(np.float64)
    levels, packages = [], np.zeros(0)
    for _ in range(most):
        both = np.concatenate([leaf, packages])
        place = np.argsort(both, kind="stable")
        levels.append(place < n)
        both = both[place]
        packages = both[: len(both) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, dtype=np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out = np.empty(n, dtype=np.int64)
    out[order] = lengths
    return out


class Code:
    """Canonical codes of the ids in use, and the decoding table."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        self.most = int(bits.max(initial=1))
        order = np.lexsort((ids, bits))
        ids, bits = ids[order], bits[order]
        size = np.left_shift(np.ones(len(ids), dtype=np.int64), self.most - bits)
        start = np.cumsum(size) - size  # the code, filled up to the greatest length
        top = int(ids.max(initial=0)) + 1
        self.code = np.zeros(top, dtype=np.uint64)
        self.bits = np.zeros(top, dtype=np.int64)
        self.code[ids] = (start >> (self.most - bits)).astype(np.uint64)
        self.bits[ids] = bits
        self.table = np.zeros(1 << self.most, dtype=np.int64)  # id * 32 + length
        self.table[:int(size.sum())] = np.repeat(ids * 32 + bits, size)

    def encode(self, ids: np.ndarray, bounds: np.ndarray):
        """Payload of some documents, each from a byte boundary: bytes, byte bounds, the start bits of
        all blocks (from the document's first bit) and the number of blocks per document."""
        n = self.bits[ids]
        ends = np.concatenate([[0], np.cumsum(n)])
        size = (np.diff(ends[bounds]) + 7) // 8
        at = np.concatenate([[0], np.cumsum(size)])
        shift = np.repeat(at[:-1] * 8 - ends[bounds[:-1]], np.diff(bounds))
        pos = ends[:-1] + shift
        words = np.zeros(int(at[-1]) // 4 + 3, dtype=np.uint64)
        value = self.code[ids] << (64 - (pos & 31) - n).astype(np.uint64)
        w = pos >> 5
        lead = np.flatnonzero(np.diff(w, prepend=-1))
        if len(lead):
            words[w[lead]] |= np.bitwise_or.reduceat(value >> np.uint64(32), lead)
            words[w[lead] + 1] |= np.bitwise_or.reduceat(value & np.uint64(0xFFFFFFFF), lead)
        data = words.astype(">u4").view(np.uint8)[:int(at[-1])]
        blocks = -(-np.diff(bounds) // BLOCK)
        first = np.repeat(bounds[:-1], blocks)
        k = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        marks = ends[first + k * BLOCK] - ends[first]
        return data, at, marks, blocks

    def decode(self, payload: np.ndarray, at: np.ndarray, counts: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """All ids of the documents at the byte offsets ``at``."""
        blocks = -(-counts // BLOCK)
        doc = np.repeat(np.arange(len(counts)), blocks)
        k = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        n = np.minimum(counts[doc] - k * BLOCK, BLOCK)
        to = (np.cumsum(counts) - counts)[doc] + k * BLOCK
        pos = at[doc] * 8 + marks
        raw = np.concatenate([payload, np.zeros(4, dtype=np.uint8)]).astype(np.int64)
        ahead = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]  # 32 bits from each byte
        out = np.empty(int(counts.sum()), dtype=np.int64)
        order = np.argsort(-n, kind="stable")
        pos, to, n = pos[order], to[order], n[order]
        live = len(n)
        for step in range(int(n.max(initial=0))):
            while n[live - 1] <= step:  # blocks are sorted by length, longest first
                live = int(np.searchsorted(-n[:live], -step, side="left"))
            p = pos[:live]
            entry = self.table[(ahead[p >> 3] >> (32 - self.most - (p & 7))) & ((1 << self.most) - 1)]
            out[to[:live] + step] = entry >> 5
            p += entry & 31
        return out


# ---- files

_SEGMENTS = ("part int, seq int, n_ids bigint, doc_ids array<bigint>, counts array<bigint>, "
             "offsets array<bigint>, checkpoints array<bigint>, payload binary")


def _write(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part, seq = shared.value, None, 0
        for b in batches:
            if not b.num_rows:
                continue
            ids, bounds = _flat(b.column("ids"), b.column("width")[0].as_py())
            parts = b.column("part").to_numpy(zero_copy_only=False)
            cut = np.append(np.flatnonzero(np.diff(parts)) + 1, b.num_rows)  # a part's rows lie together
            lo = 0
            while lo < b.num_rows:
                if parts[lo] != part:
                    part, seq = parts[lo], 0
                hi = int(np.searchsorted(bounds, bounds[lo] + SEGMENT_IDS, side="right")) - 1
                hi = min(max(hi, lo + 1), int(cut[np.searchsorted(cut, lo, side="right")]))
                own = bounds[lo:hi + 1] - bounds[lo]
                data, at, marks, _ = code.encode(ids[bounds[lo]:bounds[hi]], own)
                one = lambda v, kind: C.lists(v, np.array([0, len(v)]), kind)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([int(own[-1])], pa.int64()),
                    one(b.column("doc_id").slice(lo, hi - lo), pa.int64()), one(np.diff(own), pa.int64()),
                    one(at[:-1], pa.int64()), one(marks, pa.int64()), pa.array([data.tobytes()], pa.binary())],
                    names=["part", "seq", "n_ids", "doc_ids", "counts", "offsets", "checkpoints", "payload"])
                lo, seq = hi, seq + 1
    return run


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of all texts to the folder ``path``.  ``tokenizer`` is a file that every executor
    has at this place."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = C.written(rows.mapInArrow(_tokenize(tokenizer, end_id), _IDS), "op3-ids", compression="zstd")
    counts = ids.where("counts is not null").select("counts").mapInArrow(_count, "id bigint, n bigint")
    # at most one row per vocabulary entry
    counts = sorted((r["id"], r["n"]) for r in counts.groupBy("id").agg(F.sum("n").alias("n")).collect())
    known = np.array([c[0] for c in counts], dtype=np.int64)
    n = np.array([c[1] for c in counts], dtype=np.int64)
    bits = code_lengths(n)
    spark.createDataFrame([(int(i), int(b), int(c)) for i, b, c in zip(known, bits, n)],
                          "id bigint, bits int, n bigint").coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(Code(known, bits))

    # parts of about equal numbers of ids: ranges of (doc_id, number), found from these columns alone
    docs_of = ids.where("counts is null")
    first = F.coalesce("doc_id", F.lit(-(1 << 63)))
    key = {"__size": F.col("size").cast("bigint"), "__k": first,
           "__i": F.struct(F.col("n").alias("i"), F.lit(0).cast("bigint").alias("n"))}
    narrow = docs_of.select(*(v.alias(k) for k, v in key.items()))
    total, n_rows = narrow.agg(F.coalesce(F.sum("__size"), F.lit(0)), F.count("*")).first()
    cuts = sharding.splitters(narrow, total, n_rows) if n_rows else []
    (docs_of.withColumns(key).withColumn("part", sharding._range_of(cuts)).drop("size", "counts", *key)
     .repartition("part").sortWithinPartitions("part", "doc_id", "n")
     .mapInArrow(_write(shared), _SEGMENTS).write.option("compression", "uncompressed")
     .parquet(f"{path}/segments"))
    C.drop(ids)


def _read(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = shared.value
        for b in batches:
            for r in range(b.num_rows):
                get = lambda name, r=r, b=b: b.column(name)[r].values.to_numpy()
                counts = get("counts")
                ids = code.decode(np.frombuffer(b.column("payload")[r].as_buffer(), dtype=np.uint8),
                                  get("offsets"), counts, get("checkpoints")).astype(np.uint32)
                bounds = np.concatenate([[0], np.cumsum(counts)])
                rows = len(counts)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_ids")[r].values, pa.array(np.full(rows, b.column("start")[r].as_py()) + bounds[:-1]),
                    pa.array(counts), C.lists(ids.view(np.int32), bounds, pa.int32())],
                    names=["doc_id", "start", "n_tokens", "ids"])
    return run


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        col = b.column("ids")
        flat, off = col.flatten().to_numpy(), np.asarray(col.offsets) - col.offsets[0].as_py()
        raw = memoryview(np.ascontiguousarray(flat).view(np.uint8))
        crc = [zlib.crc32(raw[a * 4:z * 4]) for a, z in zip(off[:-1].tolist(), off[1:].tolist())]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("start"), b.column("n_tokens"),
                                          pa.array(crc, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the folder: doc_id, start (ids of all documents before it), n_tokens and
    ids (unsigned ids as int)."""
    code = [(r["id"], r["bits"]) for r in spark.read.parquet(f"{path}/code").select("id", "bits").collect()]
    shared = spark.sparkContext.broadcast(Code(np.array([c[0] for c in code], dtype=np.int64),
                                               np.array([c[1] for c in code], dtype=np.int64)))
    seg = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    sizes = seg.select("part", "seq", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = (sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    starts = (sizes.withColumn("own", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
              .select("part", "seq", (F.col("base") + F.col("own")).alias("start")))
    return (seg.join(starts, ["part", "seq"])
            .mapInArrow(_read(shared), "doc_id bigint, start bigint, n_tokens bigint, ids array<int>"))


def digests(docs: DataFrame, tokenizer: str, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write, read back, and per document return doc_id, start, n_tokens and the unsigned CRC-32 of the
    ids as little-endian 32-bit integers."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark)}/flowmart-op3-{uuid.uuid4().hex}"
    write_ids(docs, tokenizer, path, end_id)
    return read_ids(spark, path).mapInArrow(_digest, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
