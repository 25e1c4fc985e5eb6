"""Shared helpers: word spans and hashes over Arrow text columns, written tables.

Text columns reach Python as Arrow batches.  All helpers work on the UTF-8 bytes
of many documents at once with numpy, in chunks of bounded size (one document is
never split), so memory per task is bounded by ``CHUNK_BYTES`` or by the longest
single document.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.session import checkpoint_dir

CHUNK_BYTES = 1 << 20

U64 = np.uint64
_MUL = 0x9E3779B97F4A7C15 | 1
_INV = pow(_MUL, -1, 1 << 64)


def _byte_class(members: list[int]) -> np.ndarray:
    lut = np.zeros(256, dtype=bool)
    lut[members] = True
    return lut


# Word bytes of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
NON_SPACE = _byte_class([b for b in range(256) if b != 0x20 and not 0x09 <= b <= 0x0D])
ALNUM_LOWER = _byte_class([b for b in range(256)
                           if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# lead (or only) bytes of UTF-8 characters: their number is the number of code points
CHAR_START = _byte_class([b for b in range(256) if b & 0xC0 != 0x80])


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (xor-shift and multiply rounds)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed well-mixed 64-bit values."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=U64) * U64(_MUL) + U64(salt))


_BYTE_CODE = seeds(256, 17)
_powers = np.ones(1, dtype=U64)
_inverse = np.ones(1, dtype=U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse modulo 2^64 (kept for reuse)."""
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, CHUNK_BYTES + 1)
        with np.errstate(over="ignore"):
            for name, base in (("_powers", _MUL), ("_inverse", _INV)):
                p = np.full(size, base, dtype=U64)
                p[0] = 1
                globals()[name] = np.cumprod(p, dtype=U64)
    return _powers[:n], _inverse[:n]


@dataclass
class Chunk:
    """Some consecutive rows: their text bytes, and row i at ``off[i]:off[i + 1]``."""

    lo: int
    hi: int
    buf: np.ndarray
    off: np.ndarray
    null: np.ndarray

    @property
    def rows(self) -> int:
        return self.hi - self.lo

    def raw(self, i: int) -> bytes:
        return self.buf[self.off[i]:self.off[i + 1]].tobytes()


def chunks(col: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of a string column in order, in chunks of at most ``limit`` bytes
    (or one row); a null is an empty text."""
    if pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
        kind = np.int64
    else:
        col = col.cast(pa.string())
        kind = np.int32
    n = len(col)
    if not n:
        return
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=kind)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    null = col.is_null().to_numpy(zero_copy_only=False)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield Chunk(lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], null[lo:hi])
        lo = hi


def word_spans(buf: np.ndarray, off: np.ndarray, word: np.ndarray):
    """Words (maximal runs of word bytes inside a row): starts, ends, and the index of
    the first word of each row (with the total at the end)."""
    n = len(buf)
    if not n:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(off), dtype=np.int64)
    w = word[buf]
    begin, end = w.copy(), w.copy()
    begin[1:] &= ~w[:-1]
    end[:-1] &= ~w[1:]
    first = off[:-1][off[:-1] < off[1:]]
    begin[first] = w[first]
    end[first[1:] - 1] = w[first[1:] - 1]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, off)


def span_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray, salt: int = 0,
                lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial in the hash base over coded
    bytes, by prefix sums, then mixed."""
    code = _BYTE_CODE if not salt else seeds(256, salt)
    if lower:
        code = code[LOWER]
    n = len(buf)
    pw, inv = powers(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(code[buf] * pw[:n], out=sums[1:])
        return mix64((sums[e] - sums[s]) * inv[s] + (e - s).astype(U64))


def window_hashes(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all windows of ``k`` consecutive words of one row: the window
    starts (word index) and hashes.  ``row`` is each word's row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)
    start = np.flatnonzero(row[:n] == row[k - 1:])
    pw, inv = powers(len(h) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(h) + 1, dtype=U64)
        np.cumsum(h * pw[:len(h)], out=sums[1:])
        return start, mix64((sums[start + k] - sums[start]) * inv[start])


def rows_of_words(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def sums_by_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]`` for each i."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def lists(values, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column: row i holds ``values[bounds[i]:bounds[i + 1]]``."""
    return pa.ListArray.from_arrays(pa.array(bounds, type=pa.int32()), pa.array(values, type=kind))


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared checkpoint folder and read back: cuts
    the lineage in a place that all executors share.  The files stay until the deployment
    clears the folder."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/flowmart-{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Deletes the files of a table that :func:`written` made, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if folder.rpartition("/")[2].startswith("flowmart-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tidy(spark: SparkSession) -> None:
    """Lets Spark's cleaner remove the shuffle files and broadcasts that no plan reads any more: it
    learns of them when the driver collects its garbage, which a job of many small steps rarely does."""
    gc.collect()
    spark._jvm.System.gc()


def prefix(*tables: DataFrame) -> str:
    """Underscores that no column of the tables begins with: names made of it clash with none."""
    p = "__"
    while any(c.startswith(p) for t in tables for c in t.columns):
        p += "_"
    return p


def row_key(columns: list[Column]) -> Column:
    """A 64-bit hash of a row by these columns; nulls count as values."""
    return F.xxhash64(*columns, *(c.isNull() for c in columns))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The whole ``documents`` table, or some of its columns."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df
