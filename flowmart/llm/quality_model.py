r"""Quality classifier: ordinal cumulative-link regression (operator 1).

Grades come from the ratings: 0 poor, 1 good but toxic, 2 good.  The model is
P(grade <= k | x) = sigmoid(t_k - w.x) with one weight vector over hashed text features for all
grades and ordered thresholds t_0 < t_1.  It gives every document its expected grade and the tail
probability P(grade >= 2), by which documents are selected.

Features, hashed into ``DIMS`` places: the distinct lower-cased words; the shapes of words (letter,
digit and mark runs) by their share; and the share of words equal to the one before.

The fit uses at most ``SAMPLE`` rated documents (the ones with the least hash of their id; a bounded
sample, as labels grow with the corpus), AdaGrad steps with an l1 pull, on the driver.  A fifth of
the sample is held out to choose the selection threshold: the one with the best balanced accuracy of
"top grade".  All documents are scored, whole, in their own row; nothing is shuffled for it.

Defined cases: a null text counts as empty and has only the constant feature; ratings without id or
with a null value are ignored; of several ratings of one id the lowest grade counts; without any
rating (or only one grade) all weights are zero, thresholds follow the counts and every document is
kept; rows alike get the same score; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.llm import common as C
from flowmart.llm.near_dedup import distinct

DIMS = 1 << 18
GRADES = 3
SAMPLE = 8_000
STEPS = 480
BATCH = 128
RATE = 0.1
L1 = 1e-3
#: a feature needs so many training documents to get a weight
MIN_DOCS = 5

# byte -> class of a shape: letters, capitals, digits; marks stay themselves
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48


def chunk_features(c: C.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature places and values of all rows, and the bounds of each row."""
    n = c.rows
    low = C.LOWER[c.buf]
    s, e, first = C.word_spans(low, c.off, C.ALNUM_LOWER)
    h, row = C.span_hashes(low, s, e), C.rows_of_words(first)
    m = distinct(h, row)
    h, hrow = h[m], row[m]

    s, e, first = C.word_spans(c.buf, c.off, C.NON_SPACE)
    word, row = C.span_hashes(c.buf, s, e), C.rows_of_words(first)
    count = np.maximum(np.diff(first), 1)
    shape = _SHAPE[c.buf]
    keep = np.ones(len(shape), dtype=bool)  # one byte of every run inside a word
    keep[1:] = shape[1:] != shape[:-1]
    keep[s] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    sh = C.span_hashes(shape[keep], at[s], at[e], salt=23)
    with np.errstate(over="ignore"):
        key = sh ^ C.mix64(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key)
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    lead = order[new]
    times = np.diff(np.append(np.flatnonzero(new), len(key)))
    share = 10.0 * times / count[row[lead]] if len(lead) else np.zeros(0)
    same = np.zeros(len(s), dtype=bool)
    same[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
    stutter = 10.0 * C.sums_by_row(same, first) / count

    place = np.concatenate([(h % np.uint64(DIMS - 2)).astype(np.int64) + 2,
                            (sh[lead] % np.uint64(DIMS - 2)).astype(np.int64) + 2,
                            np.zeros(n, dtype=np.int64), np.ones(n, dtype=np.int64)])
    value = np.concatenate([np.ones(len(h)), share, np.ones(n), stutter])
    rows = np.concatenate([hrow, row[lead], np.arange(n), np.arange(n)])
    order = np.argsort(rows, kind="stable")
    return place[order], value[order], np.searchsorted(rows[order], np.arange(n + 1))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. (rows x GRADES - 1)."""
        return _sigmoid(score[:, None] - self.thresholds[None, :])


def _scores(weights: np.ndarray, place: np.ndarray, value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[place] * value)])
    return total[bounds[1:]] - total[bounds[:-1]]


def fit(place: np.ndarray, value: np.ndarray, bounds: np.ndarray, grade: np.ndarray, seed: int = 7) -> Model:
    """Fit on graded rows; a fifth of them is held out for the cut."""
    rng = np.random.default_rng(seed)
    n = len(grade)
    w, seen = np.zeros(DIMS), np.full(DIMS, 1e-6)
    counts = np.bincount(grade, minlength=GRADES) + 1.0
    below = np.cumsum(counts)[:-1] / counts.sum()
    t = np.log(below / (1 - below))
    if n == 0 or (counts > 1).sum() < 2:
        return Model(w, t, 0.0)
    held = rng.permutation(n) < n // 5
    train = np.flatnonzero(~held)
    value = value * (np.bincount(place[np.repeat(~held, np.diff(bounds))], minlength=DIMS) >= MIN_DOCS)[place]
    a, gap = t[0], np.log(np.maximum(np.diff(t), 1e-3))
    seen_a, seen_gap = 1e-6, np.full(len(gap), 1e-6)
    batches: list[np.ndarray] = []
    for _ in range(STEPS):
        if not batches:
            order = rng.permutation(train)
            batches = [order[lo:lo + BATCH] for lo in range(0, len(order), BATCH)]
        rows = batches.pop()
        size = np.diff(bounds)[rows]
        take = np.repeat(bounds[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        p, v = place[take], value[take]
        own = np.concatenate([[0], np.cumsum(size)])
        z = _scores(w, p, v, own)
        t = np.concatenate([[a], a + np.cumsum(np.exp(gap))])
        edges = np.concatenate([[-np.inf], t, [np.inf]])
        y = grade[rows]
        up, down = _sigmoid(edges[y + 1] - z), _sigmoid(edges[y] - z)
        up[np.isinf(edges[y + 1])], down[np.isinf(edges[y])] = 1.0, 0.0
        prob = np.maximum(up - down, 1e-9)
        du, dd = up * (1 - up), down * (1 - down)
        gz = (du - dd) / prob / len(rows)  # of the loss with respect to the score
        g = np.bincount(p, weights=v * np.repeat(gz, size), minlength=DIMS)
        hit = np.flatnonzero(g)
        seen[hit] += g[hit] ** 2
        step = RATE / np.sqrt(seen[hit])
        moved = w[hit] - step * g[hit]
        w[hit] = np.sign(moved) * np.maximum(np.abs(moved) - step * L1, 0)
        gt = np.zeros(GRADES - 1)
        np.add.at(gt, np.minimum(y, GRADES - 2), np.where(y < GRADES - 1, -du / prob, 0) / len(rows))
        np.add.at(gt, np.maximum(y - 1, 0), np.where(y > 0, dd / prob, 0) / len(rows))
        ga = gt.sum()
        gg = np.array([gt[k + 1:].sum() for k in range(len(gap))]) * np.exp(gap)
        seen_a, seen_gap = seen_a + ga ** 2, seen_gap + gg ** 2
        a, gap = a - RATE * ga / np.sqrt(seen_a), gap - RATE * gg / np.sqrt(seen_gap)
    t = np.concatenate([[a], a + np.cumsum(np.exp(gap))])
    model = Model(w, t, 0.0)
    rows = np.flatnonzero(held)
    if len(rows):
        z = _scores(w, place, value, bounds)[rows]
        top = model.tails(z)[:, -1]
        good = grade[rows] == GRADES - 1
        if good.any() and not good.all():
            cuts = np.unique(np.concatenate([top, [0.5]]))
            tpr = 1 - np.searchsorted(np.sort(top[good]), cuts) / good.sum()
            tnr = np.searchsorted(np.sort(top[~good]), cuts) / (~good).sum()
            best = tpr + tnr
            model.cut = float(np.median(cuts[best >= best.max() - 1e-12]))
    return model


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for c in C.chunks(b.column("text")):
            place, value, bounds = chunk_features(c)
            yield pa.RecordBatch.from_arrays(
                [b.column("grade").slice(c.lo, c.rows), C.lists(place, bounds, pa.int32()),
                 C.lists(value, bounds, pa.float32())], names=["grade", "place", "value"])


def rated(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """grade, doc_id and text of at most ``sample`` rated documents."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    some = (labels.select(F.col("doc_id").cast("bigint").alias("__id"), grade.alias("grade"))
            .where("__id is not null and grade is not null").groupBy("__id").agg(F.min("grade").alias("grade"))
            .orderBy(F.xxhash64("__id"), "__id").limit(sample))
    # at most ``sample`` pairs of numbers are broadcast
    return docs.join(F.broadcast(some), F.col("doc_id").cast("bigint") == F.col("__id")).select(
        "grade", F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model, fitted on a bounded sample (repeated rows of a rated document may add to it, up to
    ``2 * sample`` rows, the first by id and hash of the text).  The rows come in that order, so the
    model does not hang on how the table is partitioned."""
    got = (rated(docs, labels, sample).orderBy("doc_id", F.xxhash64("text"), "text").limit(2 * sample)
           .mapInArrow(_featurize, "grade int, place array<int>, value array<float>").toArrow())
    place = got.column("place").combine_chunks()
    bounds = np.concatenate([[0], np.cumsum(np.asarray(place.value_lengths(), dtype=np.int64))])
    return fit(place.flatten().to_numpy().astype(np.int64),
               got.column("value").combine_chunks().flatten().to_numpy().astype(np.float64), bounds,
               got.column("grade").to_numpy().astype(np.int64))


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            for c in C.chunks(b.column("text")):
                tails = model.tails(_scores(model.weights, *chunk_features(c)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(c.lo, c.rows), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]),
                     pa.array(tails[:, -1] >= model.cut)],
                    names=["doc_id", "expected_grade", "p_top", "kept"])
    return run


def grade(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, expected_grade (0 to GRADES - 1), p_top = P(top grade), and
    whether it is selected (p_top at least the cut)."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, sample))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_predict(shared), "doc_id bigint, expected_grade double, p_top double, kept boolean")
