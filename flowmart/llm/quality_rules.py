r"""Quality rules: robust multivariate outliers (operator 8).

Every document gets a few text statistics and a base verdict by two plain rules.
The method then looks for outliers among the transformed statistic vectors: for each
language and source a minimum-covariance-determinant (MCD) estimate of location and
scatter is fitted, and a document whose squared Mahalanobis distance is beyond a cut
is rejected.

The MCD runs as concentration steps on all rows: distances under the present estimate,
the ``SUPPORT`` quantile of the distances of each group, then moments of the rows within
it.  Quantiles come from counts of fine steps of the values, moments from sums of whole numbers
(vectors are held in units of 2^-14).  Both are partial aggregates, so a source with a third of
all rows is combined before its shuffle, and both are exact, so a verdict does not hang on how
rows are partitioned.  Only per-group moments reach the numpy step that inverts a small matrix.
What is known of each group is joined to its rows by broadcast while there are at most
``MANY_POOLS`` groups, and by a shuffle beyond.

The cut follows from each group's own distances: Tukey's fence, 1.5 interquartile ranges above
the third quartile, on the log of the distance; and never below the distance that one in a
thousand of normal vectors exceeds.

Defined cases: a null text counts as empty (all statistics 0, base_failed, as n_words < 10);
null lang or source form groups of their own; groups with fewer than ``min_rows`` rows that
pass the base rules (only those are fitted) are pooled by language, then all together, and if
even that pool is smaller its rows keep the base verdict; repeated rows are judged one by one;
an empty table gives an empty result.
Only ``doc_id``, ``text``, ``lang`` and ``source`` are read, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm import common as C

SYMBOLS = C._byte_class([ord(c) for c in "#*$%&|<>"])
UPPER = C._byte_class(list(range(65, 91)))
# other marks: ASCII that is neither letter, digit, space, control nor one of the symbols
MARKS = C._byte_class([b for b in range(33, 127)
                       if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)]) & ~SYMBOLS

WINDOW_WORDS = 5
FEATURES = 7
#: words that pull the ratios of a short text towards ordinary ones
PRIOR_WORDS = 60.0
PRIOR = {"chars": 6.0, "symbols": 0.0, "upper": 0.25, "marks": 0.25}
#: least standard deviation of each feature: rows of a group may all be alike in it
FLOOR = [0.08, 0.06, 0.08, 0.15, 0.15, 0.12, 0.06]
#: units of the vectors and, coarser, of their medians; steps of a distance that is doubled
UNIT = 1 << 14
COARSE = 16
PER_OCTAVE = 64
#: percent of a group's rows that the estimate rests on, and concentration steps
SUPPORT = 75
STEPS = 4
MIN_ROWS = 100
MANY_POOLS = 10_000
#: Tukey's factor of the interquartile range
FENCE = 1.5


def _chi2(z: float) -> float:
    """The chi-square quantile of a normal quantile (Wilson-Hilferty)."""
    return FEATURES * (1 - 2 / (9 * FEATURES) + z * (2 / (9 * FEATURES)) ** 0.5) ** 3


CHI2_MEDIAN, CHI2_999 = _chi2(0.0), _chi2(3.0902)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_SCHEMA = ("doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, "
           "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, x array<int>")


def repeated(key: np.ndarray, row: np.ndarray, first: bool) -> np.ndarray:
    """Which entries have a hash seen elsewhere in their row; all of them with ``first``, else
    all but one of each."""
    out = np.zeros(len(key), dtype=bool)
    if len(key) < 2:
        return out
    with np.errstate(over="ignore"):
        key = key ^ C.mix64(row.astype(np.uint64) + np.uint64(1))  # equal only within a row
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    out[order[1:][same]] = True
    if first:
        out[order[:-1][same]] = True
    return out


def chunk_stats(c: C.Chunk) -> dict[str, np.ndarray]:
    """The base statistics and the counts behind the features, one entry per row."""
    buf, off, n = c.buf, c.off, c.rows
    s, e, first = C.word_spans(buf, off, C.NON_SPACE)
    row = C.rows_of_words(first)
    words = np.diff(first)
    h = C.span_hashes(buf, s, e)
    start, wh = C.window_hashes(h, row, WINDOW_WORDS)
    hit = repeated(wh, row[start], first=True)
    cover = np.zeros(len(s) + 1, dtype=np.int64)
    np.add.at(cover, start[hit], 1)
    np.add.at(cover, start[hit] + WINDOW_WORDS, -1)
    in_repeat = np.cumsum(cover[:-1]) > 0
    stutter = np.zeros(len(s), dtype=bool)  # words equal to the one before them in the row
    stutter[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])

    # lines: split at \n inside rows; a line counts if it holds a word
    cut = np.flatnonzero(buf == 10)
    ls = np.sort(np.concatenate([off[:-1], cut + 1]))
    le = np.sort(np.concatenate([off[1:], cut]))
    lrow = np.sort(np.concatenate([np.arange(n), np.searchsorted(off[1:], cut, side="right")]))
    filled = np.searchsorted(s, le) > np.searchsorted(s, ls)
    ls, le, lrow = ls[filled], le[filled], lrow[filled]
    again = repeated(C.span_hashes(buf, ls, le), lrow, first=False)

    def count(mask: np.ndarray) -> np.ndarray:
        return C.sums_by_row(mask[buf], off)

    return {"n_words": words, "word_chars": count(C.NON_SPACE & C.CHAR_START),
            "n_symbols": count(SYMBOLS), "n_dup_lines": np.bincount(lrow[again], minlength=n),
            "n_repeat_words": C.sums_by_row(in_repeat, first),
            "lines": np.bincount(lrow, minlength=n), "upper": count(UPPER),
            "marks": count(MARKS), "stutter": C.sums_by_row(stutter, first)}


def features(st: dict[str, np.ndarray]) -> np.ndarray:
    """Transformed statistic vectors (rows x FEATURES): ratios per word, pulled towards PRIOR
    for short texts, on a log or square-root scale."""
    n = st["n_words"].astype(float)

    def per_word(name: str, prior: float) -> np.ndarray:
        return (st[name] + PRIOR_WORDS * prior) / (n + PRIOR_WORDS)

    return np.stack([
        np.log(per_word("word_chars", PRIOR["chars"])),
        np.sqrt(per_word("n_symbols", PRIOR["symbols"])),
        np.sqrt(per_word("upper", PRIOR["upper"])),
        np.sqrt(st["n_repeat_words"] / (n + PRIOR_WORDS)),
        np.sqrt(st["n_dup_lines"] / (st["lines"] + 20.0)),
        np.sqrt(per_word("marks", PRIOR["marks"])),
        np.sqrt(per_word("stutter", 0.0)),
    ], axis=1)


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for c in C.chunks(b.column("text")):
            st = chunk_stats(c)
            x = features(st)
            part = b.slice(c.lo, c.rows)
            bounds = np.arange(c.rows + 1) * FEATURES
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("lang"), part.column("source"),
                 *(pa.array(st[k], type=pa.int64()) for k in BASE),
                 C.lists(np.rint(x.ravel() * UNIT).astype(np.int32), bounds, pa.int32())],
                names=["doc_id", "lang", "source", *BASE, "x"])


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base statistics and the statistic vector ``x`` in units of 2^-14."""
    cols = [F.col("doc_id").cast("bigint"), F.col("text").cast("string").alias("text"),
            F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source")]
    return docs.select(*cols).mapInArrow(_stats, _SCHEMA)


def base_failed() -> F.Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def _pools(stats: DataFrame, min_rows: int) -> DataFrame:
    """lang, source -> pool: its own, its language's or the common one (null: too few rows).
    Only rows that pass the base rules count, as only they are fitted."""
    def key(level: str, *cols: str) -> Column:
        return F.to_json(F.struct(F.lit(level).alias("level"), *cols), {"ignoreNullFields": "false"})

    by = Window.partitionBy("lang")
    groups = (stats.groupBy("lang", "source").agg(F.count_if(~base_failed()).alias("n"))
              .withColumn("own", F.col("n") >= min_rows)
              .withColumn("m", F.sum(F.when(~F.col("own"), F.col("n"))).over(by))
              .withColumn("pool", F.when(F.col("own"), key("source", "lang", "source"))
                          .when(F.col("m") >= min_rows, key("lang", "lang")).otherwise(key("all"))))
    common = groups.groupBy("pool").agg(F.sum("n").alias("rows"))
    return (groups.join(common, "pool").where(F.col("rows") >= min_rows)
            .select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "pool"))


def _shape(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Moments of a pool -> location and inverse scatter (with the least deviations)."""
    for pdf in pdfs:
        rows = [(pool, *shape_of(n, m1, m2)) for pool, n, m1, m2 in zip(pdf["pool"], pdf["n"], pdf["m1"], pdf["m2"])]
        yield pd.DataFrame(rows, columns=["pool", "mean", "inv"])


def shape_of(n: int, m1, m2) -> tuple[np.ndarray, np.ndarray]:
    """Location and inverse scatter from whole-number sums of the vectors and of their products (the
    upper triangle, row by row)."""
    mean = np.asarray(m1, dtype=float) / n / UNIT
    cov = np.zeros((FEATURES, FEATURES))
    cov[np.triu_indices(FEATURES)] = np.asarray(m2, dtype=float) / n / UNIT ** 2
    cov = cov + np.triu(cov, 1).T - np.outer(mean, mean)
    return mean, np.linalg.inv(cov + np.diag(np.square(FLOOR))).ravel()


def _moments(rows: DataFrame) -> DataFrame:
    x = [F.col("x")[i].cast("bigint") for i in range(FEATURES)]
    pairs = [(i, j) for i in range(FEATURES) for j in range(i, FEATURES)]
    return rows.groupBy("pool").agg(
        F.count("*").alias("n"), F.array(*(F.sum(v) for v in x)).alias("m1"),
        F.array(*(F.sum(x[i] * x[j]) for i, j in pairs)).alias("m2"))


def _quantile(value: str, percent: int) -> Column:
    """The least of whole-number values that so many percent of the group's do not exceed: exact, from
    counts of the distinct values, which are combined before the shuffle."""
    return F.expr(f"percentile_disc({percent / 100}) WITHIN GROUP (ORDER BY {value})")


def _medians(values: list[str]) -> Column:
    """The medians of the features, from their values in units, to the middle of a coarse step."""
    return F.array(*((_quantile(f"floor({v} / {COARSE})", 50) * COARSE + COARSE / 2) / F.lit(float(UNIT))
                     for v in values))


def step_of(d2: Column) -> Column:
    """The step of a distance, ``PER_OCTAVE`` of them from one value to its double."""
    return F.floor(F.log2(F.greatest(d2, F.lit(1e-9))) * PER_OCTAVE)


def _distance(rows: DataFrame, shape: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance under the row's pool (null: no shape).  Keeps
    every row."""
    p = FEATURES
    d = [F.col("x")[i] / F.lit(float(UNIT)) - F.col("mean")[i] for i in range(p)]
    terms = [d[i] * d[i] * F.col("inv")[i * p + i] for i in range(p)]
    terms += [2.0 * d[i] * d[j] * F.col("inv")[i * p + j] for i in range(p) for j in range(i + 1, p)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return rows.join(shape, "pool", "left").withColumn("d2", total).drop("mean", "inv")


def outliers(docs: DataFrame, steps: int = STEPS, min_rows: int = MIN_ROWS, fence: float = FENCE) -> DataFrame:
    """All rows with their statistics, base verdict, final ``kept``, and ``d2`` and ``cut``: the
    robust distance and where its pool's cut lies, both over the pool's own scale.

    The first estimate of a pool is its coordinatewise median with scaled median absolute
    deviations; then ``steps`` concentration steps.  The scale of a pool is its median distance over
    the chi-square median.
    """
    stats = C.written(statistics(docs), "op8-stats")
    pools = C.written(_pools(stats, min_rows), "op8-pools")
    few = pools.select("pool").distinct().count() <= MANY_POOLS
    of_pool = F.broadcast if few else lambda t: t
    rows = stats.join(F.broadcast(pools) if pools.count() <= MANY_POOLS else pools,
                      F.col("lang").eqNullSafe(F.col("g_lang"))
                      & F.col("source").eqNullSafe(F.col("g_source")), "left").drop("g_lang", "g_source")
    rows = C.written(rows, "op8-pooled")
    C.drop(stats)
    C.tidy(docs.sparkSession)
    fit = rows.where(F.col("pool").isNotNull() & ~base_failed()).select("pool", "x")

    every = range(FEATURES)
    medians = C.written(fit.groupBy("pool").agg(_medians([f"x[{i}]" for i in every]).alias("mean")), "op8-shape")
    mad = fit.join(of_pool(medians), "pool").groupBy("pool").agg(
        _medians([f"abs(x[{i}] - mean[{i}] * {UNIT})" for i in every]).alias("at"))
    flat = F.array(*(1.0 / (F.pow(F.col("at")[i] * 1.4826, 2) + FLOOR[i] ** 2) if i == j else F.lit(0.0)
                     for i in every for j in every))
    shape = C.written(medians.join(mad, "pool").select("pool", "mean", flat.alias("inv")), "op8-shape")
    step = step_of(F.col("d2"))
    for _ in range(steps):
        near = _distance(fit, of_pool(shape)).withColumn("v", step)
        limit = near.groupBy("pool").agg(_quantile("v", SUPPORT).alias("limit"))
        core = near.join(of_pool(limit), "pool").where("v <= limit")
        shape = C.written(_moments(core).mapInPandas(
            _shape, "pool string, mean array<double>, inv array<double>"), "op8-shape")
    C.tidy(docs.sparkSession)
    quarter = lambda p: F.pow(F.lit(2.0), (_quantile("v", p) + 0.5) / PER_OCTAVE)
    cuts = (_distance(fit, of_pool(shape)).withColumn("v", step).groupBy("pool")
            .agg(*(quarter(p).alias(f"q{p}") for p in (25, 50, 75)))
            .withColumn("scale", F.greatest(F.col("q50") / CHI2_MEDIAN, F.lit(0.05)))
            .select("pool", "scale", F.greatest(F.lit(CHI2_999), F.col("q75") * F.pow(
                F.col("q75") / F.col("q25"), F.lit(fence)) / F.col("scale")).alias("cut")))
    p = C.written(shape.join(cuts, "pool"), "op8-shape")
    judged = (_distance(rows.where(F.col("pool").isNotNull()), of_pool(p))
              .withColumn("d2", F.col("d2") / F.col("scale")))
    none = F.lit(None).cast("double")
    loose = rows.where(F.col("pool").isNull()).withColumns({"d2": none, "cut": none})
    both = judged.select("doc_id", *BASE, "d2", "cut").unionByName(loose.select("doc_id", *BASE, "d2", "cut"))
    inside = F.coalesce(F.col("d2") <= F.col("cut"), F.lit(True))
    return both.select("doc_id", *BASE, base_failed().alias("base_failed"),
                       (~base_failed() & inside).alias("kept"), "d2", "cut")


def stage(docs: DataFrame) -> DataFrame:
    """Pipeline stage: the rows that neither the base rules nor the method rejects, unchanged.
    A row is known by a hash of all that it is judged by and its doc_id, as ids may be null or
    shared."""
    bad = f"{C.prefix(docs)}bad"
    key = C.row_key([F.col("doc_id").cast("bigint"),
                     *(F.col(c).cast("string") for c in ("text", "lang", "source"))])
    judged = outliers(docs.select(key.alias("doc_id"), "text", "lang", "source"))
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias(bad)).distinct()
    return docs.join(gone, key == F.col(bad), "left_anti")
