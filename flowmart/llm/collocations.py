r"""Phrase collocation mining by set-oriented relational steps, SETM (operator 13).

Texts are lower-cased (A-Z), split at ``[.,;:!?\x0A-\x0D]`` into pieces and those into words
``[^\x20\x09]+``.  Everything is counted per language.

The relation R1 (piece, position, word) is persisted sorted, in blocks of whole documents.  For each
length k the occurrences of R(k-1) are merge-joined with themselves by piece and adjacent position;
as they are sorted, that is a comparison of neighbours.  The phrases are then counted: every block
sends each distinct phrase once, with its count (so a phrase that a third of all documents hold is
combined before the shuffle), packed by hash bucket; a bucket's task adds the counts up.  The groups
found ``LEAST`` times or more go back to the blocks, one bit for each phrase sent, and the semi-join
with them leaves R(k), from which the next length grows: an occurrence is extended only if the
phrases at its place and at the next place are both frequent.  One block per frequent phrase, its
owner, hands on its words and count; from there on all is joins over the frequent groups.

A candidate (2 to ``longest`` words) scores floor(10^6 * a * a / (l * r)) by its worst cut, in exact
decimals.  Candidates inside a longer one that has half their occurrences or more are dropped.

Two phrases count as equal if 64 hash bits and their bucket (an independent hash) agree.

Defined cases: null text is empty; a null language is ``und``; repeated rows count separately; an
empty table gives an empty result.  Only lang and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm import common as C

LEAST = 10
LONGEST = 3
#: a candidate goes if a longer one around it has this share of its occurrences, in percent
SHARE = 50
TOP = 2000
BLOCK = 1 << 20
#: phrases that one bucket should hold, and parts that a language is ranked in first
BUCKET_PHRASES = 4_000_000
RANK_PARTS = 64

NO_BLANK = C._byte_class([b for b in range(256) if b not in (0x20, 0x09)])
BREAK = C._byte_class([*b".,;:!?", *range(0x0A, 0x0E)])

_BLOCKS = ("block bigint, words bigint, langs array<string>, n array<bigint>, lang binary, "
           "dictionary binary, codes binary, joined binary")
_SENT = "level int, bucket int, block bigint, hashes binary, counts binary"
_ANSWER = "level int, bucket int, block bigint, frequent binary, owned binary, counts binary"
_GROUPS = "lang string, phrase string, words int, a bigint"


def _zip(a: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a if isinstance(a, bytes) else a.tobytes())


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _lang_seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _relation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) -> blocks: a dictionary of the block's words by language, and the sorted
    occurrences: each one's word, and whether it follows the one before it in the same piece."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        langs_of = batch.column("lang").to_pylist()
        for c in C.chunks(batch.column("text"), BLOCK):
            low = C.LOWER[c.buf]
            cut = BREAK[low]
            s, e, first = C.word_spans(low, c.off, NO_BLANK & ~BREAK)
            row = C.rows_of_words(first)
            langs, of_row = np.unique(np.array(langs_of[c.lo:c.hi], dtype=object).astype(str), return_inverse=True)
            lang = of_row[row]
            seeds = np.array([_lang_seed(x) for x in langs], dtype=np.uint64)
            h = C.mix64(C.span_hashes(low, s, e) ^ seeds[lang])
            _, lead, codes = np.unique(h, return_index=True, return_inverse=True)
            pieces = np.zeros(len(low) + 1, dtype=np.int64)
            np.cumsum(cut, out=pieces[1:])
            joined = np.zeros(len(s), dtype=bool)
            joined[1:] = (row[1:] == row[:-1]) & (pieces[s[1:]] == pieces[s[:-1]])
            size = e[lead] - s[lead]
            off = np.zeros(len(lead) + 1, dtype=np.int64)
            np.cumsum(size + 1, out=off[1:])
            text = np.full(off[-1], 10, dtype=np.uint8)
            text[np.arange(off[-1] - len(lead)) + np.repeat(np.arange(len(lead)), size)] = low[
                np.arange(size.sum()) + np.repeat(s[lead] - (off[:-1] - np.arange(len(lead))), size)]
            yield pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([len(s)], pa.int64()),
                C.lists(langs.tolist(), np.array([0, len(langs)]), pa.string()),
                C.lists(np.bincount(lang, minlength=len(langs)), np.array([0, len(langs)]), pa.int64()),
                *(pa.array([_zip(x)], pa.binary()) for x in (
                    lang[lead].astype(np.int32), text, codes.astype(np.int32), np.packbits(joined)))],
                names=["block", "words", "langs", "n", "lang", "dictionary", "codes", "joined"])
            number += 1


class Occurrences:
    """The sorted occurrence relation of one block, level by level."""

    def __init__(self, row: dict, buckets: int):
        self.buckets = buckets
        self.langs = row["langs"]
        self.lang = np.frombuffer(_unzip(row["lang"]), dtype=np.int32)
        self.text = np.frombuffer(_unzip(row["dictionary"]), dtype=np.uint8)
        self.codes = np.frombuffer(_unzip(row["codes"]), dtype=np.int32)
        n = len(self.codes)
        joined = np.unpackbits(np.frombuffer(_unzip(row["joined"]), np.uint8), count=n).astype(bool)
        self.piece = np.cumsum(~joined)
        self.end = np.flatnonzero(self.text == 10)
        self.begin = np.append(0, self.end[:-1] + 1)[:len(self.end)]
        seeds = np.array([_lang_seed(x) for x in self.langs], dtype=np.uint64)
        self.word = C.mix64(C.span_hashes(self.text, self.begin, self.end) ^ seeds[self.lang])[self.codes]
        self.level = 0
        self.at = np.arange(n + 1)  # places where R(level) occurs

    def extend(self) -> None:
        """R(level) merge-joined by piece and next position; its distinct phrases in the order in
        which they travel: by bucket, then hash."""
        k = self.level = self.level + 1
        start, h = C.window_hashes(self.word, self.piece, k)
        _, other = C.window_hashes(C.mix64(self.word), self.piece, k)
        alive = np.zeros(len(self.word) + 1, dtype=bool)
        alive[self.at[self.at < len(self.word)]] = True
        grown = alive[start] & (alive[start + 1] if k > 1 else True)
        self.start, h, other = start[grown], h[grown], other[grown]
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[order[1:]] != h[order[:-1]]
        group = np.cumsum(new) - 1
        lead = order[new]
        count = np.bincount(group, minlength=len(lead))
        bucket = ((other[lead] >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        sent = np.argsort(bucket, kind="stable")
        self.bounds = np.searchsorted(bucket[sent], np.arange(self.buckets + 1))
        self.hashes, self.counts = h[lead][sent], count[sent].astype(np.int32)
        self.lead = self.start[lead][sent]
        place = np.empty(len(lead), dtype=np.int64)
        place[sent] = np.arange(len(lead))
        self.place = np.empty(len(h), dtype=np.int64)
        self.place[order] = place[group]

    def keep(self, answers: list[dict]) -> list[tuple[int, int]]:
        """Semi-join with the frequent groups.  Returns (place, count) of the phrases owned here."""
        frequent = np.zeros(len(self.hashes), dtype=bool)
        owned = []
        for a in answers:
            if a["level"] != self.level:
                continue
            lo, hi = self.bounds[a["bucket"]], self.bounds[a["bucket"] + 1]
            frequent[lo:hi], own = (np.unpackbits(np.frombuffer(a[c], np.uint8), count=hi - lo).astype(bool)
                                    for c in ("frequent", "owned"))
            owned += zip(self.lead[lo:hi][own].tolist(), np.frombuffer(a["counts"], np.int64).tolist())
        self.at = self.start[frequent[self.place]]
        return owned

    def phrase(self, p: int) -> str:
        return b" ".join(self.text[self.begin[c]:self.end[c]].tobytes()
                         for c in self.codes[p:p + self.level]).decode("utf-8", "replace")

    def sent(self, block: int) -> pa.Table:
        full = np.flatnonzero(np.diff(self.bounds))
        cut = lambda x: [x[self.bounds[i]:self.bounds[i + 1]].tobytes() for i in full]
        return pa.table([
            pa.array(np.full(len(full), self.level), pa.int32()), pa.array(full, pa.int32()),
            pa.array(np.full(len(full), block), pa.int64()), pa.array(cut(self.hashes), pa.binary()),
            pa.array(cut(self.counts), pa.binary())], names=["level", "bucket", "block", "hashes", "counts"])


def _first(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                occ = Occurrences(row, buckets)
                occ.extend()
                yield from occ.sent(row["block"]).to_batches()
    return run


def _next(buckets: int, upto: int):
    """Blocks and their answers up to level ``upto`` -> the phrases of the next level."""
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        got = answers.to_pylist()
        out = []
        for row in blocks.to_pylist():
            occ = Occurrences(row, buckets)
            for _ in range(upto):
                occ.extend()
                occ.keep(got)
            occ.extend()
            out.append(occ.sent(row["block"]))
        return pa.concat_tables(out)
    return run


def _groups(buckets: int, longest: int):
    """Blocks and all their answers -> the frequent phrases that they own."""
    def run(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        got = answers.to_pylist()
        out: dict[str, list] = {"lang": [], "phrase": [], "words": [], "a": []}
        for row in blocks.to_pylist():
            occ = Occurrences(row, buckets)
            for k in range(1, longest + 1):
                occ.extend()
                for p, n in occ.keep(got):
                    out["lang"].append(occ.langs[occ.lang[occ.codes[p]]])
                    out["phrase"].append(occ.phrase(p))
                    out["words"].append(k)
                    out["a"].append(n)
        return pa.table({"lang": pa.array(out["lang"], pa.string()), "phrase": pa.array(out["phrase"], pa.string()),
                         "words": pa.array(out["words"], pa.int32()), "a": pa.array(out["a"], pa.int64())})
    return run


def _count(least: int):
    """A bucket's phrases -> for every block, which of its phrases are frequent, which of those it
    owns (the lowest block number does) and their counts."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes")]
        counts = [np.frombuffer(x.as_buffer(), np.int32) for x in table.column("counts")]
        h, n = np.concatenate(hashes), np.concatenate(counts).astype(np.int64)
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), dtype=bool)
        new[1:] = h[order[1:]] != h[order[:-1]]
        total = np.add.reduceat(n[order], np.flatnonzero(new))
        enough = total >= least
        of = np.cumsum(new) - 1
        frequent, owned = np.zeros(len(h), dtype=bool), np.zeros(len(h), dtype=bool)
        frequent[order] = enough[of]
        owned[order[new][enough]] = True
        sums = np.zeros(len(h), dtype=np.int64)
        sums[order] = total[of]
        edge = np.cumsum([0, *map(len, hashes)])
        part = lambda f: pa.array([f(lo, hi) for lo, hi in zip(edge[:-1], edge[1:])], pa.binary())
        return pa.table({
            "level": table.column("level"), "bucket": table.column("bucket"), "block": table.column("block"),
            "frequent": part(lambda lo, hi: np.packbits(frequent[lo:hi]).tobytes()),
            "owned": part(lambda lo, hi: np.packbits(owned[lo:hi]).tobytes()),
            "counts": part(lambda lo, hi: sums[lo:hi][owned[lo:hi]].tobytes())})
    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, a) of all phrases of 1 to ``longest`` words found ``least`` times or
    more; (lang, n) the number of words per language)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.col("text").cast("string").alias("text"))
    blocks = C.written(rows.mapInArrow(_relation, _BLOCKS), "op13-relation")
    words = blocks.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // BUCKET_PHRASES))
    relation = blocks.drop("words", "n")
    answers = None
    for k in range(1, longest + 1):
        sent = (relation.mapInArrow(_first(buckets), _SENT) if answers is None else
                relation.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
                    _next(buckets, k - 1), _SENT))
        counted = C.written(sent.groupBy("bucket").applyInArrow(_count(least), _ANSWER), "op13-answers")
        answers = counted if answers is None else answers.unionByName(counted)
    groups = C.written(relation.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _groups(buckets, longest), _GROUPS), "op13-groups")
    n = blocks.select(F.explode(F.arrays_zip("langs", "n")).alias("x")).groupBy(
        F.col("x.langs").alias("lang")).agg(F.sum("x.n").alias("n"))
    n = C.written(n, "op13-sizes")
    C.drop(answers)
    C.drop(blocks)
    return groups, n


def _part(words: Column, at: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, at, size), " ")


def scored(groups: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, score of every candidate: its lowest-scoring cut, ties to the
    shortest first part."""
    w = F.split("phrase", " ")
    cuts = (groups.where("words >= 2").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumns({"left": _part(w, F.lit(1), F.col("cut")),
                          "right": _part(w, F.col("cut") + 1, F.col("words") - F.col("cut"))}))
    of = lambda part, n: groups.select("lang", F.col("phrase").alias(part), F.col("a").alias(n))
    both = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    both = both.withColumns({"aa": wide("a") * wide("a"), "lr": wide("l") * wide("r")})
    both = both.withColumn("score", F.expr("(1000000 * aa) div lr"))
    low = both.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    return low.select("lang", "phrase", "words", "a", "m.l", "m.r", "m.score")


def covered(groups: DataFrame, share: int = SHARE) -> DataFrame:
    """(lang, phrase) of the candidates that a longer one around them has ``share`` % of."""
    w = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: _part(w, at, size))))
    parts = (groups.where("words >= 3").select("lang", "a", F.explode(F.array_distinct(inner)).alias("phrase"))
             .groupBy("lang", "phrase").agg(F.max("a").alias("most")))
    return (groups.join(parts, ["lang", "phrase"]).where(F.col("most") * 100 >= F.col("a") * share)
            .select("lang", "phrase"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    groups, n = frequent_phrases(docs, least, longest)
    left = scored(groups).join(covered(groups), ["lang", "phrase"], "left_anti")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    some = (left.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order)))
            .where(F.col("rank") <= top))
    best = (some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
            .where(F.col("rank") <= top))
    return best.join(n, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r",
                                       "n", "score")
