"""Operators 1, 3, 4, 5 and 9 and the pipeline against brute force and round trips."""

import math
import random
import re
import zlib

import cases as K
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from flowmart.llm import common as C
from flowmart.llm import (mixing, near_dedup, quality_model, quality_rules, sharding, token_output)

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
BPE = public.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return K.documents(spark).cache()


@pytest.fixture(scope="module")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


# ---- 1

def _rated(spark, n=600):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        kind = i % 3
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 80))]
        if kind == 0:
            w = [x.upper() + "!!" for x in w]
        if kind == 1:
            w[rng.randrange(len(w))] = rng.choice(["vile", "nasty"])
        docs.append((i, " ".join(w), "x"))
        labels.append((i, int(kind > 0), int(kind == 1)))
    labels += [(None, 1, 0), (5, None, None)]
    return (spark.createDataFrame(docs, "doc_id bigint, text string, kept string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_ordinal_grades(spark):
    docs, labels = _rated(spark)
    got = quality_model.grade(docs, labels.where("doc_id < 450 or doc_id is null")).collect()
    assert len(got) == 600
    held = [r for r in got if r.doc_id >= 450]
    mean = [np.mean([r.expected_grade for r in held if r.doc_id % 3 == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2]
    right = np.mean([r.kept == (r.doc_id % 3 == 2) for r in held])
    assert right > 0.9
    assert all(0 <= r.p_top <= 1 and r.expected_grade <= 2 for r in got)


def test_ordinal_without_ratings(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality_model.grade(docs, labels).collect()
    assert len(got) == docs.count() and all(r.kept for r in got)
    assert quality_model.grade(K.empty(spark), labels).count() == 0


def test_the_model_does_not_hang_on_partitions(spark):
    docs, labels = _rated(spark)
    docs = docs.unionByName(docs.limit(60)).unionByName(docs.where("doc_id % 7 = 0"))  # repeated rows and ties
    one, two = (quality_model.train(d, labels) for d in (docs.coalesce(1), docs.repartition(11)))
    assert np.array_equal(one.weights, two.weights) and one.cut == two.cut
    assert np.array_equal(one.tails(np.array([0.0, 1.0])), two.tails(np.array([0.0, 1.0])))


# ---- 3

def test_a_hot_doc_id_is_spread(spark):
    """One id, and null, in a third of all rows each: no part holds them all, and all is read back in order."""
    ids = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i) for i in range(3000)]
    rows = [(d, f"text {i} of some words") for i, d in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    path = token_output.checkpoint_dir(spark) + f"/hot-{random.random()}"
    token_output.write_ids(df, BPE, path)
    seg = spark.read.parquet(f"{path}/segments").selectExpr("part", "seq", "doc_ids").collect()
    most = max(len(r.doc_ids) for r in seg)
    assert len(seg) > 20 and most <= 4 * 3000 / 64
    order = [d for r in sorted(seg, key=lambda r: (r.part, r.seq)) for d in r.doc_ids]
    assert order == sorted(ids, key=lambda d: (d is not None, d))
    got = sorted(token_output.read_ids(spark, path).collect(), key=lambda r: r.start)
    tok = tokenizers.Tokenizer.from_file(BPE)
    assert [r.doc_id for r in got] == order
    assert sorted(tuple(r.ids) for r in got) == sorted(tuple([*tok.encode(t, add_special_tokens=False).ids, 2])
                                                       for _, t in rows)
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()

def test_ids_round_trip(spark, docs, pairs):
    tok = tokenizers.Tokenizer.from_file(BPE)
    path = token_output.checkpoint_dir(spark) + f"/ids-{random.random()}"
    token_output.write_ids(docs, BPE, path)
    got = token_output.read_ids(spark, path).collect()
    assert len(got) == len(pairs)
    ids = {}
    for d, t in pairs:
        ids.setdefault(d, []).append([*tok.encode(t or "", add_special_tokens=False).ids, 2])
    for r in got:
        assert list(r.ids) in ids[r.doc_id] and r.n_tokens == len(r.ids)
    in_order = sorted(got, key=lambda r: r.start)
    key = [-1 if r.doc_id is None else r.doc_id for r in in_order]
    assert key == sorted(key)
    assert [r.start for r in in_order] == [sum(x.n_tokens for x in in_order[:i]) for i in range(len(got))]


def test_id_digests(spark, docs, pairs):
    tok = tokenizers.Tokenizer.from_file(BPE)
    want = sorted(((d, zlib.crc32(np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()))
                   for d, t in pairs), key=repr)
    assert K.rows_of(token_output.digests(docs, BPE), "doc_id", "ids_crc32") == want
    assert token_output.digests(K.empty(spark), BPE).count() == 0


def test_pieces_give_the_tokenizers_ids():
    import pyarrow as pa

    from flowmart.llm import common as C
    tok, enc, rng = tokenizers.Tokenizer.from_file(BPE), token_output.Encoder(BPE), random.Random(1)
    parts = ["a", "B", "z", "é", "×", "÷", " ", "  ", "\n", "\t", ".", ",", "!", "?", "'", "'s", "'ll", "1", "23", " ",
             " ", "　", "中", "ß", "𝒳", "\x85", "(", "_", "-", "́", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)]
    for c in C.chunks(pa.array(texts), 4000):
        ids, b = enc.encode(c)
        for i in range(c.rows):
            assert ids[b[i]:b[i + 1]].tolist() == tok.encode(texts[c.lo + i], add_special_tokens=False).ids


def _best_size(counts, most):
    """Least total bits over all length limits, by the textbook list form of package-merge."""
    leaves = sorted((c, (i,)) for i, c in enumerate(counts))
    merged = []
    for _ in range(most):
        merged = sorted(leaves + merged)
        merged = [(merged[i][0] + merged[i + 1][0], merged[i][1] + merged[i + 1][1])
                  for i in range(0, len(merged) - 1, 2)]
    return sum(w for w, _ in merged[:len(counts) - 1])


def test_code_lengths_are_the_best_under_the_limit():
    rng = random.Random(8)
    for _ in range(200):
        counts = np.array([rng.choice([1, 1, 2, 3, 7, 100, 10**6]) for _ in range(rng.randint(2, 30))])
        for most in (5, 8, 16):
            bits = token_output.code_lengths(counts, most)
            assert bits.max() <= most and (2.0 ** -bits).sum() <= 1
            assert (bits * counts).sum() == _best_size(counts.tolist(), most)
    assert token_output.code_lengths(np.array([5])).tolist() == [1]


# ---- 4

@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, pairs, k):
    want = {}
    known = [(d if d is not None else 10**6, t) for d, t in pairs]
    for d, (n, c) in K.near_components(known, k).items():
        want[None if d == 10**6 else d] = (n, None if c == 10**6 else c)
    got = near_dedup.near_duplicates(docs, k=k).collect()
    assert len(got) == len(pairs)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_in_chains_and_boilerplate(spark):
    """A chain whose ends are far apart is one group; many texts round one passage are not linked."""
    rng = random.Random(12)
    chain = [f"c{i}" for i in range(100)]
    texts = []
    for i in range(30):
        texts.append(" ".join(chain))
        chain[(i * 37) % 100] = f"new{i}"
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(25)) for _ in range(60)]
    base = [f"b{i}" for i in range(200)]
    for _ in range(60):  # near copies of one text
        t = base.copy()
        t[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(t))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = K.near_components(list(enumerate(texts)), 5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()}
    assert got == want
    left = near_dedup.stage(df)
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, (_, c) in want.items() if d == c)


def test_near_dedup_of_null_and_shared_ids(spark):
    rng = random.Random(13)
    a, b, c, d = ([f"{x}{rng.randrange(10**6)}" for _ in range(120)] for x in "abcd")
    near = c.copy()
    near[60] = "changed"
    a, b, c, d, near = (" ".join(x) for x in (a, b, c, d, near))
    rows = [(1, a, "x"), (None, a, "x"), (None, b, "x"),  # a null-id copy of row 1, and a clean null-id row
            (None, c, "x"), (None, near, "x"),            # near copies under null ids only
            (2, d, "x"), (2, d, "x"), (2, d, "y"),        # repeated rows of the smallest id
            (7, a, "x"), (7, "one more text that has nothing in common with the others", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    left = near_dedup.stage(df)
    assert left.columns == df.columns
    got = [(r.doc_id, r.text) for r in left.collect()]
    assert got.count((None, c)) + got.count((None, near)) == 1
    assert sorted((x for x in got if x[1] not in (c, near)), key=repr) == sorted(
        [(1, a), (None, b), (2, d), (7, rows[-1][1])], key=repr)


def test_components_of_random_graphs(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(-80, 80), rng.randrange(-80, 80)) for _ in range(90)] + [(500, 501), (501, 502), (502, 503)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.comp for r in near_dedup.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: top(x) for x in up if any(x in e and e[0] != e[1] for e in edges)}
    assert near_dedup.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_table_keys_find_pairs_at_the_threshold():
    """The share of random pairs of similarity 0.8 that meet in a table is near the stated one."""
    import pyarrow as pa

    from flowmart.llm import common as C
    rng, met, n = random.Random(2), 0, 400
    texts = []
    for i in range(n):
        common = [f"{rng.randrange(10**9)}" for _ in range(80)]
        texts += [" ".join(common + [f"{rng.randrange(10**9)}" for _ in range(10)]) for _ in range(2)]
    for b in near_dedup._sign(1, near_dedup.KEYS, near_dedup.ROWS)(iter([pa.RecordBatch.from_arrays(
            [pa.array(range(2 * n)), pa.array(texts)], names=["doc_id", "text"])])):
        a, z = b.column("a").to_pylist(), b.column("b").to_pylist()
        for i in range(0, len(a), 2):
            met += any(x in a[i + 1] for x in a[i]) and any(x in z[i + 1] for x in z[i])
    assert met >= n * 0.98


# ---- 5

@pytest.mark.parametrize("n_shards", [8, 3])
def test_shards(spark, docs, n_shards):
    rng = random.Random(7)
    rows = [(i, "hot text that many rows share" if i % 3 == 0 else "t" * rng.randrange(0, 400)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("shard", F.lit("old"))
    got = sharding.shard(df, n_shards).collect()
    assert sorted(r.doc_id for r in got) == list(range(3000))
    size = [0] * n_shards
    for r in got:
        assert r["size"] == len(rows[r.doc_id][1].encode()) + 1 and r.law == "bytes"
        size[r.shard] += r["size"]
    assert max(size) - min(size) <= 2 * 401
    for s in range(n_shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    again = sharding.shard(df.repartition(5), n_shards).collect()
    place = lambda rows: sorted((r.doc_id, r.shard, r.slot) for r in rows)
    assert place(got) == place(again)


def test_shards_of_awkward_rows(spark, docs):
    got = sharding.shard(docs).collect()
    assert len(got) == docs.count()
    for s in range(8):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard(K.empty(spark)).count() == 0


def test_rows_alike_are_cut_like_any_others(spark, monkeypatch):
    """One (id, text) in a third of all rows: no range holds them all, and slots stay gapless."""
    monkeypatch.setattr(sharding, "MIN_RANGES", 64)
    rows = [(7, "one row again and again") if i % 3 == 0 else (i, f"text {i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr(
        "*", "crc32(cast(text as binary)) AS text_crc32", "1 AS __size", "2 AS __k", "3 AS k", "4 AS __", "5 AS slot")
    out = sharding.shard(df, 3)
    assert set(df.columns) <= set(out.columns)
    got = out.collect()
    assert len(got) == 6000 and all(r.text_crc32 == zlib.crc32(r.text.encode()) for r in got)
    assert all((r["__size"], r["__k"], r["k"], r["__"]) == (1, 2, 3, 4) for r in got)
    per = [sum(r["size"] for r in got if r.shard == s) for s in range(3)]
    assert max(per) - min(per) <= 60
    for s in range(3):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    keyed = C.written(sharding._keyed(df.select("doc_id", "text")), "test-keyed")
    total, n = keyed.agg(F.sum("__size"), F.count("*")).first()
    cuts = sharding.splitters(keyed.select("__size", "__k", "__i"), total, n)
    most = keyed.groupBy(sharding._range_of(cuts).alias("r")).count().agg(F.max("count")).first()[0]
    assert most <= 4 * 6000 / 64


def test_overfull_ranges_are_subdivided(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLES", 1)
    monkeypatch.setattr(sharding, "MIN_RANGES", 16)
    df = sharding._keyed(spark.createDataFrame([(i, "same") for i in range(4000)], "doc_id bigint, text string"))
    total, n = df.agg(F.sum("__size"), F.count("*")).first()
    cuts = sharding.splitters(df.select("__size", "__k", "__i"), total, n)
    most = df.groupBy(sharding._range_of(cuts).alias("r")).agg(F.sum("__size").alias("b")).agg(F.max("b")).first()[0]
    assert most <= 4 * total / 16


# ---- 9

def _targets(sizes):
    """source -> target, by resharing the excess over twice the size until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        target = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if target[s] > 2 * sizes[s]}
        if not over:
            return target | {s: 2.0 * sizes[s] for s in full}
        full |= over


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, None if i % 50 == 7 else " ".join("w" for _ in range(rng.randrange(0, 300))),
             [None, "b", "a", "Z", "é", "a", "a"][rng.randrange(7)], "x") for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, target string")
    got = mixing.takings(df).collect()
    assert len(got) == 1500
    source, sizes, took = {r[0]: r[2] for r in rows}, {}, {}
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == len(K.SPACE_WORD.findall(rows[r.doc_id][1] or "")) and r.taken <= 2 * r["size"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        took[s] = took.get(s, 0) + r.taken
    want = _targets(sizes)
    for r in got:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
    for s in want:
        assert abs(took[s] - want[s]) <= 4 * mixing.BLOCK_WORDS
    again = {r.doc_id: r.taken for r in mixing.takings(df.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in got}


@pytest.mark.parametrize("sizes", [
    {"big": 6000, **{f"s{i:02}": n for i, n in enumerate([1, 7, 40, 64, 100, 127, 128, 129, 130, 257])}},
    {"a": 30, "b": 11, None: 5}, {"one": 3}])
def test_mix_reaches_every_target(spark, sizes):
    """Sources, and whole tables, of less than a block or of a little more than some blocks."""
    rows = []
    for s, n in sizes.items():
        while n:
            k = min(n, 37)
            rows.append((len(rows), " ".join(f"w{j}" for j in range(k)), s))
            n -= k
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    want, took = _targets(sizes), dict.fromkeys(sizes, 0)
    for r in mixing.takings(df).collect():
        took[rows[r.doc_id][2]] += r.taken
        assert r.taken <= 2 * r["size"]
    assert all(abs(took[s] - want[s]) <= 0.5 + 1e-6 for s in sizes), (took, want)
    back = dict.fromkeys(sizes, 0)
    for r in mixing.mixed(df.withColumn("n_chars", F.length("text"))).collect():
        back[r.source] += len(r.text.split())
    assert back == took


def _brute_mix(rows, targets, block, kind):
    """(key, id) -> (words and slot of each copy), by walking the sequence slot by slot.  rows: key,
    id, size, source."""
    order = sorted((s for s in targets if s is not None)) + [s for s in targets if s is None]
    stream = {s: sorted((k, i, n) for k, i, n, x in rows if x == s and n) for s in order}
    size = {s: sum(n for *_, n in stream[s]) for s in order}
    want = {s: math.floor(targets[s] + 0.5) for s in order}
    blocks = {s: -(-size[s] // block) for s in order if size[s]}
    need = {s: want[s] // size[s] * blocks[s] + -(-(want[s] % size[s]) // block) for s in blocks}
    edges, n = [], 0
    for s in order:
        if need.get(s):
            n += need[s]
            edges.append((n, s))
    got = {s: [] for s in order}
    i = 0
    while any(len(got[s]) < need[s] for s in need):
        if kind == "corput":
            x = int(bin(i + 1)[:1:-1].ljust(52, "0"), 2) / 2 ** 52
        else:
            x = math.fmod(math.fmod((i >> 20) * mixing._GOLDEN_HIGH, 1.0) + (i % (1 << 20) + 0.5) * mixing.GOLDEN, 1.0)
        s = next(s for e, s in edges if min(int(x * n), n - 1) < e)
        if len(got[s]) < need[s]:
            got[s].append(i)
        i += 1
    out = {}
    for s in blocks:
        at = 0
        for k, doc, m in stream[s]:
            copies = []
            for use in range(2):
                words = 0
                for b in range(at // block, (at + m - 1) // block + 1):
                    if use * blocks[s] + b < need[s]:
                        full = min(block, size[s] - b * block, want[s] - use * size[s] - b * block)
                        words += max(0, min(b * block + full, at + m) - max(b * block, at))
                first = use * blocks[s] + at // block
                copies.append((words, got[s][first] if first < need[s] else None))
            out[k, doc] = copies
            at += m
    return out


@pytest.mark.parametrize("block", [128, 5])
def test_mix_equals_a_walk_through_the_slots(spark, block):
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(rng.randrange(0, 90))),
             [None, "b", "a", "Z", "é", "a", "a", f"tiny{i}"][rng.randrange(8)]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    slots = {}
    for kind in ("golden", "corput"):
        got = mixing.takings(df, block, kind).collect()
        sizes = {}
        for r in got:
            sizes[rows[r.doc_id][2]] = r.source_size
        want = _brute_mix([(r.key, r.doc_id, r["size"], rows[r.doc_id][2]) for r in got], _targets(sizes), block, kind)
        mine = {(r.key, r.doc_id): list(zip(r.copies, r.slots)) if r.copies else [(0, None)] * 2
                for r in got if r["size"]}
        assert mine == want
        slots[kind] = {k: [s for _, s in v] for k, v in mine.items()}
    assert slots["golden"] != slots["corput"]  # the points decide the order
    mix = mixing.mixed(df, block, slot="at")
    places = [r["at"] for r in mix.toLocalIterator()]
    assert places == sorted(places) and len(places) > 400
    # the mix is near its weights in every stretch: no source is far from its share at any point
    of = [r.source for r in mix.collect()]
    half = of[:len(of) // 2].count("a") / of.count("a")
    assert 0.4 < half < 0.6


def test_mixed_rows(spark, docs):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    took = {(r.doc_id, r["size"]): r.taken for r in mixing.takings(docs).collect()}
    whole = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        assert r.text == whole[r.doc_id] or K.SPACE_WORD.findall(r.text) == K.SPACE_WORD.findall(
            whole[r.doc_id])[:len(K.SPACE_WORD.findall(r.text))]
        assert r.n_chars == len(r.text)
    assert sum(took.values()) > 0
    assert mixing.takings(K.empty(spark)).count() == 0 and mixing.mixed(K.empty(spark)).count() == 0


# ---- pipeline

SF = "/root/testdata/sf0.001"


def test_pipeline_against_brute_force(spark):
    """Each stage on what the one before kept: stage 8 by its own verdicts, the others by brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality_rules", "near_dedup", "decontaminate", "mixing", "sharding"]

    one = stage["quality_rules"](spark, docs, SF).cache()
    verdict = {r.doc_id for r in quality_rules.outliers(docs).where("kept").collect()}
    assert {r.doc_id for r in one.collect()} == verdict and one.columns == docs.columns

    two = stage["near_dedup"](spark, one, SF).cache()
    rows = [(r.doc_id, r.text) for r in one.collect()]
    assert sorted(r.doc_id for r in two.collect()) == sorted(
        d for d, (_, c) in K.near_components(rows, 5).items() if d == c)

    three = stage["decontaminate"](spark, two, SF).cache()
    rows = [(r.doc_id, r.text) for r in two.collect()]
    assert sorted(r.doc_id for r in three.collect()) == [d for d, _, hit, _ in K.contaminated(rows, bench) if not hit] \
        or {r.doc_id for r in three.collect()} == {d for d, _, hit, _ in K.contaminated(rows, bench) if not hit}

    four = stage["mixing"](spark, three, SF).cache()
    assert four.columns == docs.columns
    took = {r.doc_id: r.taken for r in mixing.takings(three).collect()}
    words = {}
    for r in four.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert words == {d: t for d, t in took.items() if t}

    five = stage["sharding"](spark, four, SF).collect()
    assert len(five) == four.count()
    for s in range(8):
        slots = sorted(r.slot for r in five if r.shard == s)
        assert slots == list(range(len(slots)))


def test_empty_tables_pass_every_stage(spark, tmp):
    none = K.empty(spark)
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.stage(none).columns == none.columns
    none.write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp}/benchmark.parquet")
    out = corpus_pipeline.run(spark, tmp)
    assert out.count() == 0 and set(none.columns) - {"size"} <= set(out.columns)


def test_nothing_but_rows_without_words(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (2, " \n"), (None, None)], "doc_id bigint, text string")
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == 4 and all(r.n_shingles == 0 and r.kept for r in got)
    assert near_dedup.stage(df).count() == 4
