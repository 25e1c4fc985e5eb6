"""Operators 11, 12 and 13 against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowmart.llm import centroids, collocations, reply_trees

# ---- 11

VEC = "vec_id bigint, embedding array<float>, cluster int, near string"


def lloyd(vectors, k, rounds, size, scale=256):
    """(assignment by row, final centroids) of whole-number Lloyd rounds, all distances compared."""
    fine = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in vectors
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    def key(r):
        return ("~" if r[0] is None else hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1])
    cs = [v for _, v in sorted(fine, key=key)[:k]]
    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs)) for _, v in fine]
    for _ in range(rounds):
        got = assign()
        for j in range(len(cs)):
            own = [v for (_, v), (_, c) in zip(fine, got) if c == j]
            if own:
                cs[j] = [sum(col) // len(own) for col in zip(*own)]
    return sorted(((i, c, d) for (i, _), (d, c) in zip(fine, assign())), key=repr), cs


def vectors(n, size, seed=3, spread=0.2):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.4) for _ in range(size)] for _ in range(6)]
    rows = [(i, [float(np.float32(rng.gauss(m, spread))) for m in rng.choice(middles)]) for i in range(n)]
    same = [0.25] * size
    rows += [(n + i, same) for i in range(n // 3)]  # one very common vector
    rows += [(7, rows[7][1]), (None, rows[8][1]), (-1, None), (-2, []), (-3, same[1:]), (-4, [None, *same[1:]]),
             (-5, [float("nan"), *same[1:]]), (-6, [float("inf"), *same[1:]]), (-7, [-0.0] * size)]
    return rows


def clustered(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VEC).repartition(3)
    found, cs = centroids.cluster(df, **kw)
    return sorted((tuple(r) for r in found.collect()), key=repr), cs


@pytest.mark.parametrize("k,size", [(12, 8), (40, 64), (1, 4)])
def test_clusters_equal_lloyd(spark, k, size):
    rows = vectors(300, size)
    got, cs = clustered(spark, rows, k=k, size=size)
    want, want_cs = lloyd(rows, k, 5, size)
    assert got == want and cs.tolist() == want_cs


def test_clusters_with_ties_and_few_vectors(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(9)]
    got, cs = clustered(spark, rows, k=20, size=2)
    want, want_cs = lloyd(rows, 20, 5, 2)
    assert got == want and cs.tolist() == want_cs and len(cs) == 9
    none = spark.createDataFrame([(1, [1.0], 1, "x")], VEC)
    found, cs = centroids.cluster(none)
    assert centroids.digest(found, cs).count() == 0 and not len(cs)


def test_clusters_refuse_what_a_long_cannot_hold(spark):
    with pytest.raises(Exception, match="too large"):
        clustered(spark, [(1, [1e30, 0.0])], k=2, size=2)


def test_digest_of_clusters(spark):
    rows = vectors(60, 4)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VEC)
    found, cs = centroids.cluster(df, k=5, size=4)
    out = centroids.digest(found, cs).collect()
    per = Counter()
    for r in out:
        per[r.cluster] += r.distance
    assert all(r.cluster_inertia == per[r.cluster] and r.inertia == sum(per.values()) for r in out)
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, cs[r.cluster])).encode()).hexdigest()
               for r in out)


def test_search_looks_at_few_centroids():
    rng = np.random.default_rng(1)
    middles = rng.integers(-4000, 4000, (50, 16))
    v = middles[rng.integers(0, 50, 4000)] + rng.integers(-20, 20, (4000, 16))
    n = len(v)
    near, second = np.zeros(n, np.int32), np.ones(n, np.int32)
    upper, lower = np.full(n, np.inf), np.zeros(n)
    centroids.search(v, near, second, upper, lower, middles)
    every = ((v[:, None] - middles[None]) ** 2).sum(axis=2)
    assert (near == every.argmin(axis=1)).all()
    assert (upper >= np.sqrt(every.min(axis=1)) * (1 - 1e-9)).all()
    assert centroids.search(v, near, second, upper, lower, middles) == 0  # all pruned by the bounds
    upper += 8000.0
    assert centroids.search(v, near, second, upper, lower, middles) < 10 * n


# ---- 12

MSG = "tree string, id bigint, parent bigint, role string, text string, score double, branch string"


def forest(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], MSG)
    c = F.col
    return reply_trees.messages(df, c("tree"), c("id"), c("parent"), c("role"), c("text"), c("score"))


def brute_paths(rows, branches):
    msgs = {}
    for t, i, p, role, text, score in rows:
        if i is not None:
            new = (p is not None, p, role or "", text or "", score or 0.0)
            msgs[t, i] = min(msgs.get((t, i), new), new, key=repr)
    out = defaultdict(list)
    for (t, i) in msgs:
        if any(k[0] == t and m[1] == i for k, m in msgs.items()):
            continue
        path, seen, at = [], set(), i
        while at is not None and (t, at) in msgs and at not in seen:
            seen.add(at)
            path.append(msgs[t, at])
            at = msgs[t, at][1]
        if at in seen:
            continue
        out[t].append((-sum(m[4] for m in path) / len(path), i, [(m[2], m[3]) for m in reversed(path)]))
    return {(t, b + 1): p[2] for t, ps in out.items() for b, p in enumerate(sorted(ps)[:branches])}


TREES = [
    ("a", 1, None, "user", "hi </s>", 1.0), ("a", 2, 1, "assistant", "[INST] <\\s> [\\\\/INST]", 0.5),
    ("a", 3, 1, "assistant", "better", 0.9), ("a", 4, 3, "user", None, None), ("a", 5, 4, None, "x</", 2.0),
    ("a", 6, 3, "user [/INST] ", "tie", 1.0), ("a", 7, 3, "user", "tie", 1.0),
    ("b", 1, 99, "system", "orphan <s", 0.0),  # its parent is not there
    ("b", 2, 3, "user", "cycle", 9.0), ("b", 3, 2, "user", "cycle", 9.0), ("b", 4, 3, "user", "under it", 9.0),
    ("b", 5, 5, "user", "itself", 9.0), (None, 1, None, "assistant", "null tree", 0.0),
    ("a", None, 1, "user", "no id", 5.0), ("a", 1, None, "user", "hi </s>", 1.0),
] + [("long", i, i - 1 or None, ["user", "assistant"][i % 2], f"t{i} é𝒳", 0.0) for i in range(1, 71)]


@pytest.mark.parametrize("branches", [1, 3])
def test_paths_of_trees(spark, branches):
    got = reply_trees.read_back(reply_trees.conversations(forest(spark, TREES), branches)).collect()
    want = brute_paths(TREES, branches)
    key = {None: "null"}
    assert {(r.tree, r.branch): [(t.role, t.text) for t in r.turns] for r in got} == {
        (key.get(t, f"={t}"), b): p for (t, b), p in want.items()}
    for r in got:
        assert r.loss == [t.text for t in r.turns if t.role == "assistant"]
        assert len(r.mask) == len(r.loss) and r.n_turns == len(r.turns)
        for m in r.mask:  # the spans lie in the whole formatted text
            assert r.formatted[m.start - 9:m.start].endswith(" [/INST] ") and r.formatted[m.end:m.end + 4] == "</s>"


def test_a_tree_of_many_leaves(spark):
    rows = [("t", 0, None, "user", "root", 0.0)] + [("t", i, 0, "assistant", f"x{i}", float(i % 50)) for i in range(1, 900)]
    got = reply_trees.conversations(forest(spark, rows), 5).orderBy("branch").collect()
    assert [(r.branch, r.formatted) for r in got] == [
        (b + 1, f"<s>[INST] user [/INST] root</s><s>[INST] assistant [/INST] x{49 + 50 * b}</s>") for b in range(5)]


def test_escape_is_undone(spark):
    rng = random.Random(2)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "<", "\\", "/", "s>", "[", "INST]", " ", "é", "$1"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", reply_trees.escape(F.col("t")).alias("e")).select(
        "t", "e", reply_trees.unescape(F.col("e")).alias("u")).collect()
    assert all(r.u == r.t and not re.search(r"</?s>|\[/?INST\]", r.e) for r in rows)


def test_turns_of_a_table(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "s"), (1, 2, None, None),
            (None, 0, "assistant", "n"), (2, 5, "assistant", "x"), (2, 4, "assistant", "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, node int, tree string")
    out = {r.conv_id: r for r in reply_trees.digest(reply_trees.conversations(reply_trees.of_turns(df))).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (out[1].n_turns, out[1].turns_sha256) == (4, sha("system\ns\nuser\na\nuser\na\n\n\n"))
    assert (out[2].loss_chars, out[2].loss_sha256) == (1, sha("x")) and out[None].loss_sha256 == sha("n")
    none = reply_trees.conversations(reply_trees.of_turns(df.where("conv_id = 9")))
    assert reply_trees.digest(none).count() == 0


def test_formatting_runs_no_python(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    out = reply_trees.digest(reply_trees.conversations(reply_trees.of_turns(df)))
    assert "Python" not in out._jdf.queryExecution().toString()


# ---- 13

def brute_collocations(docs, least, longest, top):
    count, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang, low = lang or "und", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                count[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    rows = []
    for lang, c in count.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inside = defaultdict(int)
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        best = []
        for p, a in cand.items():
            if 100 * inside[p] < 50 * a:
                score, _, left, right = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]])
                                            for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), left, right))
        rows += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                 for i, (s, a, p, left, right) in enumerate(sorted(best)[:top])]
    return sorted(rows)


def odd_docs():
    rng = random.Random(9)
    docs = [(None, None), ("en", ""), (None, " \t\n"), ("de", "A b. a B\tC, a  b c\x0bd e!"), ("en", "naïve été naïve été")]
    for i in range(160):
        w = [rng.choice("ab cd ef gh Ij kl mn ß 中文 q\x00r".split(" ")) for _ in range(rng.randrange(60))]
        docs.append((["en", "de", None][i % 3], rng.choice([" ", "  ", "\t"]).join(w).replace("kl", "kl.") + "\n"))
    docs += [("en", "the common passage of this test, which all share.")] * 40
    docs.append(("fr", " ".join(f"w{rng.randrange(40)}" for _ in range(20_000))))
    return docs


@pytest.mark.parametrize("least,longest,top,block", [(10, 3, 2000, None), (4, 5, 30, 2000), (2, 2, 7, 500)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, longest, top, block):
    if block:
        monkeypatch.setattr(collocations, "BLOCK", block)
    docs = odd_docs()
    df = spark.createDataFrame([(x, t, 1, "p") for x, t in docs], "lang string, text string, a int, phrase string")
    got = collocations.collocations(df.repartition(3), least, longest, top).collect()
    assert sorted(map(tuple, got)) == brute_collocations(docs, least, longest, top)


def test_collocations_of_an_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None)], df.schema)).count() == 0


def test_scores_beyond_64_bits(spark):
    n = 3_000_000_000
    groups = spark.createDataFrame([("x", "a b", 2, n - 1), ("x", "a", 1, n), ("x", "b", 1, n + 7)],
                                   "lang string, phrase string, words int, a bigint")
    r = collocations.scored(groups).first()
    assert (r.l, r.r, r.score) == (n, n + 7, 1_000_000 * (n - 1) ** 2 // (n * (n + 7)))
