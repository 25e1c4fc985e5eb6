r"""Personal data by weak supervision (operator 7), DataFrame functions only.

Base spans are e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone numbers; they
always stand.  The method adds spans: every number-like or address-like piece of text is a
candidate (shapes of national numbers are tried first, so neighbouring numbers stay apart), and
labelers vote on it (+1 personal, -1 not, 0 no opinion):

* regex labelers: the base patterns themselves, and the shapes of national numbers;
* gazetteer labelers: contact words before the span, to which the words are added that stand before
  base spans in this corpus and rarely before other numbers (at most ``LEARNED``); words of versions,
  licences and references;
* context labelers: whether the span stands alone, its number of digits, grouping marks.

Votes of all candidates, those inside base spans too, are counted per pattern (at most 3^7 of them,
whatever the corpus size).  Expectation-maximisation estimates each labeler's reliability and the
posterior of every pattern.  The span classifier is a logistic regression on what the span itself is
(digits, groups, marks, its first character, its neighbours, the word before it), which is not what
the labelers say; it is fitted to the posteriors of a bounded sample of candidates (``SAMPLE``, by
hash) and scored in Spark by sums of looked-up weights.  A candidate that overlaps no base span is added
as kind ``other`` if the classifier gives it at least ``THRESHOLD``.

No shuffle moves texts: candidates are arrays in the document's row.  Offsets are code points, the
prefix sums of the lengths of the pieces between matches, found by doubling: n matches in a text cost
n log n.  Overlaps are found by binary search.  Patterns use possessive runs, so long runs of digits
or letters cost linear time.

Defined cases: a null text counts as empty; repeated rows are judged alike; an empty table gives
an empty result; without any candidate the classifier rejects all.  Only doc_id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.llm import common as C

# Base patterns.  \G (the end of the match before) or a look-behind lets a match start only
# where a leftmost match can: at the start of a run.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "other"]

# Further candidates: shapes of national numbers, other number-like pieces, and addresses spelled with
# marks or words for @.
SHAPE = (r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
         r"|0[0-9](?:[\x20.-][0-9]{2}){4}|0[0-9]{2,4}[\x20/-][0-9]{6,8}")
OTHER = (rf"(?<![0-9A-Za-z])(?<![0-9][.-])(?:{SHAPE})(?![0-9]|[.-][0-9])"
         r"|(?<![0-9A-Za-z])[+(]?[0-9]++(?:[\x20().:/-]{1,2}[0-9]++)*+(?![A-Za-z])"
         r"|[A-Za-z0-9._%+-]{2,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9.-]{3,64}+")
AT = r"[\[(](?i:at)[\])]"
# Words that stand before personal data, and before numbers that are not.
CONTACT = ("phone tel telefon telephone teléfono mobile mobil handy call fax contact kontakt contacto "
           "mail email e-mail correo courriel card karte carte tarjeta iban ssn passport account "
           "konto compte cuenta ip address adresse").split()
REFERENCE = ("version license licence licensed page seite chapter kapitel section figure fig table "
             "isbn issn doi rfc edition volume vol no nr line row apache cc by step copyright").split()
CONTEXT = 30
LABELERS = 7
THRESHOLD = 0.9
#: candidates that the classifier is fitted on; words that a gazetteer learns, and how often and how
#: mostly they must stand before base spans
SAMPLE = 20_000
LEARNED, LEARNED_TIMES, LEARNED_SHARE = 500, 20, 0.9
#: classes that the word before a span is hashed to
WORDS = 256
PRIOR = 0.5
_IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"

_SPAN = "array<struct<s:int,e:int,m:string,before:string,after:string>>"
_STEPS = [1 << b for b in reversed(range(26))]


def _bound(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once: a lambda's argument is not an expression that
    is copied to each place that reads it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def scanned(xs: Column, op) -> Column:
    """Inclusive prefix results of an array of ints under ``op``, by doubling: after the step of k each
    entry holds its last 2k entries."""
    steps = F.filter(F.array(*(F.lit(k) for k in reversed(_STEPS))), lambda k: k < F.size(xs))

    def step(acc: Column, k: Column) -> Column:
        ahead = F.concat(F.array_repeat(F.lit(None).cast("int"), k), F.slice(acc, F.lit(1), F.size(acc) - k))
        return F.zip_with(acc, ahead, lambda a, b: F.when(b.isNull(), a).otherwise(op(a, b)))

    return F.aggregate(steps, xs.cast("array<int>"), step)


def _spans(text: Column, pattern: str) -> Column:
    """All matches with their code point offsets and the text around them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(found.alias("m"), F.split(text, pattern, -1).alias("p"))

    def spans(x: Column) -> Column:
        n = F.size(x["m"])
        before, after = F.slice(x["p"], F.lit(1), n), F.slice(x["p"], F.lit(2), n)
        length = F.zip_with(before, x["m"], lambda a, m: F.char_length(a) + F.char_length(m))
        around = F.zip_with(before, after, lambda a, z: F.struct(
            F.right(a, F.lit(CONTEXT)).alias("a"), F.left(z, F.lit(CONTEXT)).alias("z")))
        ends = F.zip_with(_bound(length, lambda v: scanned(v, lambda a, b: a + b)), x["m"],
                          lambda e, m: F.struct(e.alias("e"), m.alias("m")))
        return F.zip_with(ends, around, lambda t, c: F.struct(
            (t["e"] - F.char_length(t["m"])).alias("s"), t["e"].alias("e"), t["m"].alias("m"),
            c["a"].alias("before"), c["z"].alias("after")))

    return F.when(text.rlike(pattern), _bound(both, spans)).otherwise(F.array().cast(_SPAN)).cast(_SPAN)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _n_digits(m: Column) -> Column:
    return F.length(_digits(m))


def _luhn(m: Column) -> Column:
    return F.call_function("luhn_check", _digits(m))


def _valid(kind: str):
    def test(x: Column) -> Column:
        m = x["m"]
        if kind == "ip":
            return m.rlike(_IP_PARTS)
        if kind == "card":
            return _n_digits(m).between(14, 19) & _luhn(m)
        if kind == "phone":
            return _n_digits(m).between(10, 15)
        return F.lit(True)
    return test


def _word(before: Column) -> Column:
    """The word that ends the text before a span, in lower case ('' if there is none)."""
    return F.lower(F.regexp_extract(before, r"([\p{L}]+)[\s.:#-]{0,3}$", 1))


def _votes(x: Column, learned: Column) -> list[Column]:
    """One vote per labeler.  ``learned`` are the contact words of this corpus."""
    m, before, after = x["m"], x["before"], x["after"]
    n = _n_digits(m)
    number = ~m.rlike("[A-Za-z]")  # digits say nothing about a spelled address

    def vote(yes: Column, no: Column | None = None) -> Column:
        v = F.when(yes, 1)
        return (v if no is None else v.when(no, -1)).otherwise(0)

    contact = r"(?i)(?<![\p{L}])(?:" + "|".join(CONTACT) + r")[\s.:#-]{0,3}(?:(?:is|ist|est|es)\s)?$"
    reference = r"(?i)(?<![\p{L}])(?:" + "|".join(REFERENCE) + r")[\s.:#-]{0,3}$"
    return [
        # regex: base patterns
        vote(m.rlike(r"^\+[0-9]") & n.between(10, 15) | m.rlike(f"^{EMAIL}$") | m.rlike(_IP_PARTS)
             | n.between(14, 19) & _luhn(m), number & ((n < 7) | (n > 13))),
        # regex: shapes of national phone and social numbers; of dates, short numbers and
        # numbers as long as a card's whose check digit is wrong
        vote(m.rlike(rf"^(?:{SHAPE})$|{AT}"),
             m.rlike(r"^(?:1[0-9]|20)[0-9]{2}(?:[-/:.][0-9]{1,2}){0,2}$|^[0-9]{1,3}(?:[.,:/][0-9]{1,3}){0,2}$")
             | n.between(14, 19) & ~_luhn(m)),
        # gazetteers
        vote(before.rlike(contact) | F.array_contains(learned, _word(before))),
        vote(F.lit(False), before.rlike(reference)),
        # context: attached to letters or marks of code
        vote(F.lit(False), before.rlike(r"[\p{L}_=/#.\"'&-]$") | after.rlike(r"^[\p{L}_=/#\"'&-]")),
        # context: number of digits, or a dotted host after the word for @
        vote(number & n.between(9, 13) | m.rlike(AT + r"\x20?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"),
             number & ((n < 7) | (n > 19)) | ~number & ~m.rlike(r"\.")),
        # context: grouping marks
        vote(m.rlike(r"[0-9][\x20().-]+[0-9]+[\x20().-]+[0-9]") & (n >= 9), ~m.rlike(r"[^0-9]")),
    ]


#: classes of each feature of a span
FEATURES = [12, 8, 6, 6, 6, 6, WORDS]


def _features(x: Column) -> list[Column]:
    """What the span is, one class per feature."""
    m, before, after = x["m"], x["before"], x["after"]
    n = _n_digits(m)
    marks = F.regexp_replace(m, r"[0-9A-Za-z+]", "")
    groups = F.size(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)))

    def first_of(*tests: Column) -> Column:
        """The place of the first test that holds, from 0; the number of tests if none does."""
        out = F.when(tests[0], 0)
        for i, t in enumerate(tests[1:], 1):
            out = out.when(t, i)
        return out.otherwise(len(tests))

    def side(text: Column, pattern: str) -> Column:
        kinds = [r"\p{L}", r"\s", r"[.,;:!?]", r"[\[\](){}\"']"]
        return first_of(text == "", *(text.rlike(pattern.replace("@", k)) for k in kinds))

    return [
        first_of(n == 0, n <= 3, n <= 6, n <= 8, n == 9, n == 10, n == 11, n <= 13, n <= 16, n <= 19, n <= 25),
        first_of(marks == "", marks.rlike("^-+$"), marks.rlike("^ +$"), marks.rlike(r"^\.+$"), marks.rlike("^[/:]+$"),
                 marks.rlike(r"^[()\x20-]+$"), m.rlike("[A-Za-z]")),
        F.least(groups, F.lit(FEATURES[2] - 1)),
        first_of(m.startswith("+"), m.startswith("("), m.startswith("0"), m.rlike("^[0-9]"), m.rlike(AT)),
        side(before, "@$"), side(after, "^@"),
        F.pmod(F.hash(_word(before)), F.lit(WORDS))]


def _code(x: Column, learned: Column) -> Column:
    """The vote pattern as one number in base 3."""
    code = F.lit(0)
    for v in _votes(x, learned):
        code = code * 3 + (v + 1)
    return code


def _pattern(code: int) -> list[int]:
    votes = []
    for _ in range(LABELERS):
        votes.append(code % 3 - 1)
        code //= 3
    return votes[::-1]


def reliabilities(counts: dict[int, int], rounds: int = 50) -> tuple[float, list, dict[int, float]]:
    """Expectation-maximisation over vote patterns: the share of personal spans, per labeler the
    probabilities of its votes (-1, 0, 1) for both classes, and the posterior of each pattern."""
    pats = {c: _pattern(c) for c in counts}
    # at first, each pattern is judged by its plain majority
    post = {c: 1 / (1 + math.exp(-1.5 * sum(p))) for c, p in pats.items()}
    total = sum(counts.values())
    share, table = PRIOR, []
    for _ in range(rounds):
        share = (sum(post[c] * n for c, n in counts.items()) + 1) / (total + 2)
        table = []
        for j in range(LABELERS):
            rates = []
            for y in (0, 1):
                seen = [1.0, 1.0, 1.0]
                for c, n in counts.items():
                    seen[pats[c][j] + 1] += n * (post[c] if y else 1 - post[c])
                rates.append([v / sum(seen) for v in seen])
            table.append(rates)
        for c, p in pats.items():
            odds = math.log(share / (1 - share)) + sum(
                math.log(table[j][1][v + 1] / table[j][0][v + 1]) for j, v in enumerate(p))
            post[c] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return share, table, post


def classifier(rows: list[tuple[tuple[int, ...], float]], rounds: int = 200) -> list[list[float]]:
    """Logistic weights of every class of every feature, and the bias last, fitted to (features,
    posterior) by gradient steps with a small penalty."""
    seen: dict[tuple[int, ...], list[float]] = {}
    for f, y in rows:
        have = seen.setdefault(f, [0.0, 0.0])
        have[0] += 1
        have[1] += y
    total = max(1, len(rows))
    w, bias = [[0.0] * n for n in FEATURES], 0.0
    for _ in range(rounds):
        grad, gb = [[1e-3 * v for v in own] for own in w], 0.0
        for f, (n, y) in seen.items():
            z = bias + sum(own[k] for own, k in zip(w, f))
            d = (n / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y) / total
            gb += d
            for own, k in zip(grad, f):
                own[k] += d
        w = [[a - 2.0 * g for a, g in zip(own, by)] for own, by in zip(w, grad)]
        bias -= 2.0 * gb
    return [*w, [bias]]


def _score(w: list[list[float]], features: Column) -> Column:
    """The classifier's probability, from the classes of a span."""
    z = F.lit(w[-1][0])
    for i, own in enumerate(w[:-1]):
        z = z + F.element_at(F.array(*map(F.lit, own)), features[i] + 1)
    return 1 / (1 + F.exp(-z))


_OTHER = "s:int,e:int,m:string,before:string,after:string,free:boolean"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, the spans of each base kind (with the word before them), and ``other``: all candidates
    with the text around them; ``free`` are those that overlap no base span."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digits = text.rlike("[0-9]")
    none = F.array().cast(_SPAN)
    guard = {"email": F.contains(text, F.lit("@")), "ip": digits, "card": digits,
             "phone": digits & F.contains(text, F.lit("+"))}
    found = {k: F.when(guard[k], F.filter(_spans(text, p), _valid(k))).otherwise(none)
             for k, p in zip(BASE, (EMAIL, IP, CARD, PHONE))}
    other = F.when(digits | text.rlike(AT), _spans(text, OTHER)).otherwise(none)
    df = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                     *(v.alias(k) for k, v in found.items()), other.alias("other"))
    ends = lambda k: F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))
    base = F.array_sort(F.concat(*(ends(k) for k in BASE)))

    def free_of(b: Column) -> Column:
        """The candidates, each with whether a base span that starts before its end ends after its start."""
        def free(x: Column) -> Column:
            before = F.aggregate(F.array(*map(F.lit, _STEPS)), F.lit(0), lambda at, step: F.when(
                F.get(b["s"], at + step - 1) < x["e"], at + step).otherwise(at))
            return ~F.coalesce(F.get(b["top"], before - 1) > x["s"], F.lit(False))
        return F.transform("other", lambda x: F.struct(
            *(x[c].alias(c) for c in ("s", "e", "m", "before", "after")), free(x).alias("free")))

    tops = _bound(base, lambda v: F.struct(
        F.transform(v, lambda x: x["s"]).alias("s"),
        scanned(F.transform(v, lambda x: x["e"]), lambda p, q: F.greatest(p, q)).alias("top")))
    near = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), _word(x["before"]).alias("word"))
    return df.select("doc_id", *(F.transform(k, near).alias(k) for k in BASE),
                     _bound(tops, free_of).cast(f"array<struct<{_OTHER}>>").alias("other"))


def learned_words(cand: DataFrame) -> list[str]:
    """Words that stand before base spans, often and mostly: a gazetteer of this corpus."""
    base = cand.select(F.explode(F.concat(*(F.transform(k, lambda x: x["word"]) for k in BASE))).alias("w"))
    rest = cand.select(F.explode(F.transform(F.filter("other", lambda x: x["free"]), lambda x: _word(x["before"])))
                       .alias("w"))
    both = (base.withColumn("b", F.lit(1)).unionByName(rest.withColumn("b", F.lit(0))).where("w <> ''")
            .groupBy("w").agg(F.sum("b").alias("b"), F.count("*").alias("n"))
            .where((F.col("b") >= LEARNED_TIMES) & (F.col("b") >= F.col("n") * LEARNED_SHARE)))
    return [r["w"] for r in both.orderBy(F.col("b").desc(), "w").limit(LEARNED).collect()]


def _tagged(kind: str, i: int, text: Column | None = None) -> Column:
    """The spans of a kind as (start, place of the kind, text, end), ready to sort."""
    def one(x: Column) -> Column:
        t = F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string"))
        return F.struct(x["s"].alias("s"), F.lit(i).alias("i"), (t if text is None else text).alias("t"),
                        x["e"].alias("e"))
    return F.transform(kind, one)


def _joined(*kinds: str) -> Column:
    parts = [_tagged(k, i) for i, k in enumerate(kinds)]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda x: x["t"]), ",")


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, spans of the base kinds and of ``other`` as arrays of (s, e)."""
    cand = C.written(candidates(docs), "op7-candidates")
    words = F.array(*map(F.lit, learned_words(cand))).cast("array<string>")
    one = cand.select(F.explode("other").alias("x"))
    code, features = _code(F.col("x"), words), F.array(*_features(F.col("x")))
    counts = {r["code"]: r["count"] for r in one.select(code.alias("code")).groupBy("code").count().collect()}
    _, _, post = reliabilities(counts)
    sample = one.select(code.alias("code"), features.alias("f"),
                        F.xxhash64("x.m", "x.before", "x.after").alias("h"))
    # by hash; equal hashes have equal features, so any of them will do
    rows = sample.orderBy("h").limit(SAMPLE).collect()
    w = classifier([(tuple(r["f"]), post[r["code"]]) for r in rows])

    def personal(x: Column) -> Column:
        return x["free"] & (_score(w, F.array(*_features(x))) >= threshold)

    pair = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
    added = F.transform(F.filter("other", personal), pair) if rows else F.array().cast("array<struct<s:int,e:int>>")
    return cand.select("doc_id", *(F.transform(k, pair).alias(k) for k in BASE), added.alias("other"))


def masked(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id and the text with every span replaced by its kind in angle brackets;
    overlapping spans become one.  Rows that share a doc_id must share their text."""
    spans = find(docs, threshold).dropDuplicates(["doc_id"])
    marks = F.array_sort(F.concat(*(_tagged(k, i, F.lit(f"<{k}>")) for i, k in enumerate(KINDS))))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        put = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), x["t"])
        return F.when(x["s"] >= acc["at"], F.struct(x["e"].alias("at"), put.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], x["e"]).alias("at"), acc["out"].alias("out")))

    done = F.aggregate("__marks", start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    m = spans.select(F.col("doc_id").alias("__id"), marks.alias("__marks"))
    return (docs.join(m, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__id")))
            .select("doc_id", done.alias("text")))


def digest(found: DataFrame) -> DataFrame:
    """The counts and joined spans of ``find``."""
    return found.select("doc_id", *(F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:4]),
                        F.sha2(_joined(*BASE), 256).alias("base_sha256"),
                        _joined(*KINDS).alias("spans"), F.size("other").cast("bigint").alias("n_other"))
