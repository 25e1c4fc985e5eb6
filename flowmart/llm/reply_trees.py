r"""Chat formatting of reply trees (operator 12), DataFrame functions only.

A message answers its parent; messages of one tree without a parent in it are roots.  Paths come
from iterative self-joins by doubling: after round i every message knows the message 2^i steps up,
and the number and summed scores of the messages in between, so a tree of depth d needs log2(d)
rounds and no round walks a single step.  A leaf's path score is the mean score of its messages.
The best ``branches`` leaves of every tree are chosen first; only their paths are then enumerated,
again by doubling (a path of 2^i messages is joined with the jumps of round i).

Every chosen path is formatted as one conversation.  A turn is
``<s>[INST] role [/INST] text</s>``; control strings inside roles and texts get a backslash after
their first character, and ones that already have backslashes there one more, so the escape is
undone exactly.  ``mask`` holds the spans (code points, end exclusive) of the assistant texts, as
they stand in the formatted text: their loss counts.

Defined cases: a null id is no message; a null parent, or one that is not in the tree, makes a root;
of messages alike in tree and id the least by (parent, role, text, score) counts; a null score is 0;
a null tree is a tree; messages on a cycle, or under one, lie on no path and are left out; ties in
score go to the smaller leaf id; null roles and texts are empty; an empty table gives an empty
result.  Other columns are not read.  One path's text is one value in one row, as its user needs it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.llm import common as C

# The template's control strings and their escape.
BEGIN, OPEN, CLOSE, END = "<s>", "[INST] ", " [/INST] ", "</s>"
RAW = r"([<\[])(\\*)(/?s>|/?INST\])"
ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"
LOSS_ROLE = "assistant"
#: parts that a tree's leaves are ranked in before its best ones are put together
RANK_PARTS = 64


def escape(text: Column) -> Column:
    return F.regexp_replace(text, RAW, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _tree_key(tree: Column) -> Column:
    """A text that stands for the tree's id; null has one too."""
    return F.when(tree.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), tree.cast("string")))


def messages(rows: DataFrame, tree: Column, node: Column, parent: Column, role: Column, text: Column,
             score: Column) -> DataFrame:
    """The table that :func:`conversations` reads, from columns of any names."""
    one = rows.select(_tree_key(tree).alias("tree"), node.alias("node"), parent.alias("parent"),
                      F.coalesce(role.cast("string"), F.lit("")).alias("role"),
                      F.coalesce(text.cast("string"), F.lit("")).alias("text"),
                      F.coalesce(score.cast("double"), F.lit(0.0)).alias("score")).where("node is not null")
    return (one.groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", "score")).alias("m"))
            .select("tree", "node", "m.*"))


def jumps(msgs: DataFrame) -> list[DataFrame]:
    """Tables of the doubling rounds: tree, node, up (the message 2^i steps up; null past the root),
    steps and total (number and summed score of the messages from node up to before ``up``), done
    (the root has been passed).  In the last table all messages that have a root are done."""
    known = msgs.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    step = (msgs.select("tree", "node", "parent", "score").join(known, ["tree", "parent"], "left")
            .select("tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"),
                    F.lit(1).cast("bigint").alias("steps"), F.col("score").alias("total")))
    tables = [C.written(step, "op12-jumps")]
    done = -1
    while True:
        t = tables[-1]
        now, rest = t.agg(F.count(F.when(F.col("up").isNull(), 1)), F.count("up")).first()
        # depths have no gaps: a round that finishes nobody new leaves only cycles
        if not rest or now == done:
            return tables
        done = now
        above = t.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"),
                         F.col("steps").alias("steps2"), F.col("total").alias("total2"))
        open_ = t.where("up is not null").join(above, ["tree", "up"]).select(
            "tree", "node", F.col("up2").alias("up"), (F.col("steps") + F.col("steps2")).alias("steps"),
            (F.col("total") + F.col("total2")).alias("total"))
        tables.append(C.written(t.where("up is null").unionByName(open_), "op12-jumps"))


def best_leaves(msgs: DataFrame, last: DataFrame, branches: int) -> DataFrame:
    """tree, leaf, branch (rank from 1 by score), n_turns, score of the chosen leaves.  Ranked in
    parts of each tree first, so a tree of very many leaves is not sorted in one task."""
    parents = msgs.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = (last.where("up is null").join(parents, ["tree", "node"], "left_anti")
              .select("tree", F.col("node").alias("leaf"), F.col("steps").alias("n_turns"),
                      (F.col("total") / F.col("steps")).alias("score")))
    part = F.pmod(F.xxhash64("leaf"), F.lit(RANK_PARTS))
    order = [F.col("score").desc(), F.col("leaf")]
    some = leaves.withColumn("branch", F.row_number().over(Window.partitionBy("tree", part).orderBy(*order)))
    return (some.where(F.col("branch") <= branches)
            .withColumn("branch", F.row_number().over(Window.partitionBy("tree").orderBy(*order)))
            .where(F.col("branch") <= branches))


def paths(tables: list[DataFrame], leaves: DataFrame) -> DataFrame:
    """tree, branch, node, back (steps below: 0 at the leaf): one row per message of each path."""
    found = C.written(leaves.select("tree", "branch", F.col("leaf").alias("node"),
                                    F.lit(0).cast("bigint").alias("back")), "op12-paths")
    for i, t in enumerate(tables[:-1]):
        up = t.where("up is not null").select("tree", "node", "up")
        more = found.join(up, ["tree", "node"]).select(
            "tree", "branch", F.col("up").alias("node"), (F.col("back") + (1 << i)).alias("back"))
        shorter, found = found, C.written(found.unionByName(more), "op12-paths")
        C.drop(shorter)
    return found


def conversations(msgs: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: tree, branch, score, n_turns, formatted, mask (an array of turn,
    base (where the turn begins), start, end)."""
    msgs = C.written(msgs, "op12-messages")
    tables = jumps(msgs)
    leaves = C.written(best_leaves(msgs, tables[-1], branches), "op12-leaves")
    found = paths(tables, leaves)
    for t in tables:
        C.drop(t)
    rows = (found.join(msgs.select("tree", "node", "role", "text"), ["tree", "node"])
            .join(leaves.select("tree", "branch", "n_turns", "score"), ["tree", "branch"]))
    head = F.concat(F.lit(BEGIN + OPEN), escape(F.col("role")), F.lit(CLOSE))
    turns = (rows.withColumns({"turn": (F.col("n_turns") - 1 - F.col("back")).cast("int"), "head": head,
                               "body": escape(F.col("text"))})
             .withColumn("size", F.char_length("head") + F.char_length("body") + len(END)))
    before = (Window.partitionBy("tree", "branch").orderBy("turn")
              .rowsBetween(Window.unboundedPreceding, -1))
    base = F.coalesce(F.sum("size").over(before), F.lit(0)).cast("bigint")
    start = F.col("base") + F.char_length("head")
    turns = turns.withColumn("base", base).select(
        "tree", "branch", "score", "n_turns", F.struct(
            "turn", F.concat("head", "body", F.lit(END)).alias("piece"),
            F.when(F.col("role") == LOSS_ROLE, F.struct(
                "turn", "base", start.alias("start"),
                (start + F.char_length("body")).alias("end"))).alias("span")).alias("t"))
    whole = turns.groupBy("tree", "branch", "score", "n_turns").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return whole.select("tree", "branch", "score", "n_turns",
                        F.array_join(F.col("t.piece"), "").alias("formatted"),
                        F.filter("t.span", lambda s: s.isNotNull()).alias("mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The rows with ``turns`` (an array of role and text) and ``loss`` (the texts under the mask,
    in order), both read from ``formatted`` and unescaped."""
    lines = F.split("formatted", END)
    pieces = F.slice(lines, F.lit(1), F.size(lines) - 1)

    def turn(p: Column) -> Column:
        rest = F.substring(p, F.lit(len(BEGIN + OPEN) + 1), F.char_length(p))
        role = F.substring_index(rest, CLOSE, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(
            rest, F.char_length(role) + len(CLOSE) + 1, F.char_length(rest))).alias("text"))

    def masked(m: Column) -> Column:
        return unescape(F.substring(F.get("__pieces", m["turn"]), (m["start"] - m["base"] + 1).cast("int"),
                                    (m["end"] - m["start"]).cast("int")))

    out = formatted.select("*", pieces.alias("__pieces"))
    return out.select(*formatted.columns, F.transform("__pieces", turn).alias("turns"),
                      F.transform("mask", masked).alias("loss"))


def of_turns(rows: DataFrame) -> DataFrame:
    """A table of (conv_id, turn, role, text) as reply trees: each row answers the one before it by
    turn (null first; ties by role and text).  Equal rows are turns of their own."""
    at = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    one = rows.select("conv_id", "turn", "role", "text").withColumn(
        "__n", F.row_number().over(at).cast("bigint"))
    return messages(one, F.col("conv_id"), F.col("__n"), F.col("__n") - 1, F.col("role"), F.col("text"),
                    F.lit(0.0))


def digest(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the formatted text."""
    r = read_back(formatted)
    both = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return r.select(
        F.when(F.col("tree") != "null", F.substring("tree", 2, 40)).cast("bigint").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"), F.sha2(both, 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"))
