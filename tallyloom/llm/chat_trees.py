"""Reply trees: root-to-leaf paths by self-joins, ranked and formatted as conversations.

Column expressions and joins only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import drop, keep

# Marks of the template; none of them can occur in an escaped text.
HEAD, SEPARATOR, END = "### ", ": ", "</turn>"
# Each control string and its escape. An escaped text has a backslash only
# before one of these letters, so the escapes can be undone one after another.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), (END, "\\e"), (":", "\\c"))
TEXT_ESCAPES = ESCAPES[:3]


def escaped(text: Column, rules=TEXT_ESCAPES) -> Column:
    for plain, code in rules:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, rules=TEXT_ESCAPES) -> Column:
    for plain, code in reversed(rules):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def reply_paths(messages: DataFrame) -> DataFrame:
    """``(tree, leaf, node, depth)`` for every node on the path from a root to a leaf.

    ``messages`` holds ``(tree, node, parent)``; ``parent`` is null or unknown at
    a root. Two self-joins a round double the reach: one composes the ancestor
    pointers, one adds the ancestors found at that distance, so a path of n
    messages takes log2(n) rounds. Nodes on a circle of replies have no root and
    are left out. ``depth`` is 0 at the root.
    """
    spark = messages.sparkSession
    nodes, nodes_path = keep(messages.select("tree", "node", "parent"), "messages")
    known = nodes.select("tree", F.col("node").alias("parent"))
    links, links_path = keep(nodes.where("parent is not null").join(known, ["tree", "parent"], "left_semi"), "replies")
    replied = links.select("tree", F.col("parent").alias("node"))
    paths, paths_path = keep(
        nodes.join(replied, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up")), "paths"
    )
    roots = nodes.join(links, ["tree", "node"], "left_anti").select("tree", "node")
    jump, jump_path = links.select("tree", "node", "parent"), None
    reach, total = 1, nodes.count()
    while reach <= total and not jump.isEmpty():
        further = paths.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("parent").alias("node"), (F.col("up") + reach).alias("up"))
        longer, longer_path = keep(paths.union(further), "paths")
        twice = jump.select("tree", F.col("node").alias("start"), F.col("parent").alias("node")).join(jump, ["tree", "node"])
        following, following_path = keep(twice.select("tree", F.col("start").alias("node"), "parent"), "jumps")
        drop(spark, paths_path, *([jump_path] if jump_path else []))
        paths, paths_path, jump, jump_path = longer, longer_path, following, following_path
        reach *= 2
    ends = paths.join(roots, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("top"))
    out, _ = keep(paths.join(ends, ["tree", "leaf"]).select("tree", "leaf", "node", (F.col("top") - F.col("up")).alias("depth")), "branches")
    drop(spark, nodes_path, links_path, paths_path, *([jump_path] if jump_path else []))
    return out


def best_branches(paths: DataFrame, scores: DataFrame, branches: int | None = 1) -> DataFrame:
    """``(tree, leaf, branch)``: branches of each tree by mean message score, best first.

    ``scores`` holds ``(tree, node, score)``, null counts as 0. Ties go to the
    smaller leaf. ``branches`` keeps that many per tree; None keeps all.
    """
    means = (
        paths.join(scores, ["tree", "node"], "left")
        .groupBy("tree", "leaf")
        .agg(F.avg(F.coalesce("score", F.lit(0.0))).alias("mean"))
    )
    order = Window.partitionBy("tree").orderBy(F.desc("mean"), "leaf")
    ranked = means.select("tree", "leaf", F.row_number().over(order).alias("branch"))
    return ranked if branches is None else ranked.where(F.col("branch") <= branches)


def formatted(turns: DataFrame, key: list[str], learned: str = "assistant") -> DataFrame:
    """One formatted conversation per ``key`` from ``(key, depth, role, text)``.

    Returns the key, ``formatted`` and ``loss_spans``: start (from 1) and length, in
    code points, of each stretch of ``formatted`` that a model learns from, which is
    the escaped text of every turn whose role is ``learned``. Null roles and
    texts are empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    opening = F.concat(F.lit(HEAD), escaped(role, ESCAPES), F.lit(SEPARATOR))
    body = escaped(text)
    turn = F.struct(
        F.col("depth").alias("depth"),
        F.concat(opening, body, F.lit(END + "\n")).alias("line"),
        F.length(opening).alias("before"),
        F.length(body).alias("size"),
        (role == learned).alias("learned"),
    )
    turns = turns.select(*key, turn.alias("turn")).groupBy(*key).agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    start = F.struct(F.lit(1).alias("at"), F.expr("cast(array() as array<struct<start int, size int>>)").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        span = F.struct((state["at"] + t["before"]).alias("start"), t["size"].alias("size"))
        spans = F.when(t["learned"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + t["before"] + t["size"] + len(END) + 1).alias("at"), spans.alias("spans"))

    return turns.select(
        *key,
        F.array_join(F.transform("turns", lambda t: t["line"]), "").alias("formatted"),
        F.aggregate("turns", start, add)["spans"].alias("loss_spans"),
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """Adds what the formatted text holds: ``turns`` (role, text) and ``loss_texts``."""
    lines = F.split(F.col("formatted"), f"{END}\n".replace("\n", "\\n"))
    lines = F.slice(lines, 1, F.size(lines) - 1)

    def turn(line: Column) -> Column:
        role = F.substring_index(line, SEPARATOR, 1)
        text = F.substr(line, F.length(role) + 1 + len(SEPARATOR))
        return F.struct(
            unescaped(F.substr(role, F.lit(1 + len(HEAD))), ESCAPES).alias("role"), unescaped(text).alias("text")
        )

    learned = F.transform("loss_spans", lambda s: unescaped(F.substr(F.col("formatted"), s["start"], s["size"])))
    return conversations.withColumn("turns", F.transform(lines, turn)).withColumn("loss_texts", learned)


def chat_conversations(
    messages: DataFrame, branches: int | None = 1, learned: str = "assistant"
) -> DataFrame:
    """Chosen branches of reply trees as formatted conversations.

    ``messages`` holds ``(tree, node, parent, role, text, score)`` with a unique
    ``node`` per tree. Returns ``tree, leaf, formatted, loss_spans``. A branch is
    one text, so its messages meet in one row; trees and branches are spread over
    all tasks. Messages with a null tree or node are left out; an empty table gives no rows.
    """
    messages = messages.select("tree", "node", "parent", "role", "text", "score").where("tree is not null and node is not null")
    paths = reply_paths(messages)
    chosen = best_branches(paths, messages.select("tree", "node", "score"), branches)
    turns = paths.join(chosen, ["tree", "leaf"]).join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    return formatted(turns, ["tree", "leaf"], learned)


def linear_threads(conversations: DataFrame) -> DataFrame:
    """Turn tables as reply trees in which each turn answers the one before.

    Rows are ordered by turn, role and text, nulls first, so repeated rows and
    equal turn numbers have a defined place. ``tree`` is a struct of the ``conv_id``, so that the rows
    with a null one are a conversation too. Other columns are ignored.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("bigint"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select(F.struct("conv_id").alias("tree"), "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))
