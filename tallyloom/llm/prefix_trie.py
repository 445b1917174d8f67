"""Conversations that share their first turns: double-array tries over shards of prefixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import drop, keep

# A turn in a path: 16 bytes of a hash of role and text, 4 bytes with the code points of the text.
HASH, RECORD = 16, 20
# Turns that one trie should hold; ids that are written out together; copies of a shared node that look-ups are dealt over.
SHARD_TURNS, ID_BLOCK, COPIES = 100_000, 1_024, 16
# Free places that a node with several children tries before it goes to the end.
TRIES = 16
# Stands for a conversation without an id, which is the last of all.
NO_ID = (1 << 63) - 1


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """``(conv_id, path)``: the turns of each conversation, in order, as records of 20 bytes.

    Rows are ordered by turn, nulls first, ties by role and by the hash of the turn. A null role or
    text is empty, rows without a conv_id are one conversation. Texts are hashed
    where they are read and never move; a path, 20 bytes a turn, is one value.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))

    def four(n: Column) -> Column:
        return F.lpad(F.hex(n.cast("bigint")), 8, "0")

    told = F.sha2(F.concat(four(F.length(role)), role, text).cast("binary"), 256)
    record = F.concat(F.substring(told, 1, 2 * HASH), four(F.length(text)))
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"), role.alias("role"), record.alias("record"))
    turns = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), place.alias("t"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("t")), lambda t: t["record"]), "")
    return turns.groupBy("conv_id").agg(F.unhex(joined).alias("path"))


def with_shared_heads(paths: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Paths whose first turns are those of the first conversation of their hundred.

    The first ``h = crc32(conv_id) mod heads`` turns of a conversation give way to those of conversation
    ``conv_id - conv_id % group``, if it exists; a null id has ``h`` 0.
    """
    own = F.col("conv_id")
    share = F.coalesce(F.crc32(own.cast("string").cast("binary")) % heads, F.lit(0)).cast("int") * RECORD
    first = paths.select(own.alias("base"), F.substring("path", 1, (heads - 1) * RECORD).alias("head")).where("base is not null")
    joined = paths.withColumn("base", own - own % group).withColumn("share", share).join(first, "base", "left")
    head = F.coalesce(F.substr("head", F.lit(1), F.col("share")), F.unhex(F.lit("")))
    return joined.select("conv_id", F.concat(head, F.substr("path", F.col("share") + 1)).alias("path"))


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes the ids of each path, block by block in order; a partition holds all blocks of its paths."""
    names = ["path", "n", "first", "ends"]
    path, count, first, digest = None, 0, NO_ID, None
    for batch in batches:
        rows = []
        for told, ids, n, low in zip(*(batch.column(c) for c in ("path", "ids", "n", "first"))):
            told = told.as_py()
            if told != path:
                if digest is not None:
                    rows.append((path, count, first, digest.hexdigest()))
                path, count, first, digest = told, 0, NO_ID, hashlib.sha256()
            digest.update((("," if count else "") + ids.as_py()).encode())
            count, first = count + n.as_py(), min(first, low.as_py())
        yield _batch(rows, names)
    if digest is not None:
        yield _batch([(path, count, first, digest.hexdigest())], names)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def distinct_paths(paths: DataFrame) -> DataFrame:
    """``(path, n, first, ends)``: each distinct path, its conversations, the smallest, and the hash of all their ids.

    Ids are joined in blocks of 1,024 by value, so the many ids of a common path are
    written out in many tasks; only the hash over the finished blocks, which must run in
    order, stays with one task, which streams them.
    """
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    blocks = paths.withColumn("block", F.floor(F.col("conv_id") / ID_BLOCK)).groupBy("path", "block").agg(
        ids.alias("ids"), F.count("*").alias("n"), F.coalesce(F.min("conv_id"), F.lit(NO_ID)).alias("first")
    )
    ordered = blocks.repartition("path").sortWithinPartitions("path", F.asc_nulls_last("block"))
    return ordered.select("path", "ids", "n", "first").mapInArrow(_ended, "path binary, n bigint, first bigint, ends string")


class DoubleArray:
    """Trie over dense ids: the child of a node by ``id`` stands at ``base[node] + id`` if ``check`` there names the node.

    Ids are numbered level by level, so siblings lie close together. Nodes with one
    child, most of them, take the next free places; others the first of a few
    free places where all children fit, or the end.
    """

    def __init__(self, ids: np.ndarray, starts: np.ndarray):
        """``ids[starts[i]:starts[i + 1]]`` is the row of ids of sequence ``i``."""
        self.base, self.check = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.used = 1
        length = np.diff(starts)
        at = np.zeros(len(length), np.int64)
        going = np.flatnonzero(length > 0)
        for depth in range(int(length.max(initial=0))):
            going = going[length[going] > depth]
            child = ids[starts[going] + depth]
            pairs = np.unique(np.stack([at[going], child], axis=1), axis=0)
            self._place(pairs[:, 0], pairs[:, 1])
            at[going] = self.base[at[going]] + child

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            room = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(room, np.int64)])
            self.check = np.concatenate([self.check, np.full(room, -1)])

    def _place(self, parents: np.ndarray, children: np.ndarray) -> None:
        nodes, first, counts = np.unique(parents, return_index=True, return_counts=True)
        for i in np.flatnonzero(counts > 1):
            ids = children[first[i] : first[i] + counts[i]]
            free = np.flatnonzero(self.check[: self.used] < 0)[:TRIES]
            for place in (*free.tolist(), self.used):
                slots = ids - ids[0] + place
                self._grow(int(slots[-1]) + 1)
                if (self.check[slots] < 0).all():
                    break
            self.base[nodes[i]], self.check[slots] = place - ids[0], nodes[i]
            self.used = max(self.used, int(slots[-1]) + 1)
        one = counts == 1
        single, ids = nodes[one], children[first[one]]
        self._grow(self.used + len(single))
        slots = np.flatnonzero(self.check < 0)[: len(single)]
        self.base[single], self.check[slots] = slots - ids, single
        self.used = max(self.used, int(slots.max(initial=0)) + 1)

    def step(self, nodes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Children of ``nodes`` by ``ids``; -1 where there is none."""
        places = self.base[nodes] + ids
        inside = (nodes >= 0) & (places > 0) & (places < len(self.check))
        found = np.where(inside, places, 0)
        return np.where(inside & (self.check[found] == nodes), found, -1)


def dense_ids(keys: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """Numbers of equal rows of ``keys``, counted in the order in which they first occur by depth."""
    _, first, number = np.unique(keys, axis=0, return_index=True, return_inverse=True)
    by_depth = np.argsort(depths, kind="stable")
    rank = np.empty(len(keys), np.int64)
    rank[by_depth] = np.arange(len(keys))
    earliest = np.full(len(first), len(keys))
    np.minimum.at(earliest, number.ravel(), rank)
    order = np.empty(len(first), np.int64)
    order[np.argsort(earliest)] = np.arange(len(first))
    return order[number.ravel()]


NODE = (
    "shared boolean, node string, above string, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved bigint, size bigint, ends string"
)
ROOT = "0" * 32


def _nodes(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one shard.

    A node less deep than its paths' ``cut`` is shared with other shards: it is
    told by a chained hash, with sums over its unshared children only.
    """
    data = np.frombuffer(b"".join(group["path"]), np.uint8).reshape(-1, RECORD)
    length = np.array([len(p) // RECORD for p in group["path"]])
    starts = np.concatenate([[0], np.cumsum(length)])
    depths = np.arange(len(data)) - np.repeat(starts[:-1], length)
    keys = np.ascontiguousarray(data[:, :HASH]).view(">u8").astype(np.uint64)
    sizes = np.ascontiguousarray(data[:, HASH:]).view(">u4").astype(np.int64).ravel()
    ids = dense_ids(keys, depths)
    trie = DoubleArray(ids, starts)

    many, ids_of, cut = (group[c].to_numpy(np.int64) for c in ("n", "first", "cut"))
    places = len(trie.check)
    count, size, depth, record = (np.zeros(places, np.int64) for _ in range(4))
    first, shared, ends = np.full(places, NO_ID), np.zeros(places, bool), np.full(places, None, object)
    at, going, told = np.zeros(len(group), np.int64), np.arange(len(group)), group["ends"].to_numpy()
    level = 0
    while len(going):
        here = at[going]
        np.add.at(count, here, many[going])
        np.minimum.at(first, here, ids_of[going])
        shared[here] = level < cut[going]
        depth[here] = level
        if level:
            record[here] = starts[going] + level - 1
            size[here] = sizes[record[here]]
        done = length[going] == level
        ends[here[done]] = told[going[done]]
        going = going[~done]
        at[going] = trie.step(at[going], ids[starts[going] + level])
        level += 1

    slots = np.flatnonzero(count)
    parent = trie.check
    below = slots[slots > 0]
    own = below[~shared[below]]
    children = np.bincount(parent[own], minlength=places)
    leaves = np.where(shared, 0, children == 0).astype(np.int64)
    saved = np.where(shared, 0, (count - 1) * size)
    for d in range(int(depth.max()), 0, -1):
        level = own[depth[own] == d]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    names = {0: ROOT}
    for slot in below[shared[below]][np.argsort(depth[below[shared[below]]], kind="stable")].tolist():
        told = bytes.fromhex(names[int(parent[slot])]) + data[record[slot], :HASH].tobytes()
        names[slot] = hashlib.sha256(told).hexdigest()[: 2 * HASH]
    from_above = [names.get(int(parent[s])) if s else None for s in slots.tolist()]
    return pd.DataFrame(
        {
            "shared": shared[slots], "node": [names.get(s) for s in slots.tolist()], "above": from_above, "depth": depth[slots],
            "conv_id": first[slots], "parent_conv_id": first[parent[slots]], "n_convs": count[slots], "n_children": children[slots],
            "n_leaves": leaves[slots], "saved": saved[slots], "size": size[slots], "ends": ends[slots],
        }
    )


def _head(depth: int) -> Column:
    return F.substring("path", 1, depth * RECORD)


def _sharded(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """Adds ``cut`` and ``shard``: paths that agree in their first ``cut`` turns share a shard.

    The cut is 1, and doubles as long as more turns than a trie should hold follow
    the same head, however often that is. A path that ends before its cut is alone with its copies.
    """
    turns = F.length("path") / RECORD
    total = rows.agg(F.sum(turns)).first()[0] or 0
    shards = 1 + int(total) // SHARD_TURNS
    parts, paths, depth, left = [], [], 1, rows
    while True:
        heavy = left.where(turns >= depth).groupBy(_head(depth).alias("head")).agg(F.sum(turns).alias("turns"), F.count("*").alias("n"))
        heavy, path = keep(heavy.where((F.col("turns") > SHARD_TURNS) & (F.col("n") > 1)).select("head"), "heavy")
        paths.append(path)
        if heavy.isEmpty():
            parts.append(left.withColumn("cut", F.lit(depth)))
            break
        # A path that ends here has no head of this depth but itself, and stays among the shared nodes.
        marked = left.withColumn("head", _head(depth)).join(heavy.withColumn("is_heavy", F.lit(True)), "head", "left").drop("head")
        again = F.coalesce("is_heavy", F.lit(False)) & (turns >= depth)
        parts.append(marked.where(~again).drop("is_heavy").withColumn("cut", F.lit(depth)))
        left, path = keep(marked.where(again).drop("is_heavy"), "heavy-paths")
        paths.append(path)
        depth *= 2
    shard = F.pmod(F.xxhash64(F.expr(f"substring(path, 1, cut * {RECORD})")), F.lit(shards))
    return reduce(DataFrame.union, parts).withColumn("shard", shard), paths


def _merged(shared: DataFrame) -> tuple[DataFrame, list[str]]:
    """Shared nodes summed over shards, with the sums of all nodes below them.

    Sums climb the shared nodes in doubling steps, so a chain of n nodes takes log2(n) rounds.
    """
    whole = shared.groupBy("node", "above", "depth", "size").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends"),
    )
    whole, path = keep(whole, "shared-nodes")
    paths = [path]
    inner = whole.where("above is not null").groupBy(F.col("above").alias("node")).agg(F.count("*").alias("inner"))
    whole = whole.join(inner, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("inner", F.lit(0)))
    whole = whole.withColumn("n_leaves", F.col("n_leaves") + (F.col("n_children") == 0).cast("bigint"))
    whole, path = keep(whole.withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("size")).drop("inner"), "shared-nodes")
    paths.append(path)
    sums, jump = whole.select("node", "n_leaves", "saved"), whole.where("above is not null").select("node", "above")
    while not jump.isEmpty():
        gains = sums.join(jump, "node").select(F.col("above").alias("node"), "n_leaves", "saved")
        sums, path = keep(sums.union(gains).groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")), "sums")
        paths.append(path)
        further = jump.select("node", F.col("above").alias("middle")).join(jump.select(F.col("node").alias("middle"), "above"), "middle")
        jump, path = keep(further.select("node", "above"), "jumps")
        paths.append(path)
    return whole.drop("n_leaves", "saved").join(sums, "node"), paths


def prefix_nodes(paths: DataFrame) -> DataFrame:
    """One row per distinct prefix of the given paths, from the empty one on.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (over the subtree, members but one times the code points of a
    node's last text) and ``ends_sha256`` (hash of the ids that end here, in order, joined by commas).

    Equal paths become one row first. Paths are dealt into shards by their first turn, and by more turns
    where too many follow the same ones, so no trie holds much more than
    100,000 turns unless one path does. Each shard packs a double-array trie and walks its
    paths through it; nodes above the cuts, which several shards hold, are summed globally.

    ``paths`` is ``(conv_id, path)`` with distinct ids; one may be null: it comes after all others, its
    text in a hash is empty, and it shows as a null ``conv_id``. (The number 2**63 - 1 counts as null.) An
    empty table gives no rows, not even a root.
    """
    rows, rows_path = keep(distinct_paths(paths), "paths")
    sharded, used = _sharded(rows)
    nodes, nodes_path = keep(sharded.groupBy("shard").applyInPandas(_nodes, NODE), "nodes")
    top, more = _merged(nodes.where("shared"))
    top, top_path = keep(top, "shared-nodes")
    # Every shared node may have any number of children: its id is looked up in one of several copies.
    copies = top.select(F.col("node").alias("above"), F.col("conv_id").alias("from_above"), F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"))
    copy = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(COPIES)).cast("int")
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    inside = nodes.where("not shared and above is null").select(*columns, "parent_conv_id")
    border = nodes.where("not shared and above is not null").select(*columns, "above").union(top.select(*columns, "above"))
    border = border.withColumn("copy", copy).join(copies, ["above", "copy"], "left").select(*columns, F.col("from_above").alias("parent_conv_id"))

    def known(name: str) -> Column:
        return F.nullif(F.col(name), F.lit(NO_ID)).alias(name)

    out, _ = keep(
        inside.union(border).select(
            known("conv_id"), "depth", known("parent_conv_id"), "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
            F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        ),
        "trie",
    )
    drop(paths.sparkSession, rows_path, nodes_path, top_path, *used, *more)
    return out


def conversation_trie(conversations: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """:func:`prefix_nodes` of conversations that share the heads of their hundred (:func:`with_shared_heads`).

    Other columns than ``conv_id, turn, role, text`` are ignored; repeated rows are turns of their own.
    """
    paths, path = keep(conversation_paths(conversations), "conversations")
    out = prefix_nodes(with_shared_heads(paths, group, heads))
    drop(conversations.sparkSession, path)
    return out
