"""Near-duplicate texts: a forest of sorted MinHash orders and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import connected_components, drop, keep, mixed
from tallyloom.llm.ordering import positions
from tallyloom.llm.words import shingle_sets

# Orders of the forest and MinHash values in a label.
TREES, DEPTH = 16, 8
# Shortest common prefix of two labels that makes neighbours candidates. Texts at
# a similarity of 0.8 share it in at least one of 16 orders with probability 0.9998.
LEAST_PREFIX = 4
# Rows of a sorted order that a row is compared with on either side; larger regions
# are compared in full once their families of copies are connected.
WINDOW = 2
# Sorted rows, and rows of a dense region, that one task holds.
BLOCK, REGION_BLOCK = 8_192, 512
# Shingles of a text whose set goes to the tasks that compare dense regions: 64 KB.
LARGE_SET = 8_192
# Of 128 values, a similarity of 0.8 leaves fewer than this equal once in 2,000,000 pairs.
LEAST_EQUAL = 80


def _signer(width: int, seed: int):
    rng = np.random.default_rng(seed)
    scale = rng.integers(0, 1 << 63, TREES * DEPTH, np.uint64) | np.uint64(1)
    shift = rng.integers(0, 1 << 63, TREES * DEPTH, np.uint64)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, signs = [], [], [], []
            for found in shingle_sets(batch.column("text"), width):
                sizes.append(len(found))
                with np.errstate(over="ignore"):
                    one.append(int(mixed(found).sum(dtype=np.uint64).view(np.int64)))
                    two.append(int(np.bitwise_xor.reduce(mixed(found + np.uint64(77))).view(np.int64)))
                    least = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
                    for first in range(0, len(found), 1024):
                        part = found[first : first + 1024, None] * scale + shift
                        np.minimum(least, part.min(axis=0), out=least)
                signs.append(((least >> np.uint64(24)) & np.uint64(0xFFFF)).astype(">u2").tobytes() if len(found) else None)
            yield pa.record_batch(
                [*batch.select(["doc", "tag"]).columns, pa.array(sizes, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array(signs, pa.binary())],
                ["doc", "tag", "size", "one", "two", "sig"],
            )

    return sign


SIGNED = "doc bigint, tag bigint, size int, one bigint, two bigint, sig binary"


def _labels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per order: the label's first four values and its last four as numbers."""
    for batch in batches:
        values = np.frombuffer(b"".join(batch["sig"]), ">u8").astype(np.int64).reshape(len(batch) * TREES, 2)
        yield pd.DataFrame(
            {
                "tree": np.tile(np.arange(TREES, dtype=np.int32), len(batch)),
                "high": values[:, 0],
                "low": values[:, 1],
                "id": np.repeat(batch["id"].to_numpy(), TREES),
                "size": np.repeat(batch["size"].to_numpy(), TREES),
            }
        )


def _sizes_allow(one: np.ndarray, two: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(one, two).astype(np.int64) >= percent * np.maximum(one, two).astype(np.int64)


def _neighbours(percent: int):
    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("idx")
        tree, high, ids, size, own = (group[c].to_numpy() for c in ("tree", "high", "id", "size", "own"))
        out = [np.zeros((0, 2), np.int64)]
        for step in range(1, min(WINDOW, len(group) - 1) + 1):
            met = (tree[:-step] == tree[step:]) & (high[:-step] == high[step:]) & own[:-step]
            at = np.flatnonzero(met & _sizes_allow(size[:-step], size[step:], percent))
            out.append(np.stack([np.minimum(ids[at], ids[at + step]), np.maximum(ids[at], ids[at + step])], axis=1))
        pairs = np.unique(np.concatenate(out), axis=0)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return scan


def _equal_values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        one = np.frombuffer(b"".join(batch["sig_a"]), np.uint16).reshape(len(batch), -1)
        two = np.frombuffer(b"".join(batch["sig_b"]), np.uint16).reshape(len(batch), -1)
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "same": (one == two).sum(axis=1).astype(np.int32)})


def _verifier(width: int, percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, two in zip(shingle_sets(batch.column("text_a"), width), shingle_sets(batch.column("text_b"), width)):
                common = len(np.intersect1d(one, two, assume_unique=True))
                linked.append(common > 0 and 100 * common >= percent * (len(one) + len(two) - common))
            yield pa.record_batch(batch.select(["a", "b"]).columns, ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return verify


def _set_writer(width: int, largest: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [found.tobytes() if len(found) <= largest else None for found in shingle_sets(batch.column("text"), width)]
            yield pa.record_batch([batch.column("id"), pa.array(sets, pa.binary())], ["id", "shingles"])

    return write


def _cross_pairs(percent: int):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree, low, high = key[0], *key[-2:]
        ids, size, component, block = (group[c].to_numpy() for c in ("id", "size", "component", "block"))
        one, two = np.flatnonzero(block == low), np.flatnonzero(block == high)
        met = (component[one][:, None] != component[two][None, :]) & _sizes_allow(size[one][:, None], size[two][None, :], percent)
        i, j = np.nonzero(met)
        signs = np.frombuffer(b"".join(group["sig"]), np.uint16).reshape(len(group), -1)
        # First halves of the labels: a pair is compared in the first order that has both in one region.
        regions = np.ascontiguousarray(signs).view(np.uint64)[:, ::2][:, :tree]
        alike = [np.zeros(0, bool)]
        for first in range(0, len(i), 1 << 15):
            a, b = one[i[first : first + (1 << 15)]], two[j[first : first + (1 << 15)]]
            alike.append(((signs[a] == signs[b]).sum(axis=1) >= LEAST_EQUAL) & ~(regions[a] == regions[b]).any(axis=1))
        alike = np.concatenate(alike)
        one, two = one[i[alike]], two[j[alike]]
        unread = group["shingles"].isna().to_numpy()
        late = unread[one] | unread[two]
        out = [(x, y, False) for x, y in zip(one[late], two[late])]
        sets = [np.frombuffer(x or b"", np.uint64) for x in group["shingles"]]
        stored = np.concatenate(sets)
        numbers = np.unique(stored, return_inverse=True)[1]
        held = np.array([len(x) for x in sets])
        ends = np.concatenate([[0], np.cumsum(held)])
        marks, marked = np.zeros(len(stored), bool), -1
        joined = set()
        for x, y in zip(one[~late], two[~late]):
            families = (min(component[x], component[y]), max(component[x], component[y]))
            if families in joined:
                continue
            if x != marked:
                marks[:] = False
                marks[numbers[ends[x] : ends[x + 1]]] = True
                marked = x
            common = np.count_nonzero(marks[numbers[ends[y] : ends[y + 1]]])
            if common and 100 * common >= percent * (held[x] + held[y] - common):
                joined.add(families)
                out.append((x, y, True))
        at = np.array(out, np.int64).reshape(-1, 3)
        a, b = ids[at[:, 0]], ids[at[:, 1]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "linked": at[:, 2].astype(bool)}).drop_duplicates()

    return run


class _Forest:
    """The stored tables of one run and the steps that read them.

    Nodes are classes of equal shingle sets, numbered by ``id``. ``doc`` and ``tag``,
    the id of a document and the hash of its text, tell which text stands for a class.
    """

    def __init__(self, texts: DataFrame, width: int, percent: int, seed: int):
        self.texts, self.width, self.percent = texts, width, percent
        self.spark = texts.sparkSession
        signed, signed_path = keep(texts.mapInArrow(_signer(width, seed), SIGNED), "signatures")
        equal = ["size", "one", "two"]
        known = signed.where("size > 0 and doc is not null").groupBy(*equal)
        classes = known.agg(F.min(F.struct("doc", "tag")).alias("m"), F.first("sig").alias("sig"))
        numbered = classes.select(*equal, "m.doc", "m.tag", "sig", F.monotonically_increasing_id().alias("id"))
        self.reps, _ = keep(numbered, "classes")
        rows = signed.select("doc", *equal).join(self.reps.select(*equal, "id"), equal, "left")
        self.members, _ = keep(rows.select("doc", "size", "id"), "members")
        drop(self.spark, signed_path)

    def shared(self) -> DataFrame:
        """Links between the classes of documents that have the same id."""
        met = self.members.where("id is not null and doc is not null").select("doc", "id").distinct()
        several = met.groupBy("doc").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1")
        return met.join(several, "doc").where("a <> id").select("a", F.col("id").alias("b"))

    def class_texts(self, wanted: DataFrame) -> DataFrame:
        """``(id, text)`` of the wanted classes, one row each also where rows of the input are repeated."""
        keys = self.reps.join(wanted, "id", "left_semi").select("id", "doc", "tag")
        return self.texts.join(keys, ["doc", "tag"]).select("id", "text").dropDuplicates(["id"])

    def named(self, components: DataFrame) -> DataFrame:
        """``(id, name)``: the smallest document of the component of every class."""
        placed = self.reps.select("id", "doc").join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))
        names = placed.groupBy("component").agg(F.min("doc").alias("name"))
        return placed.join(names, "component").select("id", "name")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs with enough equal MinHash values, with their number."""
        sides = pairs
        for side in "ab":
            sides = sides.join(self.reps.select(F.col("id").alias(side), F.col("sig").alias(f"sig_{side}")), side)
        counted = sides.select("a", "b", "sig_a", "sig_b").mapInPandas(_equal_values, "a bigint, b bigint, same int")
        return counted.where(F.col("same") >= LEAST_EQUAL)

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs linked by their full shingle sets."""
        sides = pairs.select("a", "b")
        texts = self.class_texts(sides.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        for side in "ab":
            sides = sides.join(texts.select(F.col("id").alias(side), F.col("text").alias(f"text_{side}")), side)
        return sides.select("a", "b", "text_a", "text_b").mapInArrow(_verifier(self.width, self.percent), "a bigint, b bigint")

    def across(self, pairs: DataFrame, components: DataFrame) -> DataFrame:
        """Pairs whose ends are not yet known to be connected."""
        for side in "ab":
            known = components.select(F.col("id").alias(side), F.col("component").alias(f"in_{side}"))
            pairs = pairs.join(known, side, "left")
        return pairs.where(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).select("a", "b")


def _dense_rest(forest: _Forest, placed: DataFrame, components: DataFrame) -> DataFrame | None:
    """Links between unconnected texts of one region beyond the window, found block by block.

    A task has the shingle sets of two blocks and returns one link for any two
    families that it finds linked. Pairs with a text of more than ``LARGE_SET``
    shingles are verified by a join with the texts.
    """
    region = ["tree", "high"]
    dense, _ = keep(
        placed.groupBy(*region).agg(F.count("*").alias("n"), F.min("idx").alias("first")).where(F.col("n") > WINDOW + 1), "dense"
    )
    if dense.isEmpty():
        return None
    rows = placed.join(dense, region).join(components, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed_regions = rows.groupBy(*region).agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    rows, _ = keep(rows.join(mixed_regions, region, "left_semi"), "dense")
    texts = forest.class_texts(rows.select("id").distinct())
    sets = texts.mapInArrow(_set_writer(forest.width, LARGE_SET), "id bigint, shingles binary")
    dealt = (
        rows.withColumn("block", F.floor((F.col("idx") - F.col("first")) / REGION_BLOCK))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / REGION_BLOCK))))
        .withColumn("left", F.least("block", "other"))
        .withColumn("right", F.greatest("block", "other"))
        .join(forest.reps.select("id", "sig").join(sets, "id"), "id")
        .select(*region, "left", "right", "block", "id", "size", "component", "sig", "shingles")
    )
    found = dealt.groupBy(*region, "left", "right").applyInPandas(_cross_pairs(forest.percent), "a bigint, b bigint, linked boolean")
    found, _ = keep(found.distinct(), "across")
    checked = forest.verified(found.where("not linked").select("a", "b"))
    return found.where("linked").select("a", "b").union(checked)


def near_duplicate_texts(
    documents: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    seed: int = 5,
) -> DataFrame:
    """``(row_id, n_shingles, component_id, kept)`` for each row of ``documents``.

    Texts with equal shingle sets are one class, of which the smallest id goes
    on. The classes are sorted in 16 orders by labels of eight MinHash values.
    In each order a text meets its neighbours with the longest common prefix: two
    on either side, as long as four values agree. In a region of up to three
    texts these are all that share four values; the denser a region, the deeper
    the prefix its neighbours share. Texts of larger regions that are still not
    connected after verification are then compared block by block, so the
    window cuts nothing off, and a family of copies is never listed in pairs.

    Links are confirmed on full shingle sets. Each text's likeliest partner is
    verified first and then only pairs whose ends are not connected, so a
    family of copies costs a few comparisons per member.

    A null text is empty; texts without words have no shingles and link with
    nothing. Rows with a null id make no links and are kept; one whose shingles
    equal those of a row with an id shows its component, all others a null one.
    Rows that share an id are linked, whatever their texts, unless
    a text has no words; repeated rows cost one comparison. Other columns of the
    input are ignored; an empty table gives no rows.
    """
    rows = documents.select(F.col(row_id).cast("bigint").alias("doc"), F.col(text).alias("text"))
    rows = rows.withColumn("tag", F.xxhash64("text"))
    forest = _Forest(rows, width, percent, seed)
    labels = forest.reps.select("id", "size", "sig").mapInPandas(_labels, "tree int, high bigint, low bigint, id bigint, size int")
    placed, placed_path = positions(labels, "tree", "high", "low", "id")
    block = F.floor(F.col("idx") / BLOCK)
    tail = F.col("idx") % BLOCK < WINDOW
    copies = F.when(tail & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    near = placed.select("*", F.explode(copies).alias("block")).withColumn("own", F.col("block") == block)
    pairs = near.groupBy("block").applyInPandas(_neighbours(percent), "a bigint, b bigint").distinct()
    likely, likely_path = keep(forest.likely(pairs), "likely")
    both = likely.union(likely.select(F.col("b").alias("a"), F.col("a").alias("b"), "same"))
    best = both.groupBy("a").agg(F.max(F.struct("same", (-F.col("b")).alias("b"))).alias("m"))
    first = best.select(F.least("a", -F.col("m.b")).alias("a"), F.greatest("a", -F.col("m.b")).alias("b")).distinct()
    links, _ = keep(forest.verified(first).union(forest.shared()), "verified")
    components = connected_components(links)
    more, _ = keep(forest.verified(forest.across(likely.join(first, ["a", "b"], "left_anti"), components)), "verified")
    links = links.union(more)
    components = connected_components(links)
    rest = _dense_rest(forest, placed, components)
    if rest is not None:
        final, _ = keep(rest, "verified")
        if not final.isEmpty():
            components = connected_components(links.union(final))
    drop(forest.spark, placed_path, likely_path)
    component = F.coalesce("name", "doc")
    return forest.members.join(forest.named(components), "id", "left").select(
        F.col("doc").alias(row_id),
        F.col("size").cast("bigint").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc"), F.lit(True)).alias("kept"),
    )
