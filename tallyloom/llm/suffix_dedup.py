"""Removal of repeated byte strings by suffix arrays of shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keep, mixed, text_chunks
from tallyloom.llm.suffixes import common_prefixes, suffix_array

# A repeated string has this many bytes.
LENGTH = 200
# Bytes of the grams that anchor strings.
GRAM = 32
# Start positions that are scanned at once.
STRIDE = 1 << 21
# Bytes of text in a shard.
SHARD_BYTES = 2 << 20
# Strings of split shards that one merging task holds, about.
MERGE_ROWS = 500_000
BASES = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0xD6E8FEB86659FD93))
LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
NO_ID = -(1 << 63)
CONTEXT = ["fp", "ctx", "span", "before"]


class _Rolling:
    """Hashes of arbitrary stretches of a byte array from prefix sums."""

    def __init__(self, data: np.ndarray, base: np.uint64):
        with np.errstate(over="ignore"):
            power = np.full(len(data) + 1, base, np.uint64)
            power[0] = 1
            power = np.multiply.accumulate(power)
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(LETTERS[data] * power[:-1], out=self.sums[1:])
            back = np.full(len(data) + 1, np.uint64(pow(int(base), -1, 1 << 64)), np.uint64)
            back[0] = 1
            self.back = np.multiply.accumulate(back)

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[last] - self.sums[first]) * self.back[first])


def _least_of_windows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each position on, by block-wise running minima."""
    blocks = -(-len(values) // width) + 1
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    square = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(square, axis=1).ravel()
    backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def _anchored(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of start positions that have the same anchor, over a run of texts.

    The anchor of a string of 200 bytes is its gram with the smallest hash, the
    first of equals, so equal strings have equal anchors at the same distance. Returns text number, first start, number of starts, bytes
    from the first start to the anchor, anchor hash and hash of the run's context.
    """
    texts = len(offsets) - 1
    if len(data) < LENGTH:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    rolling = _Rolling(data, BASES[0])
    grams = np.arange(len(data) - GRAM + 1)
    prints = rolling(grams, grams + GRAM)
    key = (prints & ~np.uint64(0xFFFFFF)) | grams.astype(np.uint64)
    least = _least_of_windows(key, LENGTH - GRAM + 1)
    owner = np.repeat(np.arange(texts), np.diff(offsets))[: len(least)]
    whole = np.arange(len(least)) + LENGTH <= offsets[owner + 1]
    starts = np.flatnonzero(whole)
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    anchor = (least[starts] & np.uint64(0xFFFFFF)).astype(np.int64)
    opens = np.ones(len(starts), bool)
    opens[1:] = (anchor[1:] != anchor[:-1]) | (owner[starts[1:]] != owner[starts[:-1]])
    heads = np.flatnonzero(opens)
    span = np.diff(np.append(heads, len(starts)))
    first, mark = starts[heads], anchor[heads]
    text = owner[first]
    return text, first - offsets[text], span, mark - first, prints[mark], rolling(first, first + span + LENGTH - 1)


OCCURRENCE = "id bigint, tag bigint, lo bigint, span int, before int, fp bigint, ctx bigint"


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, tags = batch.column("id").to_numpy(), batch.column("tag").to_numpy()
        for first, last, data, offsets in text_chunks(batch.column("text")):
            for start in range(0, max(len(data), 1), STRIDE):
                # A long text comes alone and is scanned in strides that share 199 bytes.
                part = data[start : start + STRIDE + LENGTH - 1] if len(data) > STRIDE else data
                ends = np.array([0, len(part)]) if len(data) > STRIDE else offsets
                text, lo, span, before, fp, ctx = _anchored(part, ends)
                yield pa.record_batch(
                    [
                        pa.array(ids[first + text]),
                        pa.array(tags[first + text]),
                        pa.array(lo + start),
                        pa.array(span.astype(np.int32)),
                        pa.array(before.astype(np.int32)),
                        pa.array(fp.view(np.int64)),
                        pa.array(ctx.view(np.int64)),
                    ],
                    ["id", "tag", "lo", "span", "before", "fp", "ctx"],
                )
                if len(data) <= STRIDE:
                    break


CONTEXT_KINDS = "fp bigint, ctx bigint, span int, before int"
DECIDED = f"{CONTEXT_KINDS}, first int, last int, salt bigint, weight bigint, k1 array<bigint>, k2 array<bigint>"


def _shard(key, group: pd.DataFrame) -> pd.DataFrame:
    """Runs of repeated starts of a shard's contexts, from its suffix array.

    A context counts as often as it occurs. A split shard returns one row per
    context with the hashes of all its strings instead.
    """
    # Equal rows of the documents yield equal contexts; their number is in the weight.
    group = group.drop_duplicates(CONTEXT).reset_index(drop=True)
    bodies = group["body"].tolist()
    lengths = np.array([len(b) for b in bodies], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    data = np.frombuffer(b"".join(bodies), np.uint8)
    span = group["span"].to_numpy().astype(np.int64)
    kept, shared = common_prefixes(data, starts, lengths, suffix_array(data), LENGTH)
    classes = np.cumsum(shared < LENGTH) - 1
    if key[0]:
        # One hash per class of equal strings, handed to all its starts.
        sample = kept[np.flatnonzero(shared < LENGTH)]
        hashes = []
        for base in BASES:
            own = np.zeros(len(data), np.int64)
            own[kept] = _Rolling(data, base)(sample, sample + LENGTH).view(np.int64)[classes]
            hashes.append([own[s : s + n] for s, n in zip(starts, span)])
        return group[[*CONTEXT, "weight"]].assign(first=0, last=-1, salt=key[2], k1=hashes[0], k2=hashes[1])
    context = np.searchsorted(starts, kept, "right") - 1
    weight = np.bincount(classes, group["weight"].to_numpy()[context])
    # The last 199 bytes of a context start nothing, so runs of two contexts never touch.
    marked = np.zeros(len(data) + 2, np.int8)
    marked[1 + kept[weight[classes] >= 2]] = 1
    edges = np.diff(marked)
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1
    rows = np.searchsorted(starts, first, "right") - 1
    out = group[[*CONTEXT, "weight"]].iloc[rows].reset_index(drop=True)
    return out.assign(first=first - starts[rows], last=last - starts[rows], salt=key[2], k1=None, k2=None)


def _merge(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted runs of strings with counts as one, by binary search."""
    if not len(one[0]):
        return two
    at = np.searchsorted(one[0], two[0])
    same = one[0][np.minimum(at, len(one[0]) - 1)] == two[0]
    counts = one[1].copy()
    counts[at[same]] += two[1][same]
    return np.insert(one[0], at[~same], two[0][~same]), np.insert(counts, at[~same], two[1][~same])


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """Starts of split shards whose string occurs at least twice in all shards together."""
    strings = np.zeros(len(group), [("a", np.int64), ("b", np.int64)])
    strings["a"], strings["b"] = group["k1"], group["k2"]
    ranks = np.unique(strings, return_inverse=True)[1]
    runs = []
    for rows in group.groupby("salt").indices.values():
        own, place = np.unique(ranks[rows], return_inverse=True)
        runs.append((own, np.bincount(place, group["weight"].to_numpy()[rows]).astype(np.int64)))
    while len(runs) > 1:
        runs = [_merge(*runs[i : i + 2]) if len(runs[i : i + 2]) == 2 else runs[i] for i in range(0, len(runs), 2)]
    found, counts = runs[0]
    twice = counts[np.searchsorted(found, ranks)] >= 2
    return group.loc[twice, CONTEXT].assign(first=group.loc[twice, "i"], last=group.loc[twice, "i"])


def _covered(offsets: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Bytes of joined texts that strings starting at ``first`` to ``last`` of a text cover."""
    size = int(offsets[-1])
    opened = np.bincount(offsets[text] + first, minlength=size + 1)
    closed = np.bincount(offsets[text] + last + LENGTH, minlength=size + 1)
    return np.cumsum(opened - closed)[:size] > 0


def _cut(names: list[str], with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("_marks")
            counts = np.nan_to_num(pc.list_value_length(marks).to_numpy(zero_copy_only=False)).astype(np.int64)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            runs = marks.flatten()
            firsts, lasts = (runs.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("a", "b"))
            for low, high, data, offsets in text_chunks(batch.column("_text")):
                own = slice(bounds[low], bounds[high])
                text = np.repeat(np.arange(high - low), counts[low:high])
                gone = _covered(offsets, text, firsts[own], lasts[own])
                before = np.concatenate([[0], np.cumsum(gone)])
                opens = gone.copy()
                opens[1:] &= ~gone[:-1]
                edges = offsets[:-1][offsets[:-1] < len(data)]
                opens[edges] = gone[edges]
                spans = np.concatenate([[0], np.cumsum(opens)])
                left = memoryview(data[~gone].tobytes())
                ends = offsets - before[offsets]
                texts = [left[a:b] for a, b in zip(ends[:-1], ends[1:])]
                part = batch.slice(low, high - low)
                yield pa.record_batch(
                    [
                        *(part.column(n) for n in names),
                        pa.array(np.diff(offsets)),
                        pa.array(np.diff(before[offsets])),
                        pa.array(np.diff(spans[offsets])),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                        pa.array([str(t, "utf-8", "ignore") if with_text else None for t in texts], pa.string()),
                    ],
                    [*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
                )

    return run


def _repeated_strings(rows: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Occurrences whose anchor repeats, and the decided starts of their contexts."""
    found = rows.select("id", "tag", "text").mapInArrow(_occurrences, OCCURRENCE)
    repeated = found.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp")
    near, near_path = keep(found.join(repeated, "fp", "left_semi"), "occurrences")
    contexts, contexts_path = keep(
        near.groupBy(*CONTEXT).agg(F.count("*").alias("weight"), F.min(F.struct("id", "tag", "lo")).alias("at")), "contexts"
    )
    size = F.col("span") + LENGTH - 1
    total = contexts.agg(F.sum(size).alias("bytes")).first().bytes or 0
    shards = max(1, -(-total // SHARD_BYTES))
    large = contexts.groupBy("fp").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > SHARD_BYTES)
    dealt = (
        contexts.select(*CONTEXT, "weight", "at.*")
        .join(large, "fp", "left")
        .withColumn("split", F.col("bytes").isNotNull())
        .withColumn("part", F.when(F.col("split"), F.col("fp")).otherwise(F.pmod(F.xxhash64("fp"), F.lit(shards))))
        .withColumn("salt", F.when(F.col("split"), F.pmod("ctx", F.ceil(F.col("bytes") / SHARD_BYTES))).otherwise(F.lit(0)))
        .drop("bytes")
    )
    body = F.substring(F.col("text").cast("binary"), (F.col("lo") + 1).cast("int"), size.cast("int"))
    # Equal rows of the documents have the same id and tag; one of them is enough.
    bodies = dealt.join(rows, ["id", "tag"]).select(*CONTEXT, "weight", "split", "part", "salt", body.alias("body"))
    decided, decided_path = keep(bodies.groupBy("split", "part", "salt").applyInPandas(_shard, DECIDED), "decided")
    return near, decided, [near_path, contexts_path, decided_path]


def _marks(rows: DataFrame) -> DataFrame:
    """``(id, tag, _marks)``: runs of repeated starts of each text."""
    near, decided, _ = _repeated_strings(rows)
    runs = decided.where("k1 is null").select(*CONTEXT, "first", "last")
    split = decided.where("k1 is not null")
    strings = split.select(*CONTEXT, "salt", "weight", F.posexplode(F.arrays_zip("k1", "k2")).alias("i", "k"))
    count = split.agg(F.sum(F.size("k1")).alias("n")).first().n
    if count:
        merged = (
            strings.select(*CONTEXT, "salt", "weight", "i", "k.k1", "k.k2")
            .withColumn("range", F.pmod("k1", F.lit(-(-count // MERGE_ROWS))))
            .groupBy("range")
            .applyInPandas(_merged, f"{CONTEXT_KINDS}, first int, last int")
        )
        runs = runs.union(merged)
    runs = near.join(runs, CONTEXT).select("id", "tag", (F.col("lo") + F.col("first")).alias("a"), (F.col("lo") + F.col("last")).alias("b"))
    return runs.groupBy("id", "tag").agg(F.collect_list(F.struct("a", "b")).alias("_marks"))


def _cut_rows(documents: DataFrame, row_id: str, text: str, carried: list[str], with_text: bool) -> DataFrame:
    key = F.coalesce(F.col(row_id).cast("bigint"), F.lit(NO_ID))
    rows = documents.select(key.alias("id"), F.xxhash64(text).alias("tag"), F.col(text).alias("text"))
    marks = _marks(rows)
    sides = documents.select(
        *[F.col(c).alias(f"c_{i}") for i, c in enumerate(carried)], F.col(text).alias("_text"), key.alias("id"), F.xxhash64(text).alias("tag")
    )
    names = [f"c_{i}" for i in range(len(carried))]
    joined = sides.join(marks, ["id", "tag"], "left").select(*names, "_text", "_marks")
    kinds = ", ".join(f"{n} {documents.schema[c].dataType.simpleString()}" for n, c in zip(names, carried))
    schema = f"{kinds}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_text string"
    return joined.mapInArrow(_cut(names, with_text), schema).withColumnsRenamed(dict(zip(names, carried)))


def removal_report(documents: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(row_id, n_bytes, n_removed, n_spans, kept_sha256)`` for each document.

    A byte goes if a 200-byte string that also starts elsewhere covers it, in
    the same text or another; strings do not cross texts and are judged on the input.

    Each string is anchored at its 32-byte gram with the smallest hash, so equal
    strings meet under equal anchors, and an anchor that occurs once rules its
    strings out. The others' contexts, equal ones once with a weight, are
    shards of about 2 MB. A shard's suffix array (Larsson-Sadakane) and common
    prefixes (Kasai) tell which starts repeat. Contexts of one anchor that
    outgrow a shard are split over several, whose strings are then merged by
    binary search in ranges of their hashes.

    A null text is empty, and texts under 200 bytes lose nothing. Rows that are
    repeated as a whole are copies of each other; rows that share only an id, or
    have none, are judged one by one. Other columns are ignored. An empty table gives no rows.
    """
    return _cut_rows(documents, row_id, text, [row_id], False).drop("kept_text")


def without_repeats(documents: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with the repeated strings cut out of their texts.

    A character of which a cut took some bytes goes as a whole. ``n_chars``,
    where there is one, counts the new text. All rows stay.
    """
    out = _cut_rows(documents, row_id, text, documents.columns, True).withColumn(text, F.col("kept_text"))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.length(text).cast("bigint"))
    return out.select(*documents.columns)
