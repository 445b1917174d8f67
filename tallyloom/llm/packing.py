"""Packing token sequences: non-negative least squares over length combinations."""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import keep

WINDOW = 1_024
# Words whose ids a task remembers.
REMEMBERED = 300_000
# Lengths combined in one window at most.
DEEPEST = 3
# First digits of a hash that number the pieces of one length in parts.
CELL_DIGITS = 2
BEFORE = (Window.unboundedPreceding, -1)
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class _Words(dict):
    """Token ids, as bytes, of words with a blank before them."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        found = array("I", self.encode(" " + word)).tobytes()
        if len(self) < REMEMBERED:
            self[word] = found
        return found


class Encoder:
    """Byte-level BPE of one vocabulary file, as little-endian 32-bit ids.

    Words between single blanks are encoded once and remembered. That gives the
    ids of the whole text because no token reaches over a blank that follows
    a visible character; texts with runs of blanks are encoded in one piece, and
    texts that may hold a special token's name go to the vocabulary's own tokenizer.
    """

    def __init__(self, tokenizer: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        with open(public_tokenizers.path(ranks), "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        self.words = _Words(self.fast.encode_ordinary)

    def encode(self, text: str) -> bytes:
        if "<|" in text:
            return array("I", self.slow.encode(text, add_special_tokens=False).ids).tobytes()
        if "  " in text or text.endswith(" "):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        words = text.split(" ")
        first = array("I", self.fast.encode_ordinary(words[0])).tobytes()
        return first + b"".join(map(self.words.__getitem__, words[1:]))


def _pieces(tokenizer: str, ranks: str, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks)
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encoder.encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def combinations_filling(lengths: np.ndarray, counts: np.ndarray, window: int, each: int = 24) -> np.ndarray:
    """Combinations of at most three lengths that fill a window, as repeat counts per length.

    For every length: its complement, its halves, and the triples with frequent
    lengths. Only exact fills are listed; a sum that no present length completes
    is left to the residual packing. At most ``each`` triples per length keep the
    table below ``25 * window`` columns.
    """
    present = set(lengths.tolist())
    place = {int(v): i for i, v in enumerate(lengths)}
    frequent = [int(v) for v in lengths[np.argsort(-counts, kind="stable")]]
    found = set()
    for one in map(int, lengths):
        if window % one == 0 and window // one <= DEEPEST:
            found.add((one,) * (window // one))
        if window - one in present:
            found.add(tuple(sorted((one, window - one))))
        listed = 0
        for two in frequent:
            rest = window - one - two
            if listed == each:
                break
            if rest in present:
                found.add(tuple(sorted((one, two, rest))))
                listed += 1
    table = np.zeros((len(found), len(lengths)))
    for row, lengths_of in enumerate(sorted(found)):
        for value in lengths_of:
            table[row, place[value]] += 1
    return table


def least_squares(columns: np.ndarray, target: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative ``x`` that makes ``columns.T @ x`` close to ``target``, by accelerated projected gradients."""
    if not len(columns):
        return np.zeros(0)
    bound = (columns @ columns.sum(axis=0)).max()
    x = look = np.zeros(len(columns))
    weight = 1.0
    for _ in range(steps):
        following = np.maximum(look - columns @ (columns.T @ look - target) / bound, 0)
        new_weight = (1 + np.sqrt(1 + 4 * weight * weight)) / 2
        look = following + (weight - 1) / new_weight * (following - x)
        x, weight = following, new_weight
    return x


def packing_slots(histogram: dict[int, int], window: int = WINDOW) -> pd.DataFrame:
    """Where the pieces of each length go: ranges of their numbers in runs of like windows.

    ``histogram`` counts the pieces of each length below ``window``. Returns
    ``(length, first, count, sequence, step, offset)``: pieces ``first`` to
    ``first + count - 1`` of a length lie in windows ``sequence``, ``sequence +
    step``, ... at ``offset``. Repeat counts are the least-squares solution
    rounded down to what is left; residual lengths go greedily, the longest
    first, each taking the longest that still fits. Works on at most ``window`` lengths, whatever the
    number of pieces.
    """
    left = {length: count for length, count in histogram.items() if count}
    out, used, sequence = [], dict.fromkeys(left, 0), 0

    def place(parts: list[int], times: int) -> None:
        nonlocal sequence
        offset = 0
        for length in parts:
            out.append((length, used[length], times, sequence, 1, offset))
            used[length] += times
            left[length] -= times
            offset += length
        sequence += times

    lengths = np.array(sorted(left))
    if len(lengths):
        counts = np.array([left[v] for v in lengths.tolist()], float)
        table = combinations_filling(lengths, counts, window)
        # Lengths with few pieces matter as much as frequent ones.
        solved = least_squares(table, counts)
        for row in np.argsort(-solved, kind="stable"):
            parts = [int(v) for v, n in zip(lengths, table[row]) for _ in range(int(n))]
            times = min([int(np.floor(solved[row] + 0.5))] + [left[v] // parts.count(v) for v in set(parts)])
            if times > 0:
                place(sorted(parts, reverse=True), times)
    while rest := sorted((v for v, n in left.items() if n > 0), reverse=True):
        parts, room = [], window
        for length in rest:
            fit = min(room // length, left[length])
            parts += [length] * fit
            room -= fit * length
        place(parts, max(1, min(left[v] // parts.count(v) for v in set(parts))))
    return pd.DataFrame(out, columns=["length", "first", "count", "sequence", "step", "offset"])


def _assigned(slots: pd.DataFrame):
    runs = {length: part.sort_values("first").reset_index(drop=True) for length, part in slots.groupby("length")}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for length, rows in batch.groupby("length").indices.items():
                own = runs[length]
                number = batch["number"].to_numpy()[rows]
                at = np.searchsorted(own["first"].to_numpy(), number, "right") - 1
                sequence[rows] = own["sequence"].to_numpy()[at] + number - own["first"].to_numpy()[at]
                offset[rows] = own["offset"].to_numpy()[at]
            yield batch.assign(sequence_id=sequence, offset=offset)

    return run


def _numbered(df: DataFrame, group: str, *order: str) -> DataFrame:
    """Zero-based ``number`` of each row within ``group``, which may hold any share of the rows."""
    cell = F.substring(F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in order]).cast("binary")), 1, CELL_DIGITS)
    cells = df.withColumn("cell", cell)
    counts = cells.groupBy(group, "cell").agg(F.count("*").alias("n"))
    ahead = F.coalesce(F.sum("n").over(Window.partitionBy(group).orderBy("cell").rowsBetween(*BEFORE)), F.lit(0))
    inside = F.row_number().over(Window.partitionBy(group, "cell").orderBy(*order)) - 1
    joined = cells.withColumn("inside", inside).join(counts.select(group, "cell", ahead.alias("ahead")), [group, "cell"])
    return joined.withColumn("number", (F.col("inside") + F.col("ahead")).cast("bigint")).drop("cell", "inside", "ahead")


def packed_pieces(
    documents: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = 0,
    tokenizer: str = "byte_bpe_50k.json",
    ranks: str = "byte_bpe_50k.tiktoken",
) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` per piece of a document.

    A document's ids, and the end id after them, are cut into full windows, which
    are sequences by themselves, and one shorter rest. The rests are packed by
    their histogram (:func:`packing_slots`) and take their places by number
    within their length, so only at most ``window`` counts reach the driver.

    A null or empty text is the end id alone. Documents with equal or null ids are
    packed one by one. Other columns are ignored; an empty table gives no rows.
    """
    rows = documents.select(F.col(row_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    pieces, _ = keep(rows.mapInArrow(_pieces(tokenizer, ranks, end_id, window), PIECE), "pieces")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    rests = pieces.where(F.col("length") < window)
    histogram = {r["length"]: r["n"] for r in rests.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = packing_slots(histogram, window)
    short = int(slots["sequence"].add(slots["count"]).max()) if len(slots) else 0
    numbered = _numbered(rests, "length", "doc_id", "start", "ids_crc32", "doc_tokens").select(*names, "number")
    schema = PIECE + ", number bigint, sequence_id bigint, offset bigint"
    packed = numbered.mapInPandas(_assigned(slots), schema).drop("number")
    whole = pieces.where(F.col("length") == window).withColumn("_m", F.monotonically_increasing_id())
    whole, _ = keep(whole, "windows")
    whole = whole.withColumn("_p", F.shiftright("_m", 33))
    parts = whole.groupBy("_p").agg(F.count("*").alias("n"))
    starts = parts.select("_p", F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(*BEFORE)), F.lit(0)).alias("ahead"))
    number = F.col("ahead") + F.col("_m").bitwiseAND((1 << 33) - 1) + short
    full = whole.join(F.broadcast(starts), "_p").select(  # one row per task
        *names, number.cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    return packed.union(full)
