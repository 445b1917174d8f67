"""Quality by votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import mixed, text_chunks
from tallyloom.llm.labelled import labelled_sample, remainder
from tallyloom.llm.words import word_hashes

# Hashed terms, latent axes, neighbours that vote, labelled rows of a class at most.
HASHED, AXES, NEIGHBOURS, PER_CLASS = 1 << 11, 64, 24, 3_000
# Beside the hashed terms: words new to the text, words met before, words equal to the one
# before. There are few of these among hundreds, so they weigh more.
TERMS, EMPHASIS = HASHED + 3, 4
# A vote weighs the similarity to this power.
SHARPNESS = 8
# Documents whose terms are held as a dense block.
ROWS = 512


def _shapes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, blank, line end, beyond ASCII, or the mark itself."""
    shape = np.arange(256, dtype=np.uint64)
    shape[ord("a") : ord("z") + 1] = ord("a")
    shape[ord("A") : ord("Z") + 1] = ord("A")
    shape[ord("0") : ord("9") + 1] = ord("0")
    shape[128:] = 128
    return shape


SHAPES = _shapes()


def term_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed terms of each text: byte triples, shape quadruples, and words met before."""
    texts = len(offsets) - 1
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    last = offsets[owner + 1] if len(owner) else owner
    rooms = []
    for width, source in ((3, data.astype(np.uint64)), (4, SHAPES[data] + np.uint64(1_000))):
        count = len(data) - width + 1
        if count <= 0:
            continue
        with np.errstate(over="ignore"):
            gram = np.zeros(count, np.uint64)
            for i in range(width):
                gram = gram * np.uint64(0x100000001B3) + source[i : i + count]
        inside = np.arange(count) + width <= last[:count]
        term = (mixed(gram[inside]) & np.uint64(HASHED - 1)).astype(np.int64)
        rooms.append(owner[:count][inside] * TERMS + term)
    words, ranges = word_hashes(data, offsets)
    if len(words):
        text = np.repeat(np.arange(texts), np.diff(ranges))
        known = np.zeros(len(words), bool)
        order = np.lexsort((words, text))
        known[order[1:]] = (words[order[1:]] == words[order[:-1]]) & (text[order[1:]] == text[order[:-1]])
        just = np.zeros(len(words), bool)
        just[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
        rooms += [text * TERMS + HASHED + known, text[just] * TERMS + HASHED + 2]
    found = np.bincount(np.concatenate(rooms), minlength=texts * TERMS) if rooms else np.zeros(texts * TERMS)
    return found.reshape(texts, TERMS)


def _blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for first, last, data, offsets in text_chunks(column):
        for low in range(first, last, ROWS):
            high = min(low + ROWS, last)
            part = offsets[low - first : high - first + 1]
            yield low, term_counts(data[part[0] : part[-1]], part - part[0])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(TERMS, np.int64), 0
    for batch in batches:
        for _, counts in _blocks(batch.column("text")):
            total += (counts > 0).sum(axis=0)
            rows += len(counts)
    yield pa.record_batch([pa.array(range(-1, TERMS), pa.int32()), pa.array([rows, *total.tolist()], pa.int64())], ["term", "n"])


@dataclass
class Space:
    """Term weights and latent axes."""

    idf: np.ndarray
    axes: np.ndarray

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        """Rows of unit length: damped counts times inverse document frequency."""
        out = np.log1p(counts).astype(np.float32) * self.idf
        norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.divide(out, norm, out=out, where=norm > 0)

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return self.turned(self.weighted(counts))

    def turned(self, weighted: np.ndarray) -> np.ndarray:
        out = weighted @ self.axes
        norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.divide(out, norm, out=np.zeros_like(out), where=norm > 1e-6)


def _counts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, counts in _blocks(batch.column("text")):
            rows = [c.astype(np.int32).tobytes() for c in counts]
            part = batch.slice(low, len(rows))
            yield pa.record_batch([part.column("doc_id"), part.column("y"), pa.array(rows, pa.binary())], ["doc_id", "y", "counts"])


@dataclass
class Voters:
    """Labelled documents as latent vectors; at most ``2 * PER_CLASS`` rows."""

    space: Space
    vectors: np.ndarray
    good: np.ndarray
    weights: np.ndarray
    prior: float

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest; the prior where nothing is similar.

        Rows as similar as the last of the nearest vote too, so ties need no order.
        """
        latent = self.space.latent(counts)
        out = np.full(len(latent), self.prior)
        if not len(self.vectors):
            return out
        near = latent @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        edge = np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        near[(near < edge[:, None]) | (near < 0)] = 0
        row, vote = np.nonzero(near)
        votes = near[row, vote].astype(np.float64) ** SHARPNESS * self.weights[vote]
        total = np.bincount(row, votes, minlength=len(latent))
        heard = total > 1e-9
        out[heard] = np.bincount(row, votes * self.good[vote], minlength=len(latent))[heard] / total[heard]
        return np.clip(out, 0.0, 1.0)


FITTED = "axes binary, vectors binary, good binary"


def _fitted(idf: np.ndarray):
    """Axes and latent vectors of the sample; one task holds its at most ``2 * PER_CLASS`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, blocks, good = Space(idf, np.zeros((TERMS, 1), np.float32)), [], []
        for batch in batches:
            if len(batch):
                counts = np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.int32).reshape(-1, TERMS)
                blocks.append(space.weighted(counts))
                good.append(batch.column("y").to_numpy().astype(np.float64))
        if not blocks:
            return
        gram = sum(block.T @ block for block in blocks).astype(np.float64)
        _, axes = np.linalg.eigh(gram)
        space.axes = np.ascontiguousarray(axes[:, ::-1][:, :AXES]).astype(np.float32)
        vectors = np.concatenate([space.turned(block) for block in blocks])
        parts = [space.axes.tobytes(), vectors.tobytes(), np.concatenate(good).tobytes()]
        yield pa.record_batch([pa.array([p], pa.binary()) for p in parts], ["axes", "vectors", "good"])

    return run


def fit_voters(documents: DataFrame, labels: DataFrame, usable, label: str = "quality", seed: int = 3) -> Voters:
    """Term weights from all documents, axes and voters from a bounded sample of labelled ones.

    The sample is turned into latent vectors in one task; the driver gets these and the axes, about 2 MB.
    """
    counted = documents.select("text").mapInArrow(_document_counts, "term int, n bigint")
    counts = {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    df = np.array([counts.get(t, 0) for t in range(TERMS)], np.float64)
    idf = (np.log((1 + counts.get(-1, 0)) / (1 + df)) + 1).astype(np.float32)
    idf[HASHED:] *= EMPHASIS
    sample, sizes = labelled_sample(documents, labels, label, usable, PER_CLASS, seed)
    rows = sample.mapInArrow(_counts_of, "doc_id bigint, y int, counts binary")
    fitted = rows.repartition(1).sortWithinPartitions("doc_id", "y", "counts").mapInArrow(_fitted(idf), FITTED).first()
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.5
    if fitted is None:
        return Voters(Space(idf, np.zeros((TERMS, 1), np.float32)), np.zeros((0, 1), np.float32), np.zeros(0), np.zeros(0), prior)
    space = Space(idf, np.frombuffer(fitted.axes, np.float32).reshape(TERMS, -1))
    good = np.frombuffer(fitted.good, np.float64)
    # A class that the sample holds too much of votes with less weight.
    held = {y: max((good == y).sum(), 1) for y in (0, 1)}
    weights = np.where(good == 1, sizes.get(1, 0) / held[1], sizes.get(0, 0) / held[0])
    return Voters(space, np.frombuffer(fitted.vectors, np.float32).reshape(len(good), -1), good, weights, prior)


def _score(voters: Voters, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [voters.scores(counts) for _, counts in _blocks(batch.column("text"))]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.record_batch([*(batch.column(n) for n in names), pa.array(scores)], [*names, "score"])

    return run


def good_documents(documents: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, at_least: float = 0.7) -> DataFrame:
    """The rows of ``documents`` that :func:`quality_scores` predicts as label 1, all columns unchanged.

    Null and empty texts, repeated rows and null ids are scored as there; each row stands for itself.
    """
    voters = fit_voters(documents, labels, remainder(F.col("doc_id"), modulus) != held)
    names = [f"c_{i}" for i in range(len(documents.columns))]
    rows = documents.select(*[F.col(c).alias(n) for c, n in zip(documents.columns, names)], F.col("text").alias("text"))
    kinds = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, documents.schema))
    scored = rows.mapInArrow(_score(voters, names), f"{kinds}, score double").where(F.col("score") >= at_least)
    return scored.drop("score").toDF(*documents.columns)


def quality_scores(documents: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2, at_least: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each document.

    Documents are vectors of hashed terms (byte triples, shapes of four characters, repeated
    words) weighted by inverse document frequency over all documents, projected to 64
    latent axes. At most 3,000 labelled rows of each class, about 2 MB of vectors,
    go to every task, which multiplies them with its documents block by block.
    The 24 most similar, and all that tie with the last of them, vote with their similarity to the eighth power.

    Labels come only from rows whose crc32 of the id leaves another remainder than
    ``held``. Null and empty texts, and texts like no labelled one, get the
    share of label 1; without labels all scores are that of an even prior, 0.5. Other columns and
    labels of other rows are ignored; an empty table gives no rows.
    """
    usable = remainder(F.col("doc_id"), modulus) != held
    voters = fit_voters(documents, labels, usable)
    scored = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _score(voters, ["doc_id"]), "doc_id bigint, score double"
    )
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), modulus) == held).alias("held_out"),
        "score",
        (F.col("score") >= at_least).cast("int").alias("predicted"),
    )
