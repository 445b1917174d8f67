"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keep, mixed, text_chunks
from tallyloom.llm.labelled import labelled_sample, remainder
from tallyloom.llm.words import LETTERS, LOWER

# Hashed n-grams of these widths; labelled rows of a class at most.
WIDTHS, TERMS, PER_CLASS = (3, 4, 5, 6), 1 << 18, 6_000
# N-grams in the classifier: those whose ratio stands out by this many standard errors, the clearest first.
LEAST_Z, MOST_TERMS = 4.0, 2_048
SMOOTH, PENALTY, STEPS = 1.0, 1e-4, 2_000


def gram_terms(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and hashed term of every n-gram of A-Z lower-cased bytes, width by width."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    last = offsets[owner + 1] if len(owner) else owner
    value = LETTERS[LOWER[data]]
    gram = np.zeros(0, np.uint64)
    for width in range(1, max(WIDTHS) + 1):
        count = len(data) - width + 1
        if count <= 0:
            return
        with np.errstate(over="ignore"):
            gram = value.copy() if width == 1 else gram[:count] * np.uint64(0x9FB21C651E98DF25) + value[width - 1 :]
        if width in WIDTHS:
            inside = np.arange(count) + width <= last[:count]
            yield owner[:count][inside], (mixed(gram[inside]) & np.uint64(TERMS - 1)).astype(np.int64)


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a term; term -1 counts the documents."""
    counts, rows = np.zeros((2, TERMS), np.int64), [0, 0]
    for batch in batches:
        labels = batch.column("y").to_numpy()
        for first, last, data, offsets in text_chunks(batch.column("text")):
            pairs = [owner * TERMS + term for owner, term in gram_terms(data, offsets)]
            seen = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
            side = labels[first + seen // TERMS]
            for y in (0, 1):
                counts[y] += np.bincount(seen[side == y] % TERMS, minlength=TERMS)
                rows[y] += int((labels[first:last] == y).sum())
    held = np.flatnonzero(counts.any(axis=0))
    columns = [np.append(held, -1), np.append(counts[0, held], rows[0]), np.append(counts[1, held], rows[1])]
    yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["term", "zeros", "ones"])


def _found_terms(slots: np.ndarray):
    """Chosen terms that each text holds, as ``(text, slot)`` pairs without repeats."""

    def find(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for first, last, data, offsets in text_chunks(column):
            found = []
            for owner, term in gram_terms(data, offsets):
                slot = slots[term]
                hit = np.flatnonzero(slot >= 0)
                found.append(owner[hit] * MOST_TERMS + slot[hit])
            seen = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            yield first, last, seen // MOST_TERMS, seen % MOST_TERMS

    return find


def _sample_terms(slots: np.ndarray):
    find = _found_terms(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, text, slot in find(batch.column("text")):
                cuts = np.searchsorted(text, np.arange(last - first + 1))
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(slot.astype(np.int16), pa.int16()))
                part = batch.slice(first, last - first)
                yield pa.record_batch([part.column("doc_id"), part.column("y"), lists], ["doc_id", "y", "slots"])

    return run


def logistic_fit(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, size: int) -> np.ndarray:
    """Weights, and the intercept as the last, by accelerated gradient steps on a sparse table."""
    count = max(len(labels), 1)
    weights = look = np.zeros(size + 1)
    load = np.bincount(rows, values**2, minlength=count) + 1
    rate, pace = 1 / (0.25 * load.max() + PENALTY), 1.0
    for _ in range(STEPS):
        margin = np.bincount(rows, look[columns] * values, minlength=count) + look[-1]
        error = 1 / (1 + np.exp(-margin)) - labels
        slope = np.append(np.bincount(columns, error[rows] * values, minlength=size), error.sum()) / count
        slope[:-1] += PENALTY * look[:-1]
        following = look - rate * slope
        new_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        look = following + (pace - 1) / new_pace * (following - weights)
        weights, pace = following, new_pace
    return weights


@dataclass
class Classifier:
    """Slot of each chosen term, -1 for the others, weights and intercept."""

    slots: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for first, last, text, slot in _found_terms(self.slots)(column):
            out[first:last] = np.bincount(text, self.weights[slot], minlength=last - first)
        return 1 / (1 + np.exp(-np.clip(out + self.intercept, -40, 40)))


def fit_toxicity(documents: DataFrame, labels: DataFrame, usable, label: str = "toxic", seed: int = 9) -> Classifier:
    """Ratios, terms and weights from a bounded sample of labelled documents.

    The intercept is moved from the sample's class balance to that of all labelled rows.
    """
    chosen, sizes = labelled_sample(documents, labels, label, usable, PER_CLASS, seed)
    sample, _ = keep(chosen, "labelled")
    counted = sample.mapInArrow(_class_counts, "term bigint, zeros bigint, ones bigint")
    table = counted.groupBy("term").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toPandas()
    table = table.sort_values("term")
    totals = table[table["term"] < 0]
    zeros, ones = (int(totals[c].sum()) for c in ("zeros", "ones"))
    table = table[table["term"] >= 0]
    held = table[["zeros", "ones"]].to_numpy(np.float64) + SMOOTH
    share = held / (np.array([zeros, ones]) + 2 * SMOOTH)
    ratio = np.log(share[:, 1] / share[:, 0])
    error = np.sqrt((1 / held - 1 / (np.array([zeros, ones]) + 2 * SMOOTH)).sum(axis=1))
    clear = np.abs(ratio) / np.maximum(error, 1e-9)
    best = np.argsort(-clear, kind="stable")[:MOST_TERMS]
    best = best[clear[best] >= LEAST_Z]
    slots = np.full(TERMS, -1, np.int16)
    slots[table["term"].to_numpy()[best]] = np.arange(len(best))
    scale = ratio[best]
    rows = sample.mapInArrow(_sample_terms(slots), "doc_id bigint, y int, slots array<smallint>").toPandas()
    rows = rows.sort_values(["doc_id", "y"], kind="stable").reset_index(drop=True)
    lists = [np.asarray(s, np.int64) for s in rows["slots"]]
    columns = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    at = np.repeat(np.arange(len(lists)), [len(x) for x in lists]).astype(np.int64)
    fitted = logistic_fit(at, columns, scale[columns], rows["y"].to_numpy(np.float64), len(best))
    prior = np.log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5)) - np.log((ones + 0.5) / (zeros + 0.5))
    return Classifier(slots, fitted[:-1] * scale, float(fitted[-1] + prior))


def _score(classifier: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), pa.array(classifier.scores(batch.column("text")))], ["doc_id", "score"])

    return run


def toxicity_scores(documents: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, at_least: float = 0.7) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for each document.

    Features are the hashed n-grams of three to six bytes that a text holds, each
    scaled by the log ratio of its document counts in both classes. Ratios come
    from up to 6,000 labelled rows of each class, as do the weights of at
    most 2,048 n-grams whose ratio is clear. One scan scores all documents; only
    the classifier, under 1 MB, goes to the tasks.

    Labels come only from rows whose crc32 of the id leaves another remainder than
    ``held``. A null or empty text has no features and gets the score of the
    intercept; without labels that is 0.5. Other columns are ignored; an empty table gives no rows.
    """
    usable = remainder(F.col("doc_id"), modulus) != held
    classifier = fit_toxicity(documents, labels, usable)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = rows.mapInArrow(_score(classifier), "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), modulus) == held).alias("held_out"),
        "score",
        (F.col("score") >= at_least).cast("int").alias("predicted"),
    )
