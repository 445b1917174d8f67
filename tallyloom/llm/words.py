"""Hashes of words and shingles of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallyloom.llm.common import mixed, text_chunks

SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"
IS_SPACE = np.isin(np.arange(256), list(SPACES))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = np.uint64(0xD1342543DE82EF95)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    steps = np.full(max(count, 1), base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a run of texts, and the word range of each text.

    Words are runs of bytes other than space, tab, line and page breaks; A-Z are
    lower-cased. A word never crosses two texts.
    """
    letter = ~IS_SPACE[data]
    opens = letter.copy()
    opens[1:] &= ~letter[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    opens[edges] = letter[edges]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = np.cumsum(opens) - 1
    depth = np.arange(len(data)) - starts[np.maximum(word, 0)]
    depth[~letter] = 0
    with np.errstate(over="ignore"):
        value = LETTERS[LOWER[data]] * _powers(BASE, int(depth.max()) + 1)[depth]
    value[~letter] = 0
    return mixed(np.add.reduceat(value, starts)), np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a column.

    A shingle is ``width`` words in a row; a text with fewer words has its whole
    sequence as its only shingle, a text without words has none.
    """
    factors = [mixed(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(width)]
    for _, _, data, offsets in text_chunks(column):
        words, ranges = word_hashes(data, offsets)
        with np.errstate(over="ignore"):
            span = max(len(words) - width + 1, 0)
            long = np.zeros(span, np.uint64)
            for i, factor in enumerate(factors):
                long += words[i : i + span] * factor
            long = mixed(long)
            for first, last in zip(ranges[:-1], ranges[1:]):
                count = last - first
                if count >= width:
                    yield np.unique(long[first : last - width + 1])
                elif count:
                    short = sum((words[first + i] * factors[i] for i in range(count)), np.uint64(count))
                    yield mixed(np.array([short], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)
