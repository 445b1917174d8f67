"""Suffix arrays of byte strings in numpy."""

from __future__ import annotations

import numpy as np


def byte_words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(len(data), np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | padded[i : i + len(data)]
    return words


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling after Larsson and Sadakane.

    A rank is the place where the group of equal prefixes starts. Each round sorts
    only inside groups of more than one suffix, by the ranks of what follows the
    prefix, which doubles the sorted prefix. Shorter suffixes come first. Fewer than 2**31 bytes.
    """
    size = len(data)
    words = byte_words(data)
    order = np.argsort(words, kind="stable")
    ahead = words[order]
    # Zeros after the end equal zero bytes of the text; the tail is told apart by length.
    tail = np.minimum(size - order, 8)
    fresh = np.ones(size, bool)
    if size > 1:
        fix = np.lexsort((tail, ahead)) if (data == 0).any() else None
        if fix is not None:
            order, ahead, tail = order[fix], ahead[fix], tail[fix]
        fresh[1:] = (ahead[1:] != ahead[:-1]) | (tail[1:] != tail[:-1])
    rank = np.empty(size + 1, np.int64)
    rank[size] = -1
    place = np.flatnonzero(np.ones(size, bool))
    rank[order] = np.maximum.accumulate(np.where(fresh, place, 0))
    open_ = np.flatnonzero(~(fresh & np.append(fresh[1:], True))) if size else place
    step = 8
    while len(open_):
        suffixes = order[open_]
        key = (rank[suffixes] << 32) | (rank[np.minimum(suffixes + step, size)] + 1)
        inside = np.argsort(key, kind="stable")
        suffixes, key = suffixes[inside], key[inside]
        order[open_] = suffixes
        starts = np.ones(len(key), bool)
        starts[1:] = key[1:] != key[:-1]
        rank[suffixes] = np.maximum.accumulate(np.where(starts, open_, 0))
        alone = starts & np.append(starts[1:], True)
        open_ = open_[~alone]
        step *= 2
    return order


def common_prefixes(
    data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, order: np.ndarray, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """Common prefixes, up to ``depth``, of suffixes that follow each other in ``order``.

    ``data`` joins pieces at ``starts`` with ``lengths``; only suffixes with at
    least ``depth`` bytes left in their piece count. Returns these suffixes in order and the
    prefix each has in common with the one before. After Kasai: from one position of a
    piece to the next the prefix shrinks by one at most, so what is known is carried on.
    All pieces advance together.
    """
    words = byte_words(data)
    used = np.maximum(lengths - depth + 1, 0)
    live = np.zeros(len(data) + 1, bool)
    for_all = np.repeat(starts - np.concatenate([[0], np.cumsum(used)[:-1]]), used) + np.arange(used.sum())
    live[for_all] = True
    kept = order[live[order]]
    before = np.full(len(data), -1, np.int64)
    before[kept[1:]] = kept[:-1]
    shared = np.zeros(len(data), np.int64)
    known = np.zeros(len(starts), np.int64)
    pieces = np.arange(len(starts))
    last = len(words) - 1
    for step in range(int(used.max()) if len(used) else 0):
        pieces = pieces[used[pieces] > step]
        at = starts[pieces] + step
        other = before[at]
        have = np.where(other < 0, 0, known[pieces])
        grow = np.flatnonzero(other >= 0)
        while len(grow):
            one, two = at[grow] + have[grow], other[grow] + have[grow]
            differ = words[np.minimum(one, last)] ^ words[np.minimum(two, last)]
            equal = np.zeros(len(grow), np.int64)
            for low in range(0, 64, 8):
                equal += differ < np.uint64(1 << low) if low else differ == 0
            have[grow] = np.minimum(have[grow] + equal, depth)
            grow = grow[(differ == 0) & (have[grow] < depth)]
        shared[at] = have
        carry = (other >= 0) & live[other + 1]
        known[pieces] = np.where(carry, np.maximum(have - 1, 0), 0)
    return kept, shared[kept]
