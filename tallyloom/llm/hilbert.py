"""Positions of grid points on a Hilbert curve, for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the curve of each row of ``cells`` (values below ``2**bits``).

    The axes are turned level by level, from the top bit down, into the frame
    of the sub-cube that the curve has reached; the Gray code of the turned
    bits, read across the axes, is the position. ``bits`` times the number of
    axes must not exceed 63.
    """
    axes = cells.shape[1]
    if bits * axes > 63:
        raise ValueError("a key has at most 63 bits")
    turned = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for axis in range(axes):
            high = (turned[axis] >> level) & 1
            swap = np.where(high == 1, 0, (turned[0] ^ turned[axis]) & below)
            turned[0] ^= np.where(high == 1, below, swap)
            if axis:
                turned[axis] ^= swap
    for axis in range(1, axes):
        turned[axis] ^= turned[axis - 1]
    carry = np.zeros(cells.shape[0], np.int64)
    for level in range(bits - 1, 0, -1):
        carry ^= np.where((turned[-1] >> level) & 1, (1 << level) - 1, 0)
    turned ^= carry
    keys = np.zeros(cells.shape[0], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(axes):
            keys = (keys << 1) | ((turned[axis] >> level) & 1)
    return keys
