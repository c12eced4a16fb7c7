"""Hilbert keys of many points at a time."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``cells`` (non-negative integers below 2**bits).

    Skilling's transform from axes to the transposed index, one pass per bit plane, then the bits of the
    planes are interleaved.  Dimensions times bits must not exceed 63.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    plane = 1 << (bits - 1)
    while plane > 1:
        low = plane - 1
        for d in range(dims):
            high = (x[d] & plane) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            if d:
                x[d] ^= swap
        plane >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], np.int64)
    plane = 1 << (bits - 1)
    while plane > 1:
        flip ^= np.where((x[dims - 1] & plane) != 0, plane - 1, 0)
        plane >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] >> bit) & 1
    return key
