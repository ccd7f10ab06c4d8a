"""Places of points on a Hilbert curve, for any number of dimensions."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """One key (row of bytes, most significant first) for each row of ``cells``.

    ``cells`` holds coordinates below ``2 ** bits``; the first column decides
    first. Bit plane by bit plane, the axes are swapped and mirrored as the
    curve turns in the cell of the planes above, and a Gray code numbers the
    parts of the cell.
    """
    axes = [np.ascontiguousarray(c) for c in cells.T.astype(np.uint32)]
    first, last = axes[0], axes[-1]
    for plane in reversed(range(1, bits)):
        bit, below = np.uint32(1 << plane), np.uint32((1 << plane) - 1)
        for axis in axes:
            upper = (axis & bit) != 0
            swapped = np.where(upper, 0, (first ^ axis) & below).astype(np.uint32)
            first ^= np.where(upper, below, np.uint32(0))
            first ^= swapped
            if axis is not first:
                axis ^= swapped
    for before, axis in zip(axes, axes[1:], strict=False):
        axis ^= before
    turned = np.zeros(len(cells), np.uint32)
    for plane in reversed(range(1, bits)):
        turned ^= np.where((last & np.uint32(1 << plane)) != 0, np.uint32((1 << plane) - 1), np.uint32(0))
    planes = np.empty((len(cells), bits, len(axes)), np.uint8)
    for i, axis in enumerate(axes):
        axis ^= turned
        for plane in range(bits):
            planes[:, plane, i] = axis >> np.uint32(bits - 1 - plane) & np.uint32(1)
    return np.packbits(planes.reshape(len(cells), -1), axis=1)
