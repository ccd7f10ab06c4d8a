"""Sets of word shingles as sorted 64-bit hashes, for whole Arrow batches at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from playstats.llm.common import flat_words, mix64, sort_rows, word_hashes


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words of the lower-cased texts: hashes, and the row of each, by row and hash.

    A text with fewer words is one shingle of all its words; one without
    words has none.
    """
    words, rows = flat_words(texts, lower=True)
    hashes = word_hashes(words)
    n = len(texts)
    counts = np.bincount(rows, minlength=n)
    out_hash, out_row = [], []
    with np.errstate(over="ignore"):
        if len(hashes) >= size:
            last = len(hashes) - size + 1
            joined = hashes[:last].copy()
            for k in range(1, size):
                joined = mix64(joined, k) + hashes[k : k + last]
            whole = rows[:last] == rows[size - 1 :]
            out_hash.append(mix64(joined[whole], size))
            out_row.append(rows[:last][whole])
        starts = np.cumsum(counts) - counts
        for row in np.flatnonzero((counts > 0) & (counts < size)).tolist():
            joined = hashes[starts[row] : starts[row] + 1]
            for k in range(1, counts[row]):
                joined = mix64(joined, k) + hashes[starts[row] + k : starts[row] + k + 1]
            out_hash.append(mix64(joined, int(counts[row])))
            out_row.append(np.array([row]))
    if not out_hash:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h, r = np.concatenate(out_hash), np.concatenate(out_row)
    order = sort_rows(r, h)
    h, r = h[order], r[order]
    first = np.concatenate([[True], (h[1:] != h[:-1]) | (r[1:] != r[:-1])])
    return h[first], r[first]
