"""Two Bloom filters over a column of 64-bit hashes: seen once, and seen twice.

Each builder task adds its hashes to a filter of hashes seen, and those that
the filter already holds to a second one. Two tasks' filters merge by

    twice = twice1 | twice2 | (once1 & once2),  once = once1 | once2

so a hash that two rows share, in one task or in two, is always in the merged
second filter; others get in with the filters' false-positive rate only.
The filters have a fixed size, ``2 ** log2_bits`` bits each, whatever the
input: more rows make more false suspects, never a wrong result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from playstats.llm.common import released

LOG2_BITS, N_HASHES = 25, 3
#: Bytes of one slice of a filter; slices are merged independently.
SLICE = 1 << 15


def positions(hashes: np.ndarray, log2_bits: int, n_hashes: int = N_HASHES) -> np.ndarray:
    """One row of bit positions for each hash function."""
    h = hashes.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64((1 << log2_bits) - 1)
    with np.errstate(over="ignore"):
        return np.stack([((h + np.uint64(k) * step) & mask).astype(np.int64) for k in range(n_hashes)])


def add_hashes(flags: np.ndarray, hashes: np.ndarray, log2_bits: int) -> None:
    """``flags`` has one byte a bit: 1 for seen, 2 for seen twice."""
    distinct, counts = np.unique(hashes, return_counts=True)
    at = positions(distinct, log2_bits)
    again = (counts > 1) | (flags[at] & 1).all(axis=0)
    flags[at[:, again]] |= 2
    flags[at] |= 1


def _first_column(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield batch.column(0).drop_null().to_numpy(zero_copy_only=False)


def seen_twice(rows: DataFrame, log2_bits: int = LOG2_BITS, hashes_of=_first_column) -> bytes:
    """The merged second filter, packed to ``2 ** log2_bits / 8`` bytes.

    ``hashes_of`` yields the hashes of a batch of ``rows``, in parts; by
    default the first column holds them.
    """
    return _merged(rows, log2_bits, "twice", hashes_of)


def seen_once(rows: DataFrame, log2_bits: int = LOG2_BITS) -> bytes:
    """The merged first filter: a plain Bloom filter of the first column."""
    return _merged(rows, log2_bits, "once", _first_column)


def _merged(rows: DataFrame, log2_bits: int, which: str, hashes_of) -> bytes:

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = None
        for batch in batches:
            for values in hashes_of(batch):
                if len(values):
                    flags = np.zeros(1 << log2_bits, np.uint8) if flags is None else flags
                    add_hashes(flags, values, log2_bits)
        if flags is None:
            return
        size = min(SLICE, (1 << log2_bits) // 8)
        for k in range((1 << log2_bits) // 8 // size):
            part = flags[k * size * 8 : (k + 1) * size * 8]
            if part.any():
                once, twice = np.packbits(part & 1).tobytes(), np.packbits(part >> 1).tobytes() if which == "twice" else b""
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([once]), pa.array([twice])], names=["slice", "once", "twice"])

    def merge(table: pa.Table) -> pa.Table:
        once = twice = None
        for a, b in zip(table.column("once"), table.column("twice"), strict=True):
            a = np.frombuffer(a.as_py(), np.uint8)
            b = np.frombuffer(b.as_py(), np.uint8) if which == "twice" else a
            once, twice = (a, b) if once is None else (once | a, twice | b | (once & a))
        chosen = {"once": once, "twice": twice}[which]
        return pa.table({"slice": table.column("slice")[:1], "bits": pa.array([chosen.tobytes()])})

    # one filter for each core, not for each split of the input
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    slices = rows.coalesce(tasks).mapInArrow(released(build), "slice int, once binary, twice binary")
    merged = slices.groupBy("slice").applyInArrow(merge, "slice int, bits binary")
    size = min(SLICE, (1 << log2_bits) // 8)
    out = bytearray((1 << log2_bits) // 8)
    for row in merged.toLocalIterator():  # 2 ** log2_bits / 8 bytes in all, at any input
        out[row["slice"] * size : (row["slice"] + 1) * size] = row["bits"]
    return bytes(out)


def in_filter(packed: np.ndarray, hashes: np.ndarray, log2_bits: int) -> np.ndarray:
    """Whether the filter may hold each hash; never False for one that it holds."""
    at = positions(hashes, log2_bits)
    return ((packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=0)
