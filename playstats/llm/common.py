"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import pickle

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playstats.session import apply_runtime_conf

#: The white space that separates words: [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows and bytes that one Arrow batch brings to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the library's settings and bound the batches sent to Python workers."""
    apply_runtime_conf(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of ``text``; none for null."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column of a batch, null as empty, with 64-bit offsets.

    The rows are copied if the batch is a part of another: some string
    kernels misread arrays that begin inside their buffers.
    """
    column = batch.column(name)
    if column.offset or batch.num_rows and np.frombuffer(column.buffers()[1], np.int32, 1)[0]:
        column = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(column.cast(pa.large_string()), "")


def flat_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` in order, and for each word the row that holds it."""
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(pc.ascii_trim(texts, SPACE))
    words, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(words, "")
    # trimmed texts have an empty word only where the whole text is empty
    return pc.filter(words, full), pc.filter(rows, full).to_numpy(zero_copy_only=False).astype(np.int64)


def released(function):
    """``function`` over Arrow batches, giving freed memory back to the system at its end.

    Workers live on after a task and wait beside the executor's own memory.
    """

    def run(batches):
        import ctypes

        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return run


def ship(spark: SparkSession, value):
    """Broadcast ``value`` with the definitions of its classes.

    A plain broadcast names the classes only, which a worker without this
    package could not find. ``unpack`` gives the value back inside a task.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def unpack(shipped):
    return pickle.loads(shipped.value)


def slices(batch: pa.RecordBatch, name: str, size: int = BATCH_BYTES):
    """Cut a batch into runs of rows whose texts have about ``size`` bytes together; a row stays whole."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: a permutation of the 64-bit integers, another one for each seed."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def string_hashes(values: pa.Array) -> np.ndarray:
    """64-bit hash of each string's UTF-8 bytes."""
    import xxhash

    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(v) for v in values.to_pylist()), dtype=np.uint64, count=len(values))


#: A random value for each byte, and an odd base with its inverse, for hashes of many words at once.
_BYTE_VALUES = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word, from running sums over the bytes of all of them.

    A word's sum of ``value(byte) * base ** place`` is a difference of two
    running sums, moved to place 0 by the base's inverse.
    """
    if not len(words):
        return np.empty(0, np.uint64)
    words = words if words.offset == 0 else pa.concat_arrays([words])
    ends = np.frombuffer(words.buffers()[1], np.int64)[: len(words) + 1]
    low, high = int(ends[0]), int(ends[-1])
    data = np.frombuffer(words.buffers()[2], np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * _powers(_BASE, len(data)), out=sums[1:])
        at = sums[ends - low]
        hashes = (at[1:] - at[:-1]) * _powers(_INVERSE, len(data) + 1)[ends[:-1] - low]
        return mix64(hashes + np.diff(ends).astype(np.uint64))


def sort_rows(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The order by row, then by 64-bit key.

    One sort of both packed into 64 bits; should two keys of a row differ in
    their cut-off bits only, both are sorted in full.
    """
    bits = max(int(rows.max(initial=0)).bit_length(), 1)
    packed = rows.astype(np.uint64) << np.uint64(64 - bits) | keys >> np.uint64(bits)
    order = np.argsort(packed)
    packed, sorted_keys = packed[order], keys[order]
    if ((packed[1:] == packed[:-1]) & (sorted_keys[1:] != sorted_keys[:-1])).any():
        return np.lexsort((keys, rows))
    return order


def word_codes(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each word's place in the list of the distinct words, and that list."""
    encoded = pc.dictionary_encode(words)
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary
