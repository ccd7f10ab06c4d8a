"""Exact deduplication over an extendible-hash index on shared files.

1. Entries. Every row becomes an index entry: a 64-bit key of the normalised
   text (A-Z lower-cased), its SHA-256 and the id. Entries are written under
   the shared folder; texts stay where they are.
2. Directory. Entries are counted by the first bits of the key. A bucket with
   more than ``capacity`` entries doubles the directory there, bit by bit,
   until it fits or holds a single key, which bits cannot split. A directory
   entry is the first key of a bucket, so buckets are ranges of keys. The
   capacity grows with the entries, so that a directory of ``BUCKETS`` buckets
   at most is enough at any size.
3. Owners. Keys that may occur twice (two Bloom filters over the entries)
   bring their texts: every task first merges its own equal texts by
   comparing bytes, so a text with any number of copies leaves a task once a
   flush, with its rows counted and their largest id; the owner task of a
   bucket then reads its keys in order, chains the texts of a key, comparing
   bytes with each text of the chain, and adds up what the tasks counted.
4. The index, one row for each text that its owner made, is written under the
   shared folder by bucket; every entry finds its text's largest id and count
   there. A key that the filters prove to be single has no index row: its
   entry is alone and stays.

Defined results: a null text counts as empty, so null and empty texts are
copies of each other. Of several rows with the largest id one stays. A null
id is smaller than any other. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from playstats.llm import bloom
from playstats.llm.common import prepare, released, string_hashes, text_column
from playstats.session import cut_lineage

#: Entries that a bucket holds before it is split (more, if there would be more than ``BUCKETS``), and bits that one count resolves.
CAPACITY, BUCKETS, STEP_BITS = 20_000, 1 << 14, 10
#: Cells that one count brings to the driver, at most.
CELLS = 1 << 16
#: Bits of the filters for each entry, and the largest filter (32 MB) that a task is sent.
BITS_A_KEY, MOST_LOG2_BITS = 10, 28
#: Bytes of texts that a task keeps while it merges its own copies.
FLUSH_BYTES = 32 << 20


def text_keys(texts: pa.Array) -> np.ndarray:
    return string_hashes(texts).view(np.int64)


class Directory:
    """Buckets as ranges of unsigned keys; ``starts`` are their first keys in order."""

    def __init__(self, starts: list[int], depths: list[int]):
        self.starts, self.depths = starts, depths

    @classmethod
    def build(cls, entries: DataFrame, capacity: int = CAPACITY, step: int = STEP_BITS) -> "Directory":
        """Split buckets until each has ``capacity`` entries at most, or one key.

        Each round counts the still overfull ranges up to ``step`` bits
        deeper, fewer if these are many: each holds more than ``capacity``
        entries, so ``CELLS`` rows, or two a range, come to the driver at most.
        """
        spark = entries.sparkSession
        done: dict[int, int] = {}  # first key of a bucket -> its depth
        todo, depth = [0], 0  # first keys of ranges of 2 ** (64 - depth) keys to be split
        while todo:
            bits = max(1, min(step, 63 - depth, (CELLS // len(todo)).bit_length() - 1))
            below = depth + bits
            counted = entries.withColumn("prefix", F.shiftrightunsigned("key", 64 - below))
            if depth:
                open_at = spark.createDataFrame([(k >> (64 - depth),) for k in todo], "open_at bigint")
                counted = counted.join(F.broadcast(open_at), F.shiftrightunsigned("prefix", bits) == F.col("open_at"), "left_semi")
            rows = counted.groupBy("prefix").agg(F.count("*").alias("n"), (F.min("key") == F.max("key")).alias("one")).collect()
            cells = {r["prefix"]: (r["n"], r["one"]) for r in rows}
            again = []
            for start in todo:
                cls._split(start, depth, below, cells, capacity, done, again, below >= 63)
            todo, depth = again, below
        starts = sorted(done)
        return cls(starts, [done[k] for k in starts])

    @staticmethod
    def _split(start, depth, below, cells, capacity, done, again, deepest) -> None:
        """Halve the range at ``start`` until its parts fit or the count resolves no more."""
        stack = [(start, depth)]
        while stack:
            first, d = stack.pop()
            low = first >> (64 - below)
            part = [cells[p] for p in range(low, low + (1 << (below - d))) if p in cells] if d < below else [cells.get(low, (0, True))]
            if sum(n for n, _ in part) <= capacity or (len(part) == 1 and part[0][1]):
                done[first] = d
            elif d == below:
                if deepest:  # keys that differ in the last bits only
                    done[first] = d
                else:
                    again.append(first)
            else:
                stack += [(first, d + 1), (first + (1 << (63 - d)), d + 1)]

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return (np.searchsorted(np.array(self.starts, np.uint64), keys.view(np.uint64), side="right") - 1).astype(np.int64)


def _entries(docs: DataFrame) -> DataFrame:
    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.ascii_lower(text_column(batch, "text"))
            sha = [hashlib.sha256(t.encode()).hexdigest() for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(text_keys(texts)), pa.array(sha)], names=["id", "key", "sha256"])

    entered = docs.mapInArrow(released(enter), "id bigint, key bigint, sha256 string")
    return cut_lineage(entered.withColumn("row", F.monotonically_increasing_id()), "dedup-entries")


class _Chain:
    """The different texts of one key in order of arrival, each with its rows: [number, largest id, rows with that id]."""

    def __init__(self):
        self.texts: list[bytes] = []
        self.rows: list[list] = []

    def add(self, text: bytes, n: int, last: int | None, ties: int) -> bool:
        """Count ``n`` rows of ``text``; whether it is new to the chain."""
        for seen, rows in zip(self.texts, self.rows, strict=True):
            if seen == text:
                rows[0] += n
                if rows[1] == last:
                    rows[2] += ties
                elif rows[1] is None or (last is not None and last > rows[1]):
                    rows[1:] = last, ties
                return False
        self.texts.append(text)
        self.rows.append([n, last, ties])
        return True


def _index(docs: DataFrame, entries: DataFrame, directory: Directory, log2_bits: int, flush_bytes: int) -> DataFrame:
    """The owners' index rows: every different text whose key may occur twice, its rows, their largest id and the rows that have it."""
    context = docs.sparkSession.sparkContext
    packed = context.broadcast(bloom.seen_twice(entries.select("key"), log2_bits))
    starts = context.broadcast(np.array(directory.starts, np.uint64).tobytes())

    def merge_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice, first_keys = np.frombuffer(packed.value, np.uint8), np.frombuffer(starts.value, np.uint64)
        chains, held = {}, 0

        def flush() -> pa.RecordBatch:
            keys = np.array([k for k, c in chains.items() for _ in c.texts], np.int64)
            buckets = np.searchsorted(first_keys, keys.view(np.uint64), side="right") - 1
            texts = pa.array([t for c in chains.values() for t in c.texts], pa.binary())
            rows = [r for c in chains.values() for r in c.rows]
            counts = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int64)), pa.array(keys), texts, *counts], names=["bucket", "key", "text", "n", "last", "ties"])

        for batch in batches:
            texts, ids = pc.ascii_lower(text_column(batch, "text")), batch.column("id")
            keys = text_keys(texts)
            for i in map(int, np.flatnonzero(bloom.in_filter(twice, keys, log2_bits))):
                text = texts[i].as_py().encode()
                if chains.setdefault(int(keys[i]), _Chain()).add(text, 1, ids[i].as_py(), 1):
                    held += len(text)
                if held > flush_bytes:
                    yield flush()
                    chains.clear()
                    held = 0
        if chains:
            yield flush()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("bucket", "key", "sha256", "chain", "n", "last", "ties")
        kinds = (pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4)
        out = {name: [] for name in names}

        def close() -> None:
            for number, (text, rows) in enumerate(zip(chain.texts, chain.rows, strict=True)):
                for name, value in zip(names, (bucket, key, hashlib.sha256(text).hexdigest(), number, *rows), strict=True):
                    out[name].append(value)

        bucket, key, chain = None, None, _Chain()
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bucket", "key", "text", "n", "last", "ties"))
            for b, k, text, n, last, ties in zip(*columns, strict=True):
                if k != key:
                    close()
                    bucket, key, chain = b, k, _Chain()
                chain.add(text, n, last, ties)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(names))
            out = {name: [] for name in names}
        close()
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds, strict=True)], names=list(names))

    counts = "n bigint, last bigint, ties bigint"
    merged = docs.mapInArrow(released(merge_own), f"bucket bigint, key bigint, text binary, {counts}")
    # buckets are ranges of keys, and so are the owners' partitions; a key has one owner
    owners = merged.repartition("bucket").sortWithinPartitions("bucket", "key")
    return owners.mapInArrow(released(own), f"bucket bigint, key bigint, sha256 string, chain bigint, {counts}")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int | None = None,
    log2_bits: int | None = None,
    flush_bytes: int = FLUSH_BYTES,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and the text's place in the index.

    ``capacity`` and ``log2_bits`` follow the number of rows if not given.
    """
    prepare(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    entries = _entries(plain)
    n_entries = entries.count()
    capacity = capacity or max(CAPACITY, 4 * n_entries // BUCKETS)
    log2_bits = log2_bits or min(max((BITS_A_KEY * n_entries).bit_length(), 18), MOST_LOG2_BITS)
    directory = Directory.build(entries, capacity)
    index = cut_lineage(_index(plain, entries, directory, log2_bits, flush_bytes), "dedup-index")

    # a key that has no index row is single: its entry is a group of its own
    found = entries.join(index, ["key", "sha256"], "left")
    alone = F.col("n").isNull()
    largest = alone | F.col("id").eqNullSafe(F.col("last"))
    # the index knows where several rows have the largest id; only these are looked at again
    tied = entries.join(index.where("ties > 1"), ["key", "sha256"]).where(F.col("id").eqNullSafe(F.col("last")))
    stays = tied.groupBy("key", "sha256").agg(F.max("row").alias("stays"))
    out = found.withColumn("largest", largest).join(stays, ["key", "sha256"], "left")
    return out.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("last")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        (F.col("largest") & (F.col("stays").isNull() | (F.col("row") == F.col("stays")))).alias("kept"),
        F.col("sha256").alias("text_sha256"),
        "key",
        F.coalesce("chain", F.lit(0)).alias("chain"),
    )
