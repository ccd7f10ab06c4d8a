"""Line deduplication: a line that several documents hold stays in the first of them only.

Two Bloom filters pick the lines that may repeat; only those are shuffled,
with their keys, to be confirmed exactly and to find the first document.

1. Every task hashes the keys of its documents' lines and fills the filters.
2. With the merged filter, each document emits its suspected keys; grouping
   by the key itself gives the smallest and the largest id that hold it. The
   group is a pair of aggregates, so a line of any number of documents is
   combined before the shuffle and never gathered.
3. Documents with keys to lose are joined with them and rewritten.

A key is the line without white space at both ends, A-Z lower-cased; keys
shorter than ``min_chars`` code points are never dropped.

Defined results: a null text counts as empty, which is one empty line. Rows
with the same id are one document: they share its lines and all keep them.
A null id is one document too, after all others. Documents that lose all
lines stay, with an empty text. Extra columns are passed on untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from playstats.llm import bloom
from playstats.llm.common import SPACE, prepare, released, slices, string_hashes, text_column
from playstats.session import cut_lineage

MIN_CHARS = 10
#: Bytes of text whose lines a worker holds at once.
SLICE_BYTES = 4 << 20


def line_keys(texts: pa.Array, min_chars: int = MIN_CHARS) -> tuple[pa.Array, np.ndarray]:
    """The keys of all lines that are long enough, and the row of each; once for each row."""
    lists = pc.split_pattern(texts, "\n")
    rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    keys = pc.ascii_lower(pc.ascii_trim(pc.list_flatten(lists), SPACE))
    long = pc.greater_equal(pc.utf8_length(keys), min_chars)
    keys, rows = pc.filter(keys, long), rows[long.to_numpy(zero_copy_only=False)]
    both = pa.table({"row": rows, "key": keys}).group_by(["row", "key"]).aggregate([])
    return both.column("key").combine_chunks(), both.column("row").to_numpy()


def _rewritten(text: str, drop: set[str]) -> tuple[str, int]:
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    lines = text.split("\n")
    kept = [x for x in lines if x.strip(SPACE).translate(lower) not in drop]
    return "\n".join(kept), len(lines) - len(kept)


def _lost_keys(docs: DataFrame, min_chars: int, log2_bits: int) -> DataFrame:
    """(id, keys): the keys that a document must lose; one row for each id that loses any."""

    def hashes_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in slices(batch, "text", SLICE_BYTES):
            yield string_hashes(line_keys(text_column(part, "text"), min_chars)[0])

    packed = docs.sparkSession.sparkContext.broadcast(bloom.seen_twice(docs.select("text"), log2_bits, hashes_of))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(packed.value, np.uint8)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                keys, rows = line_keys(text_column(part, "text"), min_chars)
                hit = bloom.in_filter(twice, string_hashes(keys), log2_bits)
                ids = pc.take(part.column("id"), pa.array(rows[hit]))
                yield pa.RecordBatch.from_arrays([ids, pc.filter(keys, pa.array(hit)).cast(pa.string())], names=["id", "key"])

    # stored: read twice below, and a join of stored tables can split a hot line's rows
    held = cut_lineage(docs.mapInArrow(released(suspects), "id bigint, key string"), "line-suspects")
    place = F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"))
    first = held.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("end")).where("first <> end")
    first = cut_lineage(first.select("key", "first"), "line-firsts")
    losing = held.join(first, "key").where(place != F.col("first"))
    return losing.groupBy("id").agg(F.collect_set("key").alias("keys"))


def _apply(docs: DataFrame, id_col: str, text_col: str, min_chars: int, log2_bits: int, row: bool) -> DataFrame:
    prepare(docs.sparkSession)
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    lost = _lost_keys(plain, min_chars, log2_bits)
    extra = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")] if row else []
    whole = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), *extra)
    joined = whole.join(lost.withColumnRenamed("id", "lost_id"), F.col("id").eqNullSafe(F.col("lost_id")), "left").drop("lost_id")

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_column(batch, "text")
            n_lines = pc.add(pc.count_substring(texts, "\n"), 1).cast(pa.int64())
            new, dropped = batch.column("text").to_pylist(), np.zeros(batch.num_rows, np.int64)
            for i, keys in enumerate(batch.column("keys").to_pylist()):
                if keys:
                    new[i], dropped[i] = _rewritten(new[i], set(keys))
            columns = [batch.column("id"), pa.array(new, pa.string()), n_lines, pa.array(dropped)]
            names = ["id", "text", "n_lines", "n_dropped"]
            if row:
                columns, names = [*columns, batch.column("row")], [*names, "row"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "id bigint, text string, n_lines bigint, n_dropped bigint"
    if row:
        schema += f", row {joined.schema['row'].dataType.simpleString()}"
    return joined.mapInArrow(released(rewrite), schema)


def line_dedup_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, log2_bits: int = bloom.LOG2_BITS
) -> DataFrame:
    """One row per document: id, the kept ``text``, ``n_lines`` before and ``n_dropped``."""
    return _apply(docs, id_col, text_col, min_chars, log2_bits, False).withColumnRenamed("id", id_col)


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, log2_bits: int = bloom.LOG2_BITS
) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text; same rows and columns."""
    out = _apply(docs, id_col, text_col, min_chars, log2_bits, True)
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
