"""Centroid clustering in integers, with zone maps along a Hilbert curve.

1. Vectors of ``dims`` finite components become integers, floor(scale * x).
   Spread and range of every dimension are counted (one row a dimension).
2. A vector's Hilbert key takes ``BITS`` bits of each dimension, the one of
   the widest spread first. Vectors are dealt to ranges of keys, sorted, and
   stored in blocks of consecutive ones with a zone map: the smallest and the
   largest value of each dimension.
3. In a round, the box of a block bounds its distance to every centroid from
   below and above; only centroids whose lower bound is no more than the
   smallest upper bound can be nearest to any of its vectors. The block's
   vectors are compared with those candidates, all at once and exactly.
   Sums by cluster and dimension are added up per task, then by Spark: the
   driver sees clusters x dims sums.
4. The new centroid is the floor of sum / count, in exact integers; an empty
   cluster keeps its centroid. After the last round vectors are assigned once
   more.

Defined results: a vector that is null, of another length, or with a null or
non-finite component is left out. Repeated ids are vectors of their own; a
null id is hashed as the empty text. First centroids with equal hashes are
ordered by their stored bytes; with fewer than ``k`` vectors every one is a
centroid. Equal distances go to the smaller number. A component of 2 ** 27 or
more after scaling is an error, as squared distances would not fit a long.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from playstats.llm.common import prepare, released
from playstats.llm.hilbert import hilbert_keys
from playstats.llm.places import with_row
from playstats.session import cut_lineage, remove_stage

DIMS, K, ROUNDS, SCALE = 64, 40, 5, 256
#: Bits of a dimension in a key; vectors of a block; components stay below the limit.
BITS, BLOCK_ROWS, LIMIT = 4, 1024, 1 << 27


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(id, vector) of the vectors that count."""
    picked = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return picked.where((F.size("vector") == dims) & finite)


def scaled(column: pa.Array, dims: int, scale: int, limit: int = LIMIT) -> np.ndarray:
    """The integer vectors of a column of lists."""
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    if len(values) and np.abs(values).max() >= limit:
        raise ValueError(f"a component is {limit} or more after scaling: squared distances would not fit a long")
    return values.astype(np.int64).reshape(-1, dims)


def _ranges(kept: DataFrame, dims: int, scale: int) -> list:
    """Smallest value, largest value and variance of every dimension; nothing for an empty table."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, np.zeros(dims), np.zeros(dims)
        low, high = np.full(dims, 2**62), np.full(dims, -(2**62))
        for batch in batches:
            if batch.num_rows:
                v = scaled(batch.column("vector"), dims, scale)
                n, total, squares = n + len(v), total + v.sum(0), squares + (v.astype(np.float64) ** 2).sum(0)
                low, high = np.minimum(low, v.min(0)), np.maximum(high, v.max(0))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dims)), pa.array(np.full(dims, n)), pa.array(low), pa.array(high), pa.array(total), pa.array(squares)],
                names=["dim", "n", "low", "high", "total", "squares"],
            )

    found = kept.mapInArrow(released(measure), "dim bigint, n bigint, low bigint, high bigint, total double, squares double").groupBy("dim")
    found = found.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"), F.sum("squares").alias("squares"))
    return sorted((r["dim"], r["low"], r["high"], r["squares"] / r["n"] - (r["total"] / r["n"]) ** 2) for r in found.collect())


def hilbert_blocks(kept: DataFrame, ranges: list, dims: int, scale: int, bits: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The keyed vectors (id, vector, row), and blocks (ids, vectors, low, high) of them along the curve."""
    low, high = np.array([r[1] for r in ranges]), np.array([r[2] for r in ranges])
    order = np.argsort([-r[3] for r in ranges], kind="stable")

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = scaled(batch.column("vector"), dims, scale)
            cells = ((v - low) << bits) // (high - low + 1)
            keys = hilbert_keys(cells[:, order], bits)
            packed = [pa.array([row.tobytes() for row in rows], pa.binary()) for rows in (keys, v.astype("<i4"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *packed], names=["id", "key", "vector"])

    keyed = with_row(kept.mapInArrow(released(key), "id bigint, key binary, vector binary"), "clustering-keys")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = [], []

        def block(n: int) -> pa.RecordBatch:
            v = np.frombuffer(b"".join(held[:n]), "<i4").reshape(-1, dims)
            row = [[ids[:n]], [v.tobytes()], [v.min(0).tobytes()], [v.max(0).tobytes()]]
            del ids[:n], held[:n]
            kinds = [pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds, strict=True)], names=["ids", "vectors", "low", "high"])

        for batch in batches:
            ids += batch.column("id").to_pylist()
            held += batch.column("vector").to_pylist()
            while len(held) >= block_rows:
                yield block(block_rows)
        if held:
            yield block(len(held))

    # equal vectors are dealt over several ranges by id and row
    along = keyed.repartitionByRange("key", "id", "row").sortWithinPartitions("key", "id", "row").select("id", "vector")
    blocks = along.mapInArrow(released(cut), "ids array<bigint>, vectors binary, low binary, high binary")
    return keyed, cut_lineage(blocks, "clustering-blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """The numbers of the centroids that may be nearest to some vector of a box, ascending.

    A centroid beyond the smallest upper bound is farther from every vector
    of the box than another one is; one at that bound may still tie.
    """
    outside = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    farthest = np.maximum(np.abs(centroids - low), np.abs(high - centroids))
    return np.flatnonzero((outside**2).sum(1) <= (farthest**2).sum(1).min())


def nearest(vectors: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid, the smaller number of equals."""
    some = candidates(low, high, centroids)
    c = centroids[some]
    distances = (vectors * vectors).sum(1)[:, None] - 2 * (vectors @ c.T) + (c * c).sum(1)
    best = distances.argmin(1)
    return some[best], distances[np.arange(len(vectors)), best]


def _block_rows_of(batch: pa.RecordBatch, dims: int):
    """(ids, vectors, low, high) of each block in a batch."""
    for i in range(batch.num_rows):
        v, low, high = (np.frombuffer(batch.column(c)[i].as_py(), "<i4").astype(np.int64) for c in ("vectors", "low", "high"))
        yield batch.column("ids")[i].values, v.reshape(-1, dims), low, high


def _cluster_sums(blocks: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Count and sums of the vectors nearest to each centroid."""
    k, dims = centroids.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for _, v, low, high in _block_rows_of(batch, dims):
                cluster, _ = nearest(v, low, high, centroids)
                for number in np.unique(cluster):
                    own = v[cluster == number]
                    counts[number] += len(own)
                    sums[number] += own.sum(0)
        full = np.repeat(np.flatnonzero(counts), dims)
        if len(full):
            dim = np.tile(np.arange(dims), len(full) // dims)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full), pa.array(dim), pa.array(counts[full]), pa.array(sums[full, dim])], names=["cluster", "dim", "n", "total"]
            )

    added = blocks.mapInArrow(released(add_up), "cluster bigint, dim bigint, n bigint, total bigint").groupBy("cluster", "dim")
    out: dict[int, tuple[int, list[int]]] = {}
    for r in added.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["dim"]] = r["total"]
    return out


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = DIMS,
    k: int = K,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = "2:",
    bits: int = BITS,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """(id, ``cluster``, ``distance``) of every vector that counts, and the centroids by number."""
    spark = prepare(vectors.sparkSession)
    kept = whole_vectors(vectors, id_col, vector_col, dims)
    ranges = _ranges(kept, dims, scale)
    if not ranges:
        return spark.createDataFrame([], f"`{id_col}` bigint, cluster int, distance bigint"), np.empty((0, dims), np.int64)
    keyed, blocks = hilbert_blocks(kept, ranges, dims, scale, bits, block_rows)
    drawn = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = keyed.orderBy(drawn, "vector").select("vector").limit(k).collect()
    centroids = np.array([np.frombuffer(r["vector"], "<i4") for r in first], np.int64)
    remove_stage(keyed)
    for _ in range(rounds):
        for cluster, (n, sums) in _cluster_sums(blocks, centroids).items():
            centroids[cluster] = [s // n for s in sums]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, v, low, high in _block_rows_of(batch, dims):
                cluster, distance = nearest(v, low, high, centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    assigned = cut_lineage(blocks.mapInArrow(released(assign), "id bigint, cluster int, distance bigint"), "clustering-assigned")
    remove_stage(blocks)
    return assigned.withColumnRenamed("id", id_col), centroids


def with_cluster_figures(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256``; the table of clusters has a row for each centroid."""
    spark = assigned.sparkSession
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [
        {"cluster": c, "cluster_inertia": s, "inertia": sum(sums.values()), "centroid_sha256": hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()}
        for c, s in sums.items()
    ]
    table = F.from_json(F.lit(json.dumps(rows)), "array<struct<cluster:int,cluster_inertia:bigint,inertia:bigint,centroid_sha256:string>>")
    return assigned.join(F.broadcast(spark.range(1).select(F.inline(table))), "cluster")
