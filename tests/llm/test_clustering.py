"""Clustering against plain integer Lloyd rounds; the curve, the boxes, and edges."""

import hashlib
import itertools

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from playstats.llm.clustering import candidates, cluster_vectors, nearest, with_cluster_figures
from playstats.llm.hilbert import hilbert_keys

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, dims, k, rounds, scale=256):
    kept = [(i, [int(np.floor(float(np.float32(x)) * scale)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest())[:k]
    centroids = [list(v) for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        centroids = [[sum(x) // len(x) for x in zip(*m, strict=True)] if (m := [v for (_, v), c in zip(kept, own, strict=True) if c == j]) else centroids[j] for j in range(len(centroids))]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in kept), key=str), centroids


def got(df, **kw):
    out, centroids = cluster_vectors(df, **kw)
    return sorted((tuple(r) for r in out.collect()), key=str), centroids.tolist()


@pytest.mark.parametrize("dims,k,block_rows,bits", [(4, 5, 16, 4), (3, 7, 1, 2), (64, 10, 32, 4), (2, 1, 1000, 8)])
def test_same_as_plain_rounds(spark, dims, k, block_rows, bits):
    rng = np.random.default_rng(dims)
    rows = [(i, [float(x) for x in rng.normal(i % 4, 0.2, dims).astype(np.float32)], 0) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    kw = {"dims": dims, "k": k, "rounds": 3}
    assert got(df, **kw, block_rows=block_rows, bits=bits) == plain([r[:2] for r in rows], **kw)


def test_left_out_vectors_ties_repeats_and_clashing_names(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [nan, 0.0]), (6, [0.0, -inf]), (7, [1.0, 2.0, 3.0])]
    good = [(10, [0.0, 0.0]), (11, [1.0, 0.0]), (12, [0.5, 0.0]), (13, [-0.001, 0.0])] + [(14, [0.5, 0.5])] * 60 + [(None, [9.0, 9.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in odd + good], SCHEMA)
    for c in ("id", "row", "key", "cluster", "distance", "vector"):
        df = df.withColumn(c, F.lit("clash"))
    kw = {"dims": 2, "k": 4, "rounds": 2}
    assert got(df, **kw, block_rows=8) == plain(odd + good, **kw)


def test_fewer_vectors_than_centroids_and_none(spark):
    df = spark.createDataFrame([(1, [0.5, 0.5], 0), (2, [1.0, 1.0], 0)], SCHEMA)
    rows, centroids = got(df, dims=2, k=40)
    assert len(centroids) == 2 and {r[2] for r in rows} == {0}
    out, centroids = cluster_vectors(df, dims=64)
    assert with_cluster_figures(out, centroids).collect() == [] and len(centroids) == 0


def test_figures(spark):
    df = spark.createDataFrame([(i, [i / 10, 0.0], 0) for i in range(30)], SCHEMA)
    out, centroids = cluster_vectors(df, dims=2, k=3)
    rows = with_cluster_figures(out, centroids).collect()
    assert {r["inertia"] for r in rows} == {sum(r["distance"] for r in rows)}
    for r in rows:
        assert r["cluster_inertia"] == sum(x["distance"] for x in rows if x["cluster"] == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        cluster_vectors(spark.createDataFrame([(1, [1e6, 0.0], 0)], SCHEMA), dims=2)


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2), (5, 2)])
def test_steps_along_the_curve_are_of_length_one(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
    along = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert len(set(keys)) == len(keys) and (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000))
def test_boxes_lose_no_nearest_centroid(seed):
    rng = np.random.default_rng(seed)
    v, c = rng.integers(-6, 7, (20, 3)) // int(rng.integers(1, 5)), rng.integers(-8, 9, (12, 3))
    low, high = v.min(0), v.max(0)
    number, distance = nearest(v, low, high, c)
    every = ((v[:, None] - c) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_boxes_leave_out_far_centroids():
    v = np.array([[0, 0], [3, 3]])
    assert candidates(v.min(0), v.max(0), np.array([[1, 1], [50, 50], [2, 2]])).tolist() == [0, 2]
