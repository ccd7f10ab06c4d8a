"""Query of the centroid clustering over ``embeddings``, and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstats.llm.clustering import DIMS, K, ROUNDS, SCALE, cluster_vectors, with_cluster_figures
from playstats.llm.common import read_table


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster_vectors(read_table(spark, sf_dir, "embeddings"))
    out = with_cluster_figures(assigned, centroids)
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _assign(i: int) -> str:
    return f"""a{i} AS MATERIALIZED (
  SELECT row, vec_id, q, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (
    SELECT row, vec_id, v.q, c.cluster, list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS distance
    FROM v, c{i} c) GROUP BY row, vec_id, q)"""


def _move(i: int) -> str:
    return f"""s{i + 1} AS MATERIALIZED (
  SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY dim) AS q FROM (
    SELECT cluster, dim, sum(x)::BIGINT AS total, count(*) AS n
    FROM (SELECT cluster, unnest(q) AS x, unnest(range({DIMS})) AS dim FROM a{i}) GROUP BY cluster, dim)
  GROUP BY cluster
), c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(s.q, c.q) AS q FROM c{i} c LEFT JOIN s{i + 1} s USING (cluster))"""


SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), q) - 1)::INT AS cluster, q FROM v
  ORDER BY cluster LIMIT {K}
), {", ".join(_assign(i) + ", " + _move(i) for i in range(ROUNDS))}, {_assign(ROUNDS)}
SELECT vec_id, a.cluster, distance, sum(distance) OVER (PARTITION BY a.cluster)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)
"""
