"""Query of the bounded-load ring over ``documents``, and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playstats.llm.common import read_table
from playstats.llm.sharding import DIGITS, SHARDS, VNODES, shard_by_ring
from playstats.llm.sql_text import CRC_CTE, crc32_sql


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: with bounded loads a row's shard depends on the others' rows too, and counts are at most one apart."""
    placed = shard_by_ring(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard")


_POSITION = f"('0x' || substr(md5(%s), 1, {DIGITS}))::BIGINT"
_ROOMS = ", ".join(f"rooms[{s + 1}] - sum(CASE WHEN shard = {s} THEN n ELSE 0 END) OVER ()" for s in range(SHARDS))

SQL = f"""
WITH RECURSIVE {CRC_CTE}, points AS (
  SELECT row_number() OVER (ORDER BY position, shard) - 1 AS arc, position, shard FROM (
    SELECT s AS shard, {_POSITION % "'shard ' || s || '/' || v"} AS position
    FROM range({SHARDS}) a(s), range({VNODES}) b(v))
), ring AS (SELECT list(shard ORDER BY arc) AS owners, count(*) AS n_arcs FROM points),
keys AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {crc32_sql("coalesce(text, '')")} AS text_crc32,
    {_POSITION % "coalesce(doc_id::VARCHAR, '')"} AS position
  FROM documents, crc
), arcs AS (
  SELECT keys.*, coalesce(p.arc, 0) AS arc FROM keys ASOF LEFT JOIN points p ON keys.position <= p.position
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY arc ORDER BY position, doc_id, size, text_crc32) - 1 AS place FROM arcs
), waves(wave, arc, shard, remaining, n, rooms) AS (
  SELECT -1, arc, -1, count(*)::HUGEINT, 0::HUGEINT,
    (SELECT list((total // {SHARDS} + (s < total % {SHARDS})::INT)::HUGEINT ORDER BY s) FROM range({SHARDS}) r(s), (SELECT count(*) AS total FROM keys))
  FROM arcs GROUP BY arc
  UNION ALL
  SELECT wave, arc, shard, remaining - n, n, [{_ROOMS}]
  FROM (
    SELECT *, greatest(0, least(remaining, rooms[shard + 1]
      - coalesce(sum(remaining) OVER (PARTITION BY shard ORDER BY arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS n
    FROM (
      SELECT wave + 1 AS wave, arc, owners[(arc + wave + 1) % n_arcs + 1] AS shard, remaining, rooms
      FROM waves, ring WHERE remaining > 0))
), runs AS (
  SELECT arc, shard, n,
    coalesce(sum(n) OVER (PARTITION BY arc ORDER BY wave ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first,
    coalesce(sum(n) OVER (PARTITION BY shard ORDER BY wave, arc ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS slot
  FROM waves WHERE n > 0
)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, runs.shard::INT AS shard,
  (slot + place - first)::BIGINT AS slot, NULL::INT AS grown_shard, home.shard::INT AS home_shard
FROM placed JOIN runs ON placed.arc = runs.arc AND place >= first AND place < first + n
  JOIN points home ON home.arc = placed.arc
"""
