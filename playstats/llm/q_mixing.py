"""Query of the source mixing over ``documents``, and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstats.llm.common import read_table
from playstats.llm.mixing import BLOCK_TOKENS, MAX_REPEATS, TARGET_ENTROPY, mixing_schedule


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_schedule(read_table(spark, sf_dir, "documents"))


SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents
), t AS (
  SELECT source, sum(n_tokens)::BIGINT AS tokens, ln(sum(n_tokens) / max(sum(n_tokens)) OVER ()) AS x
  FROM d GROUP BY source HAVING sum(n_tokens) > 0
), g AS (
  SELECT sum(tokens)::BIGINT AS whole, max(tokens) AS top, {TARGET_ENTROPY} * ln(count(*)) AS goal,
    greatest(1, ceil(sum(tokens) / {BLOCK_TOKENS}))::BIGINT AS n_blocks, list(x) AS xs FROM t
), ent(low, high, i) AS (
  SELECT 0.0::DOUBLE, 1.0::DOUBLE, 0
  UNION ALL
  SELECT CASE WHEN h >= goal - 1e-12 THEN mid ELSE low END, CASE WHEN h >= goal - 1e-12 THEN high ELSE mid END, i + 1
  FROM (SELECT low, high, i, (low + high) / 2 AS mid, goal,
      ln(list_sum(list_transform(xs, lambda v: exp((low + high) / 2 * v))))
        - (low + high) / 2 * list_sum(list_transform(xs, lambda v: v * exp((low + high) / 2 * v)))
          / list_sum(list_transform(xs, lambda v: exp((low + high) / 2 * v))) AS h
    FROM ent, g WHERE i < 35)
), rep(low, high, i) AS (
  SELECT 0.0::DOUBLE, 1.0::DOUBLE, 0
  UNION ALL
  SELECT CASE WHEN ok THEN low ELSE mid END, CASE WHEN ok THEN mid ELSE high END, i + 1
  FROM (SELECT low, high, i, (low + high) / 2 AS mid,
      whole / top * list_max(list_transform(xs, lambda v: exp(((low + high) / 2 - 1) * v)))
        / list_sum(list_transform(xs, lambda v: exp((low + high) / 2 * v))) <= {MAX_REPEATS} + 1e-12 AS ok
    FROM rep, g WHERE i < 35)
), a AS (
  SELECT round(greatest(
    CASE WHEN (SELECT ln(list_sum(list_transform(xs, lambda v: exp(v)))) - list_sum(list_transform(xs, lambda v: v * exp(v))) / list_sum(list_transform(xs, lambda v: exp(v))) FROM g) >= (SELECT goal - 1e-12 FROM g)
      THEN 1.0 ELSE (SELECT low FROM ent WHERE i = 35) END,
    CASE WHEN (SELECT whole / top * list_max(list_transform(xs, lambda v: exp(-v))) / len(xs) FROM g) <= {MAX_REPEATS} + 1e-12
      THEN 0.0 ELSE (SELECT high FROM rep WHERE i = 35) END), 9) AS e
), w AS (
  SELECT source, tokens, floor(pow(tokens, e) / sum(pow(tokens, e)) OVER () * whole + 1e-6)::BIGINT AS quota FROM t, a, g
), p AS (
  SELECT d.*, ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % n_blocks AS block FROM d, g
), quotas AS (
  SELECT source, quota // tokens AS copies, quota % tokens AS room FROM w
), f(round, s, doc_id, n, bkey, dkey, room, taken) AS (
  SELECT 0, coalesce('=' || p.source, ''), doc_id, n_tokens::HUGEINT, md5(p.source || '/' || copies || '/' || block), md5(doc_id || '/' || copies), room::HUGEINT, false
  FROM p JOIN quotas q ON p.source = q.source WHERE room > 0
  UNION ALL
  SELECT round + 1, s, doc_id, n, bkey, dkey, room - sum(CASE WHEN upto <= room THEN n ELSE 0 END) OVER (PARTITION BY s), upto <= room
  FROM (SELECT *, sum(n) OVER (PARTITION BY s ORDER BY bkey, dkey, doc_id) AS upto FROM f WHERE NOT taken AND n <= room)
), taken AS (
  SELECT doc_id, p.source, n_tokens, p.block, unnest(range(copies)) AS epoch FROM p JOIN quotas q ON p.source = q.source
  UNION ALL
  SELECT p.doc_id, p.source, n_tokens, p.block, copies FROM f JOIN p ON p.doc_id = f.doc_id JOIN quotas q ON p.source = q.source WHERE taken
)
SELECT doc_id, source, n_tokens, block, epoch, md5(source || '/' || epoch || '/' || block) AS block_key FROM taken
"""
