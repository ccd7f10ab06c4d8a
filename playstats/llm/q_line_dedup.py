"""Query of the line deduplication over ``documents``, and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playstats.llm.common import LOWER, UPPER, read_table
from playstats.llm.line_dedup import line_dedup_report


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup_report(read_table(spark, sf_dir, "documents"))
    kept = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)
    return out.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


SQL = rf"""
WITH l AS (
  SELECT doc_id, i, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, unnest(a) AS line, unnest(range(len(a))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents))
), f AS (
  SELECT key, min(doc_id) AS first FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), k AS (
  SELECT l.*, coalesce(f.first <> l.doc_id, false) AS lost FROM l LEFT JOIN f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM k GROUP BY doc_id
"""
