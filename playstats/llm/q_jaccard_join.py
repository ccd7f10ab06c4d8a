"""Query of the n-gram Jaccard join over ``documents``, and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstats.llm.common import LOWER, UPPER, read_table
from playstats.llm.jaccard_join import jaccard_components

WORDS, PERCENT = 3, 90


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"), words=WORDS, percent=PERCENT)


#: For small tables: all pairs that share a shingle and have near sizes, then everything reachable.
SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < {WORDS} THEN words ELSE words[i:i + {WORDS - 1}] END AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {WORDS - 2}, 2))) AS i FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), sized AS (
  SELECT doc_id, shingle, n FROM s JOIN n USING (doc_id)
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sized a JOIN sized b ON a.shingle = b.shingle AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
  SELECT a, b FROM both_ways UNION SELECT doc_id, b FROM reach JOIN both_ways ON other = a
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(r.least, doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id) r USING (doc_id)
"""
