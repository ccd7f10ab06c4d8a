"""Query of the quality rules over ``documents``, and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstats.llm.common import read_table
from playstats.llm.quality_rules import BASE_RULES, RULES, STOP_WORDS, quality_metrics

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_metrics(read_table(spark, sf_dir, "documents")).select(*COLUMNS)


def _sql_bounds(rules) -> str:
    out = [f"(n_words < {r.min_words} OR {r.metric} >= {r.low})" for r in rules if r.low is not None]
    out += [f"(n_words < {r.min_words} OR {r.metric} <= {r.high})" for r in rules if r.high is not None]
    return " AND ".join(out) or "true"


SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), p AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), win AS (
  SELECT r, i, words[i:i+4] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM p WHERE len(words) >= 5)
), starts AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n FROM (
    SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM starts) GROUP BY r
), c AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda w: w LIKE '%!')) AS n_shout,
    len(list_filter(words, lambda w: list_contains([{', '.join("'" + w + "'" for w in STOP_WORDS)}], lower(w)))) AS n_stop,
    len(lines) AS n_lines
  FROM p LEFT JOIN rep USING (r)
), m AS (
  SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_chars, coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_ratio,
    coalesce(n_shout / nullif(n_words, 0), 0) AS shout_ratio, coalesce(n_stop / nullif(n_words, 0), 0) AS stop_ratio,
    coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio, coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_ratio
  FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  NOT ({_sql_bounds(BASE_RULES)}) AS base_failed, ({_sql_bounds(BASE_RULES)}) AND ({_sql_bounds(RULES)}) AS kept
FROM m
"""
