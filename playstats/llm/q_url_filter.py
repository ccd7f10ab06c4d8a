"""Query of the URL filter over ``pages``, and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playstats.llm.common import read_table
from playstats.llm.url_filter import RULES, SOFT_LIMIT, SOFT_TERMS, STRICT_TERMS, WEIGHT_LIMIT, url_filter


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter(read_table(spark, sf_dir, "pages"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def _bounded(term: str) -> str:
    return rf"regexp_matches(low, '(^|[^\p{{L}}\p{{N}}]){term}($|[^\p{{L}}\p{{N}}])')"


_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v}:{h}{p}'"
    for v, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
)
_SOFT = " + ".join(f"{_bounded(t)}::INT" for t in SOFT_TERMS)
_WEIGHT = " + ".join(f"{_bounded(t)}::INT * {w}" for t, w in SOFT_TERMS.items())
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL = f"""
WITH p AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), r AS (SELECT *, CASE {_FITS} END AS fit FROM p)
SELECT page_id, host, path, split_part(fit, ':', 2) AS rule,
  CASE WHEN fit IS NOT NULL THEN split_part(fit, ':', 1)
    WHEN {" OR ".join(map(_bounded, STRICT_TERMS))} THEN 'block'
    WHEN {_SOFT} >= {SOFT_LIMIT} AND {_WEIGHT} >= {WEIGHT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
