"""Query of the Merkle manifest over ``documents``, and its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playstats.llm.common import read_table
from playstats.llm.merkle import fold, leaf_hash, merkle_manifest, proof_text, sha256_hex
from playstats.llm.sql_text import CRC_CTE, crc32_sql

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs; every seventh row (by checksum of its id) is checked with a changed ``n_chars``."""
    # one more than any long fits a decimal
    changed = [(F.col(c).cast("decimal(20,0)") + 1).cast("string") if c == "n_chars" else F.col(c) for c in FIELDS]
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0) & F.col("n_chars").isNotNull()
    tampered = F.when(chosen, leaf_hash(*changed))
    rows = merkle_manifest(read_table(spark, sf_dir, "documents"), FIELDS, carry={"tampered": tampered})
    folded = rows.select("*", fold(F.coalesce("tampered", "leaf"), F.col("proof")).alias("folded_root"))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", sha256_hex(proof_text(F.col("proof"))).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: Level by level: a node joins the two below it; a tree is done when one node remains.
_CLIMB = """
  SELECT tree, 0 AS level, place, h, n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), any_value((n + 1) // 2)
  FROM {nodes} WHERE n > 1 GROUP BY tree, level, place // 2
"""

SQL = f"""
WITH RECURSIVE {CRC_CTE}, leaves AS (
  SELECT coalesce('=' || lang, '') AS tree, doc_id, {_leaf("n_chars")} AS h,
    CASE WHEN n_chars IS NOT NULL AND {crc32_sql("coalesce(doc_id::VARCHAR, '')")} % 7 = 0 AND doc_id IS NOT NULL
      THEN {_leaf("n_chars::HUGEINT + 1")} END AS tampered
  FROM documents, crc
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), nodes(tree, level, place, h, n) AS ({_CLIMB.format(leaves="placed", nodes="nodes")}),
subroots AS (SELECT tree, max(level) AS level, max_by(h, level) AS h FROM nodes GROUP BY tree),
tops AS (SELECT 'top' AS tree, tree AS name, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n FROM subroots),
top_nodes(tree, level, place, h, n) AS ({_CLIMB.format(leaves="tops", nodes="top_nodes")}),
top AS (SELECT max(level) AS level, max_by(h, level) AS h FROM top_nodes),
steps AS (
  SELECT p.tree, p.place, s.level, xor(p.place >> s.level, 1) > (p.place >> s.level) AS is_left, coalesce(o.h, '') AS other
  FROM placed p JOIN (SELECT tree, unnest(range(level)) AS level FROM subroots) s ON s.tree = p.tree
    LEFT JOIN nodes o ON o.tree = p.tree AND o.level = s.level AND o.place = xor(p.place >> s.level, 1)
  UNION ALL
  SELECT p.tree, p.place, r.level + l.l, xor(t.place >> l.l, 1) > (t.place >> l.l), coalesce(o.h, '')
  FROM placed p JOIN tops t ON t.name = p.tree JOIN subroots r ON r.tree = p.tree JOIN (SELECT unnest(range(level)) AS l FROM top) l ON true
    LEFT JOIN top_nodes o ON o.level = l.l AND o.place = xor(t.place >> l.l, 1)
), proofs AS (SELECT tree, place, string_agg(other, '' ORDER BY level) AS proof FROM steps GROUP BY tree, place),
folds(tree, place, level, h) AS (
  SELECT tree, place, 0, coalesce(tampered, h) FROM placed
  UNION ALL
  SELECT f.tree, f.place, f.level + 1, sha256(CASE WHEN is_left THEN f.h || other ELSE other || f.h END)
  FROM folds f JOIN steps s ON s.tree = f.tree AND s.place = f.place AND s.level = f.level
), folded AS (SELECT tree, place, max_by(h, level) AS h FROM folds GROUP BY tree, place)
SELECT doc_id, p.h AS leaf, r.h AS subroot, top.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, f.h AS folded_root, f.h = top.h AS verified
FROM placed p JOIN subroots r ON r.tree = p.tree JOIN folded f ON f.tree = p.tree AND f.place = p.place CROSS JOIN top
  LEFT JOIN proofs x ON x.tree = p.tree AND x.place = p.place
"""
