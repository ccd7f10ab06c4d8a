"""Pieces of DuckDB SQL that several queries' oracles share."""

from __future__ import annotations

#: CTE ``crc`` with one row: CRC-32 of each of the 256 bytes, by the reflected polynomial.
CRC_CTE = """crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS crc_table
  FROM range(256) t(b)
)"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text that is not null; ``crc`` must be among the tables."""
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, x: xor(c >> 8, crc_table[xor(c & 255, x) + 1]), 4294967295::BIGINT), 4294967295)"
