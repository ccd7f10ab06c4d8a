"""Presentation helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from playstats.schemas import UNKNOWN_LABEL


def fill_unknown(c, label: str = UNKNOWN_LABEL) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(label))


def thousands(c) -> Column:
    """Integer with thousands separators, e.g. 1,234,567."""
    return F.format_number(F.col(c) if isinstance(c, str) else c, 0)


def round_half_even(c, digits: int = 2) -> Column:
    """pandas ``round`` rounds half to even."""
    return F.bround(F.col(c) if isinstance(c, str) else c, digits)
