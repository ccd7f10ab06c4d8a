"""List column helpers with the reference's NULL rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_element(c) -> Column:
    """First list element; NULL for an empty or NULL list.

    ``a[0]`` raises under ANSI mode on an empty list, ``get`` does not.
    """
    return F.get(_col(c), F.lit(0))


def split_list(c, sep: str = ",") -> Column:
    """Comma list -> array. ``''`` -> ``['']``, NULL -> NULL, ``'a,,b'`` -> 3 parts."""
    return F.split(_col(c), sep, -1)


def list_length(c) -> Column:
    """Element count: NULL for NULL, 0 for an empty list."""
    return F.array_size(_col(c))
