"""Data checks (C1-C5). Each returns a small DataFrame of violations or
counts; ``require_*`` variants raise, as the reference's constraints abort a
load."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playstats.schemas import UUID_RE


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """C1: keys that occur more than once (a PRIMARY KEY would reject them)."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """C2: NULLs per column, one pass."""
    return df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])


def bad_uuids(df: DataFrame, column: str) -> DataFrame:
    """C3: values that are not canonical lower-case UUIDs (NULL excluded)."""
    c = F.col(column)
    return df.where(c.isNotNull() & ~c.rlike(UUID_RE))


def require_positive(df: DataFrame, column: str) -> None:
    """C4: every value must be > 0 (the Gini input assertion)."""
    low = df.agg(F.min(column)).first()[0]
    if low is not None and low <= 0:
        raise ValueError(f"{column} must be > 0, found {low}")


def require_unique(df: DataFrame, key: str | list[str]) -> None:
    """C1 as a hard check."""
    dup = duplicate_keys(df, key).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key in {key}: {dup[0].asDict()}")


def require_not_null(df: DataFrame, columns: list[str]) -> None:
    """C2 as a hard check."""
    counts = null_counts(df, columns).first().asDict()
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"NULL values in NOT NULL columns: {bad}")
