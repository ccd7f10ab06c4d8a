"""Epoch-second and calendar helpers (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from playstats.schemas import epoch_seconds


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_ts(c) -> Column:
    return F.timestamp_seconds(_col(c))


def epoch_to_date(c) -> Column:
    return F.to_date(F.timestamp_seconds(_col(c)))


def year_of(c) -> Column:
    """Year of an epoch-second column as bigint (DuckDB's type for EXTRACT)."""
    return F.year(epoch_to_ts(c)).cast("bigint")


def month_of(c) -> Column:
    return F.month(epoch_to_ts(c)).cast("bigint")


def at_or_after(c, day: str) -> Column:
    """``to_timestamp(c) >= 'day'`` in UTC, written on the raw epoch column so
    Parquet can prune row groups."""
    return _col(c) >= F.lit(epoch_seconds(day))


def shift_months(ts, months: int) -> Column:
    """Timestamp + n calendar months; keeps time of day and clips the day to
    the month's end (``add_months`` would return a DATE)."""
    return _col(ts) + F.make_ym_interval(F.lit(0), F.lit(months))


def shift_days(ts, days: int) -> Column:
    return _col(ts) + F.make_dt_interval(F.lit(days))
