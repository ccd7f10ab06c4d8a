"""Exact rollups of play rows.

Plays are the large input (tens of billions of rows in the reference's
run). Every statistic that joins plays to a dimension first collapses them to
one row per (key, user) with map-side partial aggregation, so the join and
any later shuffle carry pairs instead of plays, and a hot key (one artist
with a third of all plays) arrives as at most one row per (artist, user).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playstats.functions import first_element, list_length


def explode_artists(plays: DataFrame, *cols: str) -> DataFrame:
    """One row per list element (UNNEST). Empty and NULL lists drop the row;
    a repeated artist yields two rows."""
    return plays.select(F.explode("artist_ids").alias("artist_id"), *cols)


def first_artist(plays: DataFrame, *cols: str) -> DataFrame:
    """First list element as a scalar ``artist_id``; NULL for empty/NULL."""
    return plays.select(first_element("artist_ids").alias("artist_id"), *cols)


def solo_rows(plays: DataFrame) -> DataFrame:
    """Rows with exactly one artist (``array_length = 1``)."""
    return plays.where(list_length("artist_ids") == 1)


def key_user_pairs(rows: DataFrame, key: str) -> DataFrame:
    """(key, user_id, n): ``n`` counts plays with a non-NULL user, as
    ``COUNT(user_id)`` does."""
    return rows.groupBy(key, "user_id").agg(F.count("user_id").alias("n"))


def user_artist_rollup(clean_plays: DataFrame, more_keys: list[str] | None = None) -> DataFrame:
    """AGG2: per (user, artist), and ``more_keys``, play count and first/last play time."""
    return clean_plays.groupBy(*(more_keys or []), "user_id", "artist_id").agg(
        F.count(F.lit(1)).alias("count"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )


def entity_stats(plays: DataFrame, key: str) -> DataFrame:
    """AGG3-5: rows, first and last play time per recording/user/release."""
    return plays.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )
