"""Popularity, gender, type, genre and time statistics (AGG6-29).

Inputs are plain DataFrames: ``plays`` (user_id, timestamp, artist_ids,
release_id, rec_id), ``artists`` (artist_id, gender, type) and
``recordings`` (rec_id, artist_credit). Results carry the reference's column
names. Ordering is applied by the caller where a report wants it; every
order ends in a unique key so ties neither change results nor pile into one
range partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from playstats.functions import credit_genres, epoch_to_date, list_length, month_of, year_of
from playstats.operators.inequality import order_statistics
from playstats.operators.rollups import (
    explode_artists,
    first_artist,
    key_user_pairs,
    solo_rows,
)


# ---------------------------------------------------------------------------
# Distribution of plays over an artist attribute (gender, type)
# ---------------------------------------------------------------------------
def attribute_distribution(artist_user: DataFrame, artists: DataFrame, attr: str) -> DataFrame:
    """n_plays, n_users, unique_count per artist attribute.

    ``artist_user`` holds one row per play with ``artist_id`` and
    ``user_id``. Plays are first collapsed to (artist, user) pairs, joined to
    the dimension (broadcast when its size allows), then grouped; artists
    missing from the dimension fall in the NULL group.
    """
    return _distribution_of_pairs(key_user_pairs(artist_user, "artist_id"), artists, attr)


def _distribution_of_pairs(pairs: DataFrame, artists: DataFrame, attr: str) -> DataFrame:
    """An artist has one value of the attribute, so artists are counted after
    grouping by artist, users after a distinct of (attribute, user): no row is
    copied for a second distinct count."""
    dim = artists.select("artist_id", attr)
    per_artist = pairs.groupBy("artist_id").agg(F.sum("n").alias("n")).join(dim, "artist_id", "left")
    plays = per_artist.groupBy(attr).agg(
        F.sum("n").cast("bigint").alias("n_plays"), F.count("artist_id").alias("unique_count")
    )
    users = pairs.join(dim, "artist_id", "left").select(F.col(attr).alias("__attr"), "user_id").distinct()
    users = users.groupBy("__attr").agg(F.count("user_id").alias("n_users"))
    both = plays.join(users, F.col(attr).eqNullSafe(F.col("__attr")))
    return both.select(attr, "n_plays", "n_users", "unique_count")


def gender_distribution(plays: DataFrame, artists: DataFrame) -> DataFrame:
    """AGG6: every credited artist of a play counts."""
    return attribute_distribution(explode_artists(plays, "user_id"), artists, "gender")


def active_users(plays: DataFrame, min_plays: int = 5) -> DataFrame:
    """Users with at least ``min_plays`` play rows (rows, not artists)."""
    return (
        plays.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") >= min_plays)
        .select("user_id")
    )


def gender_distribution_active(plays: DataFrame, artists: DataFrame, min_plays: int = 5) -> DataFrame:
    """AGG7: AGG6 restricted to users with ``min_plays`` or more rows."""
    pairs = key_user_pairs(explode_artists(plays, "user_id"), "artist_id")
    # the active set is data-sized: no broadcast hint, adaptive execution
    # chooses from the measured size; the semi join runs on pairs, not plays
    kept = pairs.join(active_users(plays, min_plays), "user_id", "left_semi")
    return _distribution_of_pairs(kept, artists, "gender")


def type_distribution(plays: DataFrame, artists: DataFrame) -> DataFrame:
    """AGG9."""
    return attribute_distribution(explode_artists(plays, "user_id"), artists, "type")


def gender_distribution_first(plays: DataFrame, artists: DataFrame) -> DataFrame:
    """AGG15: only the first credited artist counts; empty lists give a NULL
    artist, which is kept (and counted in n_plays)."""
    return attribute_distribution(first_artist(plays, "user_id"), artists, "gender")


def clean_gender_distribution(clean_plays: DataFrame, artists: DataFrame) -> DataFrame:
    """AGG25: on exclusion-filtered plays with a scalar ``artist_id``."""
    return attribute_distribution(clean_plays.select("artist_id", "user_id"), artists, "gender")


# ---------------------------------------------------------------------------
# Per-entity popularity
# ---------------------------------------------------------------------------
def release_popularity(plays: DataFrame) -> DataFrame:
    """AGG8."""
    return plays.groupBy("release_id").agg(
        F.count("user_id").alias("n_plays"), F.countDistinct("user_id").alias("n_users")
    )


def artist_popularity(plays: DataFrame) -> DataFrame:
    """AGG11 (the reference's join to the dimension has no effect: left out)."""
    return explode_artists(plays, "user_id").groupBy("artist_id").agg(
        F.count("user_id").alias("n_plays"), F.countDistinct("user_id").alias("n_users")
    )


def plays_per_user(plays: DataFrame) -> DataFrame:
    """AGG12: NULL recordings are not counted."""
    return plays.groupBy("user_id").agg(
        F.count("rec_id").alias("play_count"),
        F.countDistinct("rec_id").alias("unique_play_count"),
    )


def track_popularity(plays: DataFrame) -> DataFrame:
    """AGG13."""
    return plays.groupBy("rec_id").agg(F.count("user_id").alias("n_plays"))


def recording_genres(recordings: DataFrame) -> DataFrame:
    """JSN1: one row per genre mention of a recording's artist credit."""
    return recordings.select("rec_id", F.explode(credit_genres("artist_credit")).alias("genre_name"))


def genre_distribution(plays: DataFrame, recordings: DataFrame) -> DataFrame:
    """AGG10: plays joined to genre mentions (a genre named twice in one
    credit counts twice); recordings without a genre form the NULL group."""
    pairs = key_user_pairs(plays.select("rec_id", "user_id"), "rec_id")
    genres = recording_genres(recordings)
    joined = pairs.join(genres, "rec_id", "left")
    return joined.groupBy("genre_name").agg(
        F.sum("n").cast("bigint").alias("n_plays"),
        F.countDistinct("user_id").alias("n_users"),
    )


def distinct_counts(plays: DataFrame) -> DataFrame:
    """AGG14: counted after UNNEST, so rows with an empty/NULL list count for
    nothing."""
    credited = plays.where(list_length("artist_ids") > 0)
    artists = plays.select(F.explode("artist_ids").alias("artist_id"))
    return _distinct_counts(
        n_tracks=credited.select("rec_id"),
        n_artists=artists,
        n_releases=credited.select("release_id"),
        n_users=credited.select("user_id"),
    )


def _distinct_counts(**columns: DataFrame) -> DataFrame:
    """One row with the distinct non-NULL values of each one-column frame;
    each is combined before its own shuffle, and no row is copied."""
    counted = None
    for name, column in columns.items():
        one = column.distinct().agg(F.count(column.columns[0]).alias(name))
        counted = one if counted is None else counted.crossJoin(one)  # rows: one and one
    return counted


def clean_distinct_counts(clean_plays: DataFrame) -> DataFrame:
    """AGG26: the same on clean plays with a scalar artist."""
    return _distinct_counts(
        n_tracks=clean_plays.select("rec_id"),
        n_artists=clean_plays.select("artist_id"),
        n_releases=clean_plays.select("release_id"),
        n_users=clean_plays.select("user_id"),
    )


# ---------------------------------------------------------------------------
# Distinct users per artist, and their mean per gender
# ---------------------------------------------------------------------------
def artist_users(plays: DataFrame, artists: DataFrame, solo_only: bool = False) -> DataFrame:
    """AGG17/AGG19: artist_id, gender, unique_users.

    Grouped by artist first, then joined to the dimension: gender is a
    function of the artist key, so this equals grouping by both.
    """
    rows = solo_rows(plays) if solo_only else plays
    per_artist = explode_artists(rows, "user_id").groupBy("artist_id").agg(
        F.countDistinct("user_id").alias("unique_users")
    )
    dim = artists.select("artist_id", "gender")
    return per_artist.join(dim, "artist_id", "left").select("artist_id", "gender", "unique_users")


def gender_mean_users(plays: DataFrame, artists: DataFrame, solo_only: bool = False) -> DataFrame:
    """AGG16/AGG18: mean of distinct users per artist, by gender."""
    return artist_users(plays, artists, solo_only).groupBy("gender").agg(
        F.avg("unique_users").alias("avg_unique_users")
    )


# ---------------------------------------------------------------------------
# Time, duplicates, dimension checks
# ---------------------------------------------------------------------------
def monthly_plays(plays: DataFrame) -> DataFrame:
    """AGG20: ``start_date`` is the first day seen in the month."""
    return (
        plays.select(
            year_of("timestamp").alias("year"),
            month_of("timestamp").alias("month"),
            epoch_to_date("timestamp").alias("day"),
        )
        .groupBy("year", "month")
        .agg(F.min("day").alias("start_date"), F.count(F.lit(1)).alias("row_count"))
    )


def duplicate_rows(plays: DataFrame) -> DataFrame:
    """AGG21: (user, recording, time) combinations that occur more than once."""
    return (
        plays.groupBy("user_id", "rec_id", "timestamp")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def type_histogram(artists: DataFrame) -> DataFrame:
    """AGG23."""
    return artists.groupBy("type").agg(F.count(F.lit(1)).alias("count"))


def key_check(artists: DataFrame, key: str = "artist_id") -> DataFrame:
    """AGG24 / C1: distinct keys against rows."""
    return artists.agg(
        F.countDistinct(key).alias("distinct_count"), F.count(F.lit(1)).alias("total_count")
    )


def density(per_user: DataFrame) -> DataFrame:
    """AGG27: distinct (user, track) pairs per play."""
    return per_user.agg(
        (F.sum("unique_play_count").cast("double") / F.sum("play_count").cast("double")).alias("density")
    )


def _metric_rows(df: DataFrame, pairs: list[tuple[str, Column]]) -> DataFrame:
    """One (metric, value) row per pair, from a single-row frame."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in pairs])
        ).alias("m")
    ).select("m.metric", "m.value")


def overview(counts: DataFrame, dens: DataFrame, months: DataFrame) -> DataFrame:
    """AGG28: (metric, value) table of the headline numbers.

    "End Date" is the first day seen in the last month, as in the reference.
    Each input is a single-row aggregate; their rows are stacked, not joined.
    """
    fmt = lambda c: F.format_number(F.col(c), 0)
    span = months.agg(F.min("start_date").alias("start_date"), F.max("start_date").alias("end_date"))
    return (
        _metric_rows(
            counts,
            [
                ("Tracks (rec_id)", fmt("n_tracks")),
                ("Artists", fmt("n_artists")),
                ("Releases", fmt("n_releases")),
                ("Users", fmt("n_users")),
            ],
        )
        .unionByName(_metric_rows(dens, [("Density", F.format_number(F.col("density"), 6))]))
        .unionByName(
            _metric_rows(
                span,
                [
                    ("Start Date", F.date_format("start_date", "yyyy-MM-dd")),
                    ("End Date", F.date_format("end_date", "yyyy-MM-dd")),
                ],
            )
        )
    )


PROFILE_STATS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def numeric_profile(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """AGG29: pandas ``describe().round(2)`` for each column, one row each.

    Exact percentiles with linear interpolation (as pandas), found by counts
    over ranges of values (``inequality.order_statistics``). Rounded half to
    even like pandas. A column without values has count 0 and NULLs.
    """
    found = order_statistics(df, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).withColumnRenamed("n", "count")
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("variable"))
    rounded = [F.bround(F.coalesce(F.col(k), F.lit(0.0)) if k == "count" else F.col(k), digits).alias(k) for k in PROFILE_STATS]
    return names.join(found, "variable", "left").select("variable", *rounded)
