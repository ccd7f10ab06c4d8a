"""Exclusion waterfall (PIPE1), its audit counts (AGG1) and row filters.

The reference deletes rows in sequence and counts each delete. Here each
row gets the *first* reason that applies, from one broadcast lookup of its
first artist, so one pass yields both the kept rows and every count.

Three-valued logic is kept: a row whose list is NULL or empty has no first
artist; ``NULL NOT IN (...)`` is NULL in SQL, so the reference's deletes
leave such rows in place. The rule below keeps them too. Only when the
dimension has no person does ``NOT IN`` hold for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from playstats.functions import first_element, list_length
from playstats.schemas import (
    DEFAULT_LATE_CUT,
    KEEP,
    NOT_APPLICABLE_GENDER,
    PERSON_TYPE,
    REASONS,
    epoch_seconds,
)
from playstats.session import cut_lineage

PLAY_COLUMNS = ["segment", "user_id", "timestamp", "artist_ids", "release_id", "rec_id"]
CLEAN_COLUMNS = ["user_id", "timestamp", "artist_id", "release_id", "rec_id"]


def reason_expr(late_cut: str = DEFAULT_LATE_CUT, no_person: Column | None = None) -> Column:
    """First matching exclusion reason; needs ``artist_ids``, ``timestamp``,
    ``artist_id`` (first element) and the dimension's ``gender``/``type``.

    ``no_person`` says that the dimension has no person at all: nothing is
    then in the set of persons, a row without artist included.
    """
    aid = F.col("artist_id")
    no_person = F.lit(False) if no_person is None else no_person
    return (
        F.when(list_length("artist_ids") > 1, "group")
        .when(F.col("timestamp") >= F.lit(epoch_seconds(late_cut)), "late")
        .when(no_person | (aid.isNotNull() & ~F.col("type").eqNullSafe(PERSON_TYPE)), "nonperson")
        .when(aid.isNotNull() & F.col("gender").isNull(), "nullgender")
        .when(F.col("gender") == NOT_APPLICABLE_GENDER, "na")
        .otherwise(KEEP)
    )


def with_reason(plays: DataFrame, artists: DataFrame, late_cut: str = DEFAULT_LATE_CUT) -> DataFrame:
    """Adds ``artist_id`` (first artist) and ``reason``."""
    dim = artists.select("artist_id", "gender", "type")
    no_person = artists.where(F.col("type") == PERSON_TYPE).agg((F.count(F.lit(1)) == 0).alias("none")).scalar()
    first = plays.withColumn("artist_id", first_element("artist_ids"))
    return (
        first.join(dim, "artist_id", "left")
        .withColumn("reason", reason_expr(late_cut, no_person))
        .drop("gender", "type")
    )


def clean_plays(
    plays: DataFrame,
    artists: DataFrame,
    late_cut: str = DEFAULT_LATE_CUT,
    keep_segment: bool = False,
) -> DataFrame:
    """PIPE1: distinct rows that pass every exclusion, artist as a scalar.

    Filtering is row-wise, so it commutes with DISTINCT; rows are filtered
    before the dedup shuffle, which then moves only kept rows (a quarter of
    the input in the reference's run). Dedup scope includes ``segment``.
    """
    kept = with_reason(plays, artists, late_cut).where(F.col("reason") == KEEP)
    key = PLAY_COLUMNS if "segment" in plays.columns else PLAY_COLUMNS[1:]
    out = kept.dropDuplicates(key)
    cols = (["segment"] if keep_segment and "segment" in plays.columns else []) + CLEAN_COLUMNS
    return out.select(*cols)


AUDIT_STEPS = ("initial", "duplicates") + REASONS + ("final",)


def clean_with_audit(
    plays: DataFrame,
    artists: DataFrame,
    late_cut: str = DEFAULT_LATE_CUT,
    sizes: dict[str, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """PIPE1, MUT1 and AGG1 in one pass: the clean plays (with ``segment`` if
    plays have one), stored, and the audit (step, n_rows).

    Distinct rows with their copy count get a reason each; the counts of all
    steps are observed while the kept rows are written, so plays are scanned
    and shuffled once. The counts are taken after the last shuffle, where a
    task's figures enter once, also if it or an executor was lost and the task
    ran again. ``duplicates`` is initial - distinct (the reference's log
    subtracts a running total; this is the corrected figure). ``sizes`` names
    tables whose row counts the audit lists too.
    """
    key = PLAY_COLUMNS if "segment" in plays.columns else PLAY_COLUMNS[1:]
    distinct_rows = plays.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    seen = Observation()
    reasons = with_reason(distinct_rows, artists, late_cut).observe(
        seen,
        F.sum("copies").alias("initial"),
        (F.sum("copies") - F.count(F.lit(1))).alias("duplicates"),
        *[F.count(F.when(F.col("reason") == r, 1)).alias(r) for r in REASONS],
        F.count(F.when(F.col("reason") == KEEP, 1)).alias("final"),
    )
    segment = ["segment"] if "segment" in plays.columns else []
    kept = cut_lineage(reasons.where(F.col("reason") == KEEP).select(*segment, *CLEAN_COLUMNS), "clean-plays")
    counts = [(step, seen.get[step] or 0) for step in AUDIT_STEPS]
    counts += [(name, df.count()) for name, df in (sizes or {}).items()]
    return kept, plays.sparkSession.createDataFrame(counts, "step string, n_rows bigint")


def exclusion_audit(plays: DataFrame, artists: DataFrame, late_cut: str = DEFAULT_LATE_CUT) -> DataFrame:
    """AGG1: (step, n_rows) for the waterfall, the artists of the dimension and those of the plays."""
    coded = plays.select(F.explode("artist_ids").alias("artist_id")).where(F.col("artist_id").isNotNull()).distinct()
    return clean_with_audit(plays, artists, late_cut, {"artists": artists, "coded_artists": coded})[1]


def distinct_plays(plays: DataFrame) -> DataFrame:
    """SET4: full-row DISTINCT; list order matters, NULL rows are equal."""
    return plays.dropDuplicates()


def solo_plays(plays: DataFrame) -> DataFrame:
    """FLT2 / SNK7: single-artist rows."""
    return plays.where(list_length("artist_ids") == 1)


def plays_after(plays: DataFrame, day: str) -> DataFrame:
    """FLT4: plays at or after the start of ``day`` (UTC)."""
    return plays.where(F.col("timestamp") >= F.lit(epoch_seconds(day)))


def artists_without_gender(artists: DataFrame, value: str = NOT_APPLICABLE_GENDER) -> DataFrame:
    """FLT6: gender NULL or the not-applicable value (case-sensitive)."""
    return artists.where(F.col("gender").isNull() | (F.col("gender") == value))
