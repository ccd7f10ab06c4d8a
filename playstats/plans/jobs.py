"""Batch jobs: the reference's pipeline stages (PIPE1-7) end to end.

Each job reads stored tables, runs the operators and writes zstd Parquet.
Large intermediates that several outputs share are written once to the
shared checkpoint folder (``cut_lineage``) instead of being recomputed.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from playstats.operators import clean, encode, inequality, recsys, rollups, stats
from playstats.schemas import ROWS_PER_FILE
from playstats.session import cut_lineage
from playstats.sources.playfiles import parse_plays, require_no_rejects, scan_play_files, split_rejects
from playstats.sources import (
    load_dump,
    read_segments,
    save_table,
    write_audit,
    write_csv_report,
    write_parquet,
    write_recommendations,
    write_segmented_plays,
)


# -- PIPE4: metadata import ---------------------------------------------------
def import_metadata(spark: SparkSession, dump_paths: dict[str, str], out_dir: str, only: str | None = None,
                    strict: bool = False, database: str | None = None) -> dict[str, dict[str, int]]:
    """Dumps -> ``artist_metadata`` / ``recording_metadata`` tables, all or the
    one named by ``only``; returns the counts of each (``load_dump``). With
    ``database`` they are tables of the session's catalog too."""
    kinds = [only] if only else list(dump_paths)
    counts = {}
    for kind in kinds:
        path = os.path.join(out_dir, f"{kind}_metadata")
        counts[kind] = load_dump(spark, dump_paths[kind], kind, path, strict)
        if database:
            save_table(spark.read.parquet(path), database, f"{kind}_metadata")
    return counts


# -- PIPE2/PIPE3: dictionary and encoded plays ------------------------------------
def import_plays(spark: SparkSession, play_root: str, out_dir: str, use_mapping: bool = True, strict: bool = False,
                 rows_per_file: int = ROWS_PER_FILE) -> None:
    """Raw play files -> id dictionary (``id_dictionary``) and plays by segment.

    Rows that do not load go to ``rejected_plays`` with file and reason, as in
    a stream; ``strict`` makes them an error before anything is published.
    """
    parsed = cut_lineage(parse_plays(scan_play_files(spark, play_root)), "staging")
    if strict:
        require_no_rejects(parsed)
    staging, rejected = split_rejects(parsed)
    plays = staging
    if use_mapping:
        ids = cut_lineage(encode.build_id_dictionary(staging), "id-dictionary")
        encode.check_code_capacity(ids)  # before anything is published
        write_parquet(ids, os.path.join(out_dir, "id_dictionary"))
        plays = encode.encode_plays(staging, ids)
    write_parquet(rejected, os.path.join(out_dir, "rejected_plays"))
    write_segmented_plays(plays, os.path.join(out_dir, "plays"), rows_per_file)


def mapped_artists(spark: SparkSession, out_dir: str) -> DataFrame:
    """JN5: the artists of the dictionary with gender and type, from what
    ``import_plays`` and ``import_metadata`` have written."""
    read = lambda name: spark.read.parquet(os.path.join(out_dir, name))
    return encode.coded_artists(read("id_dictionary"), read("artist_metadata"))


# -- PIPE1 + AGG1 and AGG2 -----------------------------------------------------
def prep_plays(spark: SparkSession, plays: DataFrame, artists: DataFrame, out_dir: str,
               late_cut: str, metadata: DataFrame | None = None) -> DataFrame:
    """Exclusion waterfall -> clean plays by segment and the audit log.

    ``artists`` is the dimension by the plays' artist keys; ``metadata``, if
    given, the one that it was mapped from. The log has the sizes of both.
    """
    sizes = {"artists": artists if metadata is None else metadata, "coded_artists": artists}
    kept, audit = clean.clean_with_audit(plays, artists, late_cut, sizes)
    write_audit(audit, os.path.join(out_dir, "exclusion_log.txt"))
    write_segmented_plays(kept, os.path.join(out_dir, "clean_plays"))
    return read_segments(spark, os.path.join(out_dir, "clean_plays")).drop("chunk")


def solo_artist_counts(clean_plays: DataFrame, out_dir: str) -> None:
    """AGG2 -> ``user_artist_counts``."""
    write_parquet(rollups.user_artist_rollup(clean_plays), os.path.join(out_dir, "user_artist_counts"))


# -- PIPE5: statistics suite from shared rollups --------------------------------------
def statistics_suite(plays: DataFrame, artists: DataFrame, recordings: DataFrame,
                     min_plays: int = 5) -> dict[str, DataFrame]:
    """All plays statistics, derived from three exact pair rollups.

    The reference rescans every play row for each of its fifteen outputs.
    Here plays are read for three rollups: (artist, user) over the
    exploded credits, (recording, user) and (release, user), each written
    once. A pair row keeps ``n`` (plays with a user, as ``COUNT(user_id)``),
    ``rows`` (all plays) and, for artists, ``n_solo`` for the single-artist
    variants. Distinct users of a key are the pair rows with a user; sums of
    ``n`` are play counts. Distinct counts and the first-artist distribution
    follow row-level list rules and read the plays directly.
    """
    ex = plays.select(
        "user_id",
        F.explode("artist_ids").alias("artist_id"),
        (F.array_size("artist_ids") == 1).alias("solo"),
    )
    ua = cut_lineage(
        ex.groupBy("artist_id", "user_id").agg(
            F.count("user_id").alias("n"),
            F.count(F.when(F.col("solo"), 1)).alias("n_solo"),
        ),
        "user_artist",
    )
    ur = cut_lineage(
        plays.groupBy("rec_id", "user_id").agg(F.count("user_id").alias("n"), F.count(F.lit(1)).alias("rows")),
        "user_rec",
    )
    urel = cut_lineage(
        plays.groupBy("release_id", "user_id").agg(F.count("user_id").alias("n")), "user_release"
    )
    dim = artists.select("artist_id", "gender", "type")
    uag = ua.join(dim, "artist_id", "left")

    def dist(pairs: DataFrame, attr: str) -> DataFrame:
        return pairs.groupBy(attr).agg(
            F.sum("n").cast("bigint").alias("n_plays"),
            F.countDistinct("user_id").alias("n_users"),
            F.countDistinct("artist_id").alias("unique_count"),
        )

    user_rows = ur.groupBy("user_id").agg(F.sum("rows").alias("rows"))
    active = user_rows.where(F.col("rows") >= min_plays).select("user_id")
    per_artist = uag.groupBy("artist_id", "gender").agg(F.count("user_id").alias("unique_users"))
    per_artist_solo = (
        uag.where(F.col("n_solo") > 0).groupBy("artist_id", "gender").agg(F.count("user_id").alias("unique_users"))
    )
    genres = stats.recording_genres(recordings)
    return {
        "gender_distribution": dist(uag, "gender"),
        "gender_distribution_active": dist(uag.join(active, "user_id", "left_semi"), "gender"),
        "type_distribution": dist(uag, "type"),
        "artist_popularity": ua.groupBy("artist_id").agg(
            F.sum("n").cast("bigint").alias("n_plays"), F.count("user_id").alias("n_users")
        ),
        "artist_users": per_artist,
        "gender_mean_users": per_artist.groupBy("gender").agg(F.avg("unique_users").alias("avg_unique_users")),
        "artist_users_solo": per_artist_solo,
        "gender_mean_users_solo": per_artist_solo.groupBy("gender").agg(
            F.avg("unique_users").alias("avg_unique_users")
        ),
        "release_popularity": urel.groupBy("release_id").agg(
            F.sum("n").cast("bigint").alias("n_plays"), F.count("user_id").alias("n_users")
        ),
        "track_popularity": ur.groupBy("rec_id").agg(F.sum("n").cast("bigint").alias("n_plays")),
        "plays_per_user": ur.groupBy("user_id").agg(
            F.sum(F.when(F.col("rec_id").isNotNull(), F.col("rows")).otherwise(0)).cast("bigint").alias("play_count"),
            F.count("rec_id").alias("unique_play_count"),
        ),
        "genre_distribution": ur.join(genres, "rec_id", "left").groupBy("genre_name").agg(
            F.sum("n").cast("bigint").alias("n_plays"), F.countDistinct("user_id").alias("n_users")
        ),
        # need the row-level list rules (explode drops empty lists; first element)
        "distinct_counts": stats.distinct_counts(plays),
        "gender_distribution_first": stats.gender_distribution_first(plays, artists),
        "monthly_plays": stats.monthly_plays(plays),
    }


def write_statistics(suite: dict[str, DataFrame], out_dir: str) -> None:
    for name, df in suite.items():
        write_parquet(df, os.path.join(out_dir, f"{name}.parquet"))


# -- PIPE6: inequality and popularity report -------------------------------------------
def analysis_report(spark: SparkSession, stats_dir: str) -> dict[str, DataFrame]:
    """Gini, fractional ranks, Lorenz points, histogram and overview from
    the stored statistics."""
    read = lambda n: spark.read.parquet(os.path.join(stats_dir, f"{n}.parquet"))
    releases, artists_c, genres = read("release_popularity"), read("artist_popularity"), read("genre_distribution")
    tracks, per_user, solo = read("track_popularity"), read("plays_per_user"), read("artist_users_solo")
    genres = genres.dropna(subset=["genre_name"])
    rank2 = lambda df: inequality.fractional_ranks(
        df, {"rank_inplay": "n_plays", "rank_inuser": "n_users"}
    )
    return {
        "gini_release_users": inequality.gini(releases, "n_users"),
        "gini_release_plays": inequality.gini(releases, "n_plays"),
        "gini_by_gender": inequality.gini(solo, "unique_users", ["gender"]),
        "artist_rank": rank2(artists_c),
        "release_rank": rank2(releases),
        "genre_rank": rank2(genres),
        "track_rank": inequality.fractional_rank(tracks, "n_plays", "rank"),
        "gender_rank": inequality.fractional_rank(solo, "unique_users", "rank_artist", False, ["gender"]),
        "lorenz_by_gender": inequality.lorenz_points(solo, "unique_users", ["gender"]),
        "log_play_histogram": inequality.log_histogram(per_user, "play_count"),
        "play_count_profile": stats.numeric_profile(per_user, ["play_count", "unique_play_count"]),
        "track_count_profile": stats.numeric_profile(tracks, ["n_plays"]),
        "density": stats.density(per_user),
        "overview": stats.overview(read("distinct_counts"), stats.density(per_user), read("monthly_plays")),
        "top_genres_users": genres.orderBy(F.desc("n_users"), "genre_name").limit(5).select("genre_name", "n_users"),
        "top_genres_plays": genres.orderBy(F.desc("n_plays"), "genre_name").limit(5).select("genre_name", "n_plays"),
    }


# -- PIPE7: recommender evaluation ------------------------------------------------------
def evaluation_job(actions: DataFrame, out_dir: str, start: str, data_from: str, data_to: str,
                   n: int = 100) -> DataFrame:
    """Windows, recommendations (one folder per window) and the metrics CSV."""
    ev = recsys.evaluate(actions, start, data_from, data_to, n=n)
    starts = ev["windows"].select("k", F.col("window_start").cast("date").alias("window_start"))
    write_recommendations(ev["recs"].join(F.broadcast(starts), "k").drop("k"), os.path.join(out_dir, "recs"))
    metrics = ev["metrics"].select(
        F.col("window_start").cast("date").alias("start_date"),
        F.col("window_end").cast("date").alias("end_date"),
        "ndcg", "rbp", "reciprank", "train_size", "test_size",
    ).orderBy("start_date")
    write_csv_report(metrics, os.path.join(out_dir, "metrics"))
    return metrics
