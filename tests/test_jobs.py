"""The batch jobs end to end on the fixture tables."""

import os

from table_folders import SMALL_SF
import __spark_entry__ as entry
from playstats.plans import jobs
from playstats.plans.catalog import EVAL_DATA_FROM, EVAL_DATA_TO, EVAL_START, LATE_CUT
from playstats.plans.fixtures import Fixtures

SUITE_QUERIES = [
    "gender_distribution", "gender_distribution_active", "type_distribution", "artist_popularity",
    "artist_users", "gender_mean_users", "artist_users_solo", "gender_mean_users_solo", "release_popularity",
    "track_popularity", "plays_per_user", "genre_distribution", "distinct_counts", "gender_distribution_first",
    "monthly_plays",
]


def _same(a, b):
    from playstats.plans.compare import normalize

    rows = lambda df: sorted((tuple(normalize(v) for v in r) for r in df.collect()), key=repr)
    return rows(a) == rows(b.select(*a.columns))


def test_statistics_suite_equals_queries(spark, workdir):
    fx = Fixtures(spark, SMALL_SF)
    suite = jobs.statistics_suite(fx.plays, fx.artist, fx.recording)
    q = entry.queries()
    assert sorted(suite) == sorted(SUITE_QUERIES)
    for name in SUITE_QUERIES:
        assert _same(suite[name], q[name](spark, SMALL_SF)), name
    jobs.write_statistics(suite, workdir)
    report = jobs.analysis_report(spark, workdir)
    for name in ("gini_release_users", "gini_by_gender", "lorenz_by_gender", "log_play_histogram", "artist_rank",
                 "overview", "top_genres_users"):
        assert _same(report[name], q[name](spark, SMALL_SF)), name


def test_prep_and_rollup_jobs(spark, workdir):
    fx = Fixtures(spark, SMALL_SF)
    kept = jobs.prep_plays(spark, fx.plays, fx.artist, workdir, LATE_CUT)
    assert _same(kept.select("user_id", "timestamp", "artist_id", "release_id", "rec_id"),
                 entry.queries()["clean_plays"](spark, SMALL_SF))
    log = "\n".join(r["value"] for r in spark.read.text(os.path.join(workdir, "exclusion_log.txt")).collect()) + "\n"
    assert log.startswith("initial: ")
    jobs.solo_artist_counts(kept, workdir)
    assert _same(spark.read.parquet(os.path.join(workdir, "user_artist_counts")),
                 entry.queries()["user_artist_rollup"](spark, SMALL_SF))


def test_evaluation_job(spark, workdir):
    fx = Fixtures(spark, SMALL_SF)
    metrics = jobs.evaluation_job(fx.actions, workdir, EVAL_START, EVAL_DATA_FROM, EVAL_DATA_TO, n=100)
    csv = spark.read.option("header", "true").csv(os.path.join(workdir, "metrics"))
    assert csv.count() == metrics.count() == entry.queries()["eval_metrics"](spark, SMALL_SF).count()
    assert os.path.isdir(os.path.join(workdir, "recs"))
