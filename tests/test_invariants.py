"""Invariants of the pipeline on the fixture tables, and plan checks."""

import pytest
from pyspark.sql import functions as F

from table_folders import SMALL_SF
import __spark_entry__ as entry
from playstats.operators import encode, stats
from playstats.operators.checks import bad_uuids, duplicate_keys, null_counts
from playstats.plans.fixtures import Fixtures
from playstats.schemas import ID_RANGES


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SMALL_SF)


def test_codes_dense_unique_in_range(fx):
    ids = encode.build_id_dictionary(fx.plays_uuid)
    per_type = ids.groupBy("entity_type").agg(
        F.min("id_num").alias("lo"), F.max("id_num").alias("hi"), F.count("*").alias("n"),
        F.countDistinct("id_num").alias("d"),
    ).collect()
    for r in per_type:
        assert r["lo"] == ID_RANGES[r["entity_type"]]
        assert r["hi"] - r["lo"] + 1 == r["n"] == r["d"]
    assert duplicate_keys(ids, ["entity_type", "entity_uuid"]).count() == 0
    assert encode.check_code_capacity(ids)["user_id"] == fx.plays.select("user_id").distinct().count()


def test_partitioning_does_not_change_codes(fx):
    a = encode.build_id_dictionary(fx.plays_uuid)
    b = encode.build_id_dictionary(fx.plays_uuid.repartition(3))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_encode_decode_identity(fx):
    ids = encode.build_id_dictionary(fx.plays_uuid)
    coded = encode.encode_plays(fx.plays_uuid, ids)
    assert coded.count() == fx.plays_uuid.count()
    assert null_counts(coded, ["user_id", "release_id", "rec_id"]).first().asDict() == {
        "user_id": 0, "release_id": 0, "rec_id": 0}
    back = encode.decode_plays(coded, ids).select("user_id", "timestamp", "release_id", "rec_id")
    orig = fx.plays_uuid.select("user_id", "timestamp", "release_id", "rec_id")
    assert back.exceptAll(orig).count() == 0 and orig.exceptAll(back).count() == 0
    assert bad_uuids(fx.plays_uuid, "user_id").count() == 0


def test_rollup_form_equals_raw_form(spark, fx):
    """AGG6 from (artist, user) pairs equals grouping the exploded plays."""
    raw = spark.sql(
        """select a.gender, count(p.user_id) as n_plays, count(distinct p.user_id) as n_users,
                  count(distinct p.artist_id) as unique_count
           from (select explode(artist_ids) as artist_id, user_id from {plays}) p
           left join {artist} a on p.artist_id = a.artist_id group by a.gender""",
        plays=fx.plays, artist=fx.artist,
    )
    ours = stats.gender_distribution(fx.plays, fx.artist)
    assert ours.exceptAll(raw).count() == 0 and raw.exceptAll(ours).count() == 0


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", ["gender_distribution", "genre_distribution", "clean_plays", "artist_rank",
                                  "gini_by_gender", "entity_ids", "exclusion_audit"])
def test_plans_stay_in_the_jvm(spark, name):
    df = entry.queries()[name](spark, SMALL_SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PYTHON_NODES)


def test_dimension_is_broadcast_and_pairs_are_preaggregated(spark):
    df = entry.queries()["gender_distribution"](spark, SMALL_SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert "Generate explode" in plan


def test_late_filter_reaches_the_scan(spark):
    from playstats.operators.clean import plays_after

    df = plays_after(spark.read.parquet(f"{SMALL_SF}/orders.parquet").withColumnRenamed("o_orderkey", "timestamp"),
                     "1998-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThanOrEqual(o_orderkey," in plan


def test_single_partition_exchanges_only_carry_aggregates(spark):
    """No query moves data rows into one task: every single-partition
    exchange sits on a partial aggregate (global totals or bucket totals)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # inspect the static plan
    try:
        for name, build in entry.queries().items():
            lines = build(spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString().split("\n")
            for i, line in enumerate(lines):
                if "Exchange SinglePartition" in line and "ReusedExchange" not in line:
                    child = next((x for x in lines[i + 1:] if x.strip(" :+-")), "")
                    assert "Aggregate" in child, (name, child)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_removed_stage_is_gone(spark):
    import os

    from playstats.session import cut_lineage, remove_stage

    stored = cut_lineage(spark.range(5), "removed")
    path = stored._stage_path.removeprefix("file:")
    assert stored.count() == 5 and os.path.isdir(path)
    remove_stage(stored)
    assert not os.path.exists(path)
