"""A hot key: one user holds most of the plays. Results must equal the
brute-force forms (no rows dropped, capped or sampled)."""

from pyspark.sql import functions as F

from table_folders import SMALL_SF
from playstats.operators import clean, inequality, stats
from playstats.plans.fixtures import Fixtures


def _hot_plays(fx, copies=300):
    plays = fx.plays
    hot_user = plays.select(F.min("user_id")).first()[0]
    hot = plays.where(F.col("user_id") == hot_user).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("c")
    ).select("segment", "user_id", (F.col("timestamp") + F.col("c")).alias("timestamp"),
             "artist_ids", "release_id", "rec_id")
    return plays.unionByName(hot)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hot_user_distribution_equals_raw(spark):
    fx = Fixtures(spark, SMALL_SF)
    plays = _hot_plays(fx)
    raw = spark.sql(
        """select a.gender, count(p.user_id) as n_plays, count(distinct p.user_id) as n_users,
                  count(distinct p.artist_id) as unique_count
           from (select explode(artist_ids) as artist_id, user_id from {plays}) p
           left join {artist} a on p.artist_id = a.artist_id group by a.gender""",
        plays=plays, artist=fx.artist,
    )
    assert _rows(stats.gender_distribution(plays, fx.artist)) == _rows(raw.select(
        "gender", "n_plays", "n_users", "unique_count"))


def test_hot_user_audit_balances(spark):
    fx = Fixtures(spark, SMALL_SF)
    plays = _hot_plays(fx)
    audit = {r["step"]: r["n_rows"] for r in clean.exclusion_audit(plays, fx.artist, "1999-01-01").collect()}
    assert audit["initial"] == plays.count()
    assert audit["initial"] - audit["duplicates"] == plays.distinct().count()
    kept = clean.clean_plays(plays, fx.artist, "1999-01-01")
    assert kept.count() == audit["final"]


def test_hot_value_ranks_and_gini(spark):
    # a third of the items share one value
    vals = [1] * 400 + list(range(2, 802))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v long")
    xs = sorted(vals)
    n = len(xs)
    want = sum((2 * (i + 1) - n - 1) * x for i, x in enumerate(xs)) / (n * sum(xs))
    assert abs(inequality.gini(df, "v").first()["gini"] - want) < 1e-12
    ranks = inequality.fractional_rank(df, "v", "r")
    assert ranks.where("v = 1").select(F.min("r"), F.max("r")).first() == (1.0, 1.0)


def test_hot_and_missing_keys_are_spread_in_encoding(spark):
    from playstats.operators import encode

    third = ["hot"] * 3000 + [None] * 3000 + [f"key{i}" for i in range(3000)]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(third)], "timestamp bigint, user_id string")
    look = spark.createDataFrame([("hot", -1)] + [(f"key{i}", i) for i in range(0, 3000, 2)], "__key string, code int")
    hot = encode.frequent_values(rows, {"user_id": F.col("user_id")}, 0.1)
    assert hot == {"user_id": ["hot"]} or "hot" in hot["user_id"] and len(hot["user_id"]) <= 10
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = encode.join_codes(rows, F.col("user_id"), look, "code", hot["user_id"], F.xxhash64("timestamp"))
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        got = {r["timestamp"]: r["code"] for r in out.collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(sizes) > 4 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    codes = {"hot": -1, **{f"key{i}": i for i in range(0, 3000, 2)}}
    assert got == {i: codes.get(k) for i, k in enumerate(third)}
