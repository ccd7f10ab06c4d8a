"""Hand-made edge rows with their expected values (FIXTURES.md §3)."""

import math
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from playstats.functions import credit_genres, first_element, list_length, shift_days, shift_months, split_list
from playstats.operators import clean, encode, inequality, rollups, stats
from playstats.schemas import epoch_seconds

LIST_SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("a", T.ArrayType(T.LongType()))])


def test_list_rules(spark):
    df = spark.createDataFrame([(1, [10, 20, 99]), (2, []), (3, None)], LIST_SCHEMA)
    got = {r["id"]: (r["n"], r["first"]) for r in df.select("id", list_length("a").alias("n"),
                                                            first_element("a").alias("first")).collect()}
    assert got == {1: (3, 10), 2: (0, None), 3: (None, None)}
    exploded = rollups.explode_artists(df.withColumnRenamed("a", "artist_ids"), "id")
    assert sorted(r["id"] for r in exploded.collect()) == [1, 1, 1]


def test_list_encoding_keeps_order_and_misses(spark):
    plays = spark.createDataFrame(
        [("u", 1, ["x10", "x20", "x99"], "r", "c"), ("u", 2, [], "r", "c"), ("u", 3, None, "r", "c")],
        "user_id string, timestamp long, artist_ids array<string>, release_id string, rec_id string",
    )
    ids = spark.createDataFrame(
        [("artist_ids", "x10", 100), ("artist_ids", "x20", 200)],
        "entity_type string, entity_uuid string, id_num int",
    )
    out = {r["timestamp"]: r["artist_ids"] for r in encode.encode_plays(plays, ids).collect()}
    assert out == {1: [100, 200, None], 2: [], 3: []}


def test_split_on_comma(spark):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "a,,b")], "id int, s string")
    got = {r["id"]: r["parts"] for r in df.select("id", split_list("s").alias("parts")).collect()}
    assert got == {1: [""], 2: None, 3: ["a", "", "b"]}


@pytest.mark.parametrize(
    "credit,expected",
    [
        ('[{"artist":{"genres":[{"name":"rock"},{"name":"pop"}]}},{"artist":{"genres":[{"name":"rock"}]}}]',
         ["rock", "pop", "rock"]),
        ('[{"artist":{"genres":[]}}]', []),
        ('[{"artist":{"genres":null}}]', []),
        ("[]", []),
        (None, []),
        ('[{"artist":{}},{"artist":{"genres":[{"name":"jazz"}]}}]', ["jazz"]),
        ('[{"artist":{"genres":[{"id":1},{"name":null}]}}]', []),
    ],
)
def test_credit_genres(spark, credit, expected):
    df = spark.createDataFrame([(credit,)], "c string")
    assert df.select(credit_genres("c").alias("g")).first()["g"] == expected


ARTISTS = [(1, "Male", "Person"), (2, None, "Group"), (3, None, "Person"), (4, "Not applicable", "Person")]


def test_exclusion_reasons(spark):
    cut = "2014-01-01"
    assert epoch_seconds(cut) == 1388534400
    rows = [
        ([1], 1388534399, "keep"),
        ([1], 1388534400, "late"),
        ([1, 3], 1388534400, "group"),
        ([2], 1200000000, "nonperson"),
        ([99], 1200000000, "nonperson"),
        ([3], 1200000000, "nullgender"),
        ([4], 1200000000, "na"),
        ([], 1200000000, "keep"),
        (None, 1200000000, "keep"),
        ([None], 1200000000, "keep"),
    ]
    plays = spark.createDataFrame(
        [(i, lst, ts, i, i) for i, (lst, ts, _) in enumerate(rows)],
        "user_id long, artist_ids array<long>, timestamp long, release_id long, rec_id long",
    )
    artists = spark.createDataFrame(ARTISTS, "artist_id long, gender string, type string")
    got = {r["user_id"]: r["reason"] for r in clean.with_reason(plays, artists, cut).collect()}
    assert got == {i: reason for i, (_, _, reason) in enumerate(rows)}
    kept = clean.clean_plays(plays, artists, cut)
    assert sorted(r["user_id"] for r in kept.collect()) == [0, 7, 8, 9]
    assert all(r["artist_id"] is None for r in kept.where("user_id >= 7").collect())


def test_audit_counts_balance(spark):
    plays = spark.createDataFrame(
        [(1, [1], 10), (1, [1], 10), (2, [2], 10), (3, [1, 2], 10), (4, [3], 10)],
        "user_id long, artist_ids array<long>, timestamp long",
    ).select("user_id", "timestamp", "artist_ids", F.lit(1).alias("release_id"), F.lit(1).alias("rec_id"))
    artists = spark.createDataFrame(ARTISTS, "artist_id long, gender string, type string")
    audit = {r["step"]: r["n_rows"] for r in clean.exclusion_audit(plays, artists, "2014-01-01").collect()}
    assert audit["initial"] == 5 and audit["duplicates"] == 1
    removed = sum(audit[s] for s in ("group", "late", "nonperson", "nullgender", "na"))
    assert audit["initial"] - audit["duplicates"] - removed == audit["final"] == 1


def test_distinct_rows(spark):
    df = spark.createDataFrame(
        [(1, [1, 2]), (1, [1, 2]), (1, [2, 1]), (None, None), (None, None)], "u long, a array<long>"
    )
    assert clean.distinct_plays(df).count() == 3


def test_fractional_rank_and_gini(spark):
    df = spark.createDataFrame([(1, 5), (2, 3), (3, 3), (4, 1)], "id int, v long")
    ranks = {r["id"]: r["r"] for r in inequality.fractional_rank(df, "v", "r").collect()}
    assert ranks == {1: 0.25, 2: 0.75, 3: 0.75, 4: 1.0}
    asc = {r["id"]: r["r"] for r in inequality.fractional_rank(df, "v", "r", descending=False).collect()}
    assert asc == {1: 1.0, 2: 0.75, 3: 0.75, 4: 0.25}
    g = lambda vals: inequality.gini(spark.createDataFrame([(v,) for v in vals], "v long"), "v").first()["gini"]
    assert g([1, 1, 1]) == 0.0
    assert g([1, 3]) == pytest.approx(0.25)
    with pytest.raises(Exception):
        g([0, 2])


def test_gini_matches_array_formula(spark):
    import random

    rnd = random.Random(7)
    vals = [rnd.choice([1, 1, 2, 3, 5, 8, 100, 1000]) for _ in range(500)]
    xs = sorted(vals)
    n = len(xs)
    expected = sum((2 * (i + 1) - n - 1) * x for i, x in enumerate(xs)) / (n * sum(xs))
    got = inequality.gini(spark.createDataFrame([(v,) for v in vals], "v long"), "v").first()["gini"]
    assert got == pytest.approx(expected, rel=1e-12)


def test_lorenz_ends_at_one(spark):
    df = spark.createDataFrame([("m", 1), ("m", 3), ("m", 3), ("f", 2), (None, 4)], "g string, v long")
    pts = inequality.lorenz_points(df, "v", ["g"]).collect()
    last = {}
    for r in pts:
        if r["g"] not in last or r["v"] > last[r["g"]]["v"]:
            last[r["g"]] = r
    assert set(last) == {"m", "f", None}
    assert all(r["rank"] == 1.0 and r["cum_fraction"] == pytest.approx(1.0) for r in last.values())


def test_month_and_day_shifts(spark):
    df = spark.createDataFrame([(datetime(2013, 4, 30, 13, 5),)], "ts timestamp")
    got = df.select(shift_months(F.col("ts"), -2).alias("x")).first()["x"]
    assert (got.month, got.day, got.hour, got.minute) == (2, 28, 13, 5)
    got = df.select(shift_days(F.col("ts"), -1).alias("x")).first()["x"]
    assert (got.month, got.day) == (4, 29)


def test_window_bound_is_midnight(spark):
    from playstats.operators import recsys

    stamps = ["2014-01-01 00:00:00", "2014-01-30 00:00:00", "2014-01-31 00:00:00", "2014-01-31 05:00:00",
              "2014-02-01 00:00:00"]
    actions = spark.createDataFrame(
        [(1, 1, int(datetime.strptime(s, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc).timestamp()))
         for s in stamps],
        "user long, item long, first_time long",
    )
    prepared = recsys.prepare_actions(actions, "2014-01-01", "2014-12-31", min_actions=1)
    windows = spark.createDataFrame(
        [(0, datetime(2014, 1, 1), datetime(2014, 2, 1))], "k int, window_start timestamp, window_end timestamp"
    )
    inw = recsys.assign_windows(prepared, windows, "2014-01-01", step=1, size=1)
    assert inw.count() == 3


def test_file_name_pattern(spark):
    from playstats.schemas import PLAY_FILE_RE

    df = spark.createDataFrame(
        [("file:/d/00/0b1c2d3e-0000-4000-8000-000000000001.txt.zst",), ("file:/d/00/README.md",),
         ("file:/d/x.txt.zst",)],
        "p string",
    )
    ok = [r["ok"] for r in df.select((F.regexp_extract("p", PLAY_FILE_RE, 0) != "").alias("ok")).collect()]
    assert ok == [True, False, False]


def test_file_name_pattern_is_anchored(spark):
    from playstats.sources.playfiles import parse_plays, require_no_rejects

    uid, key = "0" * 8 + "-0000-0000-0000-" + "0" * 12, "a" * 8 + "-0000-0000-0000-" + "b" * 12
    rows = [
        (f"/data/0a/{uid}.txt.zst", 1, key, key.upper(), key, None),
        (f"/data/xyz0a/{uid}.txt.zst", 1, key, key, key, "file_name"),
        (f"/data/0a/{uid}.txt", 1, key, key, key, "file_name"),
        ("/data/0a/ab-12.txt.zst", 1, key, key, key, "user_id"),
        (f"/data/0a/{uid}.txt.zst", None, key, key, key, "timestamp"),
        (f"/data/0a/{uid}.txt.zst", 1, f"{key},", key, key, "artist_ids"),
        (f"/data/0a/{uid}.txt.zst", 1, None, "x", key, "release_id"),
        (f"/data/0a/{uid}.txt.zst", 1, None, None, "x", "rec_id"),
        (f"/data/0a/{uid}.txt.zst", 1, None, None, None, None),
    ]
    raw = spark.createDataFrame(rows, "file_path string, timestamp bigint, artist_ids string, release_id string, rec_id string, want string")
    parsed = parse_plays(raw)
    assert [r["reject"] for r in parsed.collect()] == [r[5] for r in rows]
    with pytest.raises(ValueError, match="artist_ids"):
        require_no_rejects(parsed)
    require_no_rejects(parse_plays(raw.limit(3)))


def test_gini_of_doubles(spark):
    from playstats.operators.inequality import gini

    values = [0.5, 1.5, 2.4, 7.3, 7.3, 0.1]
    x = sorted(values)
    n = len(x)
    want = sum((2 * i - n - 1) * v for i, v in enumerate(x, 1)) / (n * sum(x))
    got = gini(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()["gini"]
    assert got == pytest.approx(want)


def test_log_histogram_has_all_bins(spark):
    from playstats.operators.inequality import log_histogram

    df = spark.createDataFrame([(1,), (1,), (1000,)], "v bigint")
    rows = {r["bin"]: r["users"] for r in log_histogram(df, "v", 10).collect()}
    assert rows == {b: {0: 2, 9: 1}.get(b, 0) for b in range(10)}
    assert log_histogram(df.limit(0), "v", 10).count() == 0


def test_building_queries_starts_no_size_probe(spark):
    from table_folders import SMALL_SF
    from playstats.plans.catalog import CATALOG
    from playstats.plans.fixtures import Fixtures

    fx = Fixtures.stored(spark, SMALL_SF)
    spark.sparkContext.setJobGroup("building", "queries are only built")
    for name in ("gender_distribution", "clean_plays", "genre_distribution", "type_distribution"):
        CATALOG[name].build(fx)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0


def test_views_hold_every_line_and_supplier(spark):
    from table_folders import SMALL_SF
    from playstats.plans.fixtures import Fixtures

    fx = Fixtures.stored(spark, SMALL_SF)
    assert fx.artist.count() == fx.table("supplier").count()
    assert fx.plays_base.count() == fx.table("lineitem").count()
    suppliers = fx.plays.select(F.explode("artist_ids").alias("a")).distinct()
    assert fx.table("lineitem").select(F.col("l_suppkey").alias("a")).distinct().join(suppliers, "a", "left_anti").count() == 0


def test_ranks_and_lists_past_the_broadcast_head(spark, monkeypatch):
    from playstats.operators import recsys

    rows = [(0, u, i) for u in range(6) for i in range(0, 40, u + 1)] + [(1, 1, 7), (1, 2, 9)] + [(0, 50, i) for i in range(40)]
    train = spark.createDataFrame(rows, "k int, user_id bigint, item_id bigint")
    monkeypatch.setattr(recsys, "ITEMS_OF_A_RUN", 4)
    ranks = recsys.popularity_ranks(train)
    count = {}
    for k, _, i in rows:
        count[k, i] = count.get((k, i), 0) + 1
    want = {}
    for k in (0, 1):
        for r, (_, i) in enumerate(sorted((-n, i) for (kk, i), n in count.items() if kk == k), 1):
            want[k, i] = r
    assert {(r["k"], r["item_id"]): r["pop_rank"] for r in ranks.collect()} == want
    # every training row is a test row too, beside rows of items that are new to the user or were never trained
    tests = rows + [(0, u, i) for u in range(6) for i in (1, 3, 35, 77)] + [(0, 99, 1), (1, 1, 9)]
    tests = sorted(set(tests))
    test = spark.createDataFrame(tests, train.schema)
    labelled = train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))
    placed = recsys.place_rows(labelled, ranks)
    users = recsys.user_scores(placed, 5)
    ranges = recsys.free_ranges(placed, users, 5)
    got = [sorted(map(tuple, recsys.recommend_top_n(ranges, ranks, head).collect())) for head in (1, 7, 1000)]
    assert got[0] == got[1] == got[2] and got[0]
    lists = {}
    for k, u in {(k, u) for k, u, _ in rows}:
        seen = {i for kk, uu, i in rows if (kk, uu) == (k, u)}
        items = sorted((r, i) for (kk, i), r in want.items() if kk == k and i not in seen)
        lists[k, u] = [i for _, i in items[:5]]
    assert got[0] == sorted((k, u, i, r) for (k, u), items in lists.items() for r, i in enumerate(items, 1))
    assert ranges.groupBy("k", "user_id").count().where("count > 5").count() == 0
    discount = lambda r: 1 / max(1, math.log2(r))
    for r in users.collect():
        wanted = {i for k, u, i in tests if (k, u) == (r["k"], r["user_id"])}
        hits = [p for p, i in enumerate(lists[r["k"], r["user_id"]], 1) if i in wanted]
        assert r["n_test"] == len(wanted)
        assert r["ndcg"] == pytest.approx(sum(map(discount, hits)) / sum(map(discount, range(1, len(wanted) + 1))))
        assert r["rbp"] == pytest.approx(0.15 * sum(0.85 ** (h - 1) for h in hits))
        assert r["reciprank"] == pytest.approx(1 / hits[0] if hits else 0)
    assert {(r["k"], r["user_id"]) for r in users.collect()} == set(lists)


@pytest.mark.parametrize("ranges", [2, 3, 1024])
def test_counts_below_follow_any_values(spark, ranges):
    vals = [0.1 * i for i in range(300)] + [7.0] * 200 + [-5.0, 1e-9, 1e12, 3.25, 3.25]
    df = spark.createDataFrame([(g, v) for g in ("a", None) for v in vals[: None if g else 350]], "g string, v double")
    hist = inequality.value_histogram(df, "v", ["g"])
    for r in inequality.with_below(hist, "v", ["f"], ["g"], ranges).collect():
        own = vals if r["g"] else vals[:350]
        assert (r["f_below"], r["f"], r["f_total"]) == (sum(x < r["v"] for x in own), own.count(r["v"]), len(own))


def test_exact_percentiles(spark):
    import pandas as pd

    data = {"a": [1, 5, 5, 9, 100, None], "b": [2.5, -1.0, None, None, 0.5, 7.25], "c": [None] * 6, "d": [3, None, None, None, None, None]}
    df = spark.createDataFrame(list(zip(*data.values())), "a long, b double, c long, d int")
    got = {r["variable"]: r for r in stats.numeric_profile(df, list(data)).collect()}
    for c in ("a", "b"):
        want = pd.Series(data[c], dtype=float).describe().round(2)
        assert [got[c][k] for k in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == pytest.approx(list(want))
    assert got["c"]["count"] == 0 and got["c"]["p50"] is None
    assert (got["d"]["count"], got["d"]["p25"], got["d"]["std"]) == (1, 3, None)


def test_codes_of_keys_with_one_prefix(spark):
    ents = spark.range(50_000).select(F.lit("user_id").alias("entity_type"), F.concat(F.lit("user-"), "id").alias("entity_uuid"))
    ents = ents.union(spark.range(3).select(F.lit("rec_id"), F.concat(F.lit("r"), "id")))
    rows = encode.dense_codes(ents).collect()
    users = sorted((r["entity_uuid"], r["id_num"]) for r in rows if r["entity_type"] == "user_id")
    first = users[0][1]
    assert [n for _, n in users] == list(range(first, first + 50_000)) and len(rows) == 50_003


def test_no_person_in_the_dimension_excludes_rows_without_artist(spark):
    plays = spark.createDataFrame([(1, 10, [], 1, 1), (1, 11, None, 1, 1), (1, 12, [2], 1, 1)],
                                  "user_id int, timestamp bigint, artist_ids array<bigint>, release_id bigint, rec_id bigint")
    groups = spark.createDataFrame([(2, "Male", "Group")], "artist_id bigint, gender string, type string")
    people = spark.createDataFrame([(3, "Male", "Person")], "artist_id bigint, gender string, type string")
    reasons = lambda dim: {r["timestamp"]: r["reason"] for r in clean.with_reason(plays, dim).collect()}
    assert reasons(groups) == {10: "nonperson", 11: "nonperson", 12: "nonperson"}
    assert reasons(people) == {10: "keep", 11: "keep", 12: "nonperson"}
