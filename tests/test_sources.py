"""Scans and sinks on files written by the tests (SRC1-16, SNK1-11)."""

import json
import os

import zstandard
from pyspark.sql import functions as F

from table_folders import SMALL_SF
from playstats.plans.fixtures import Fixtures
from playstats.sources import (
    append_segments,
    audit_lines,
    describe,
    empty_like,
    read_dump,
    read_play_files,
    read_segments,
    read_table,
    rejected_files,
    write_csv_report,
    write_parquet,
    write_recommendations,
    write_segmented_plays,
)


def write_play_tree(spark, root, limit_users=None):
    """Write the fixture's UUID plays as <root>/<segment hex>/<user uuid>.txt.zst."""
    rows = Fixtures(spark, SMALL_SF).plays_uuid.collect()
    by_user = {}
    for r in rows:
        by_user.setdefault((r["segment"], r["user_id"]), []).append(r)
    cctx = zstandard.ZstdCompressor()
    for (seg, user), plays in by_user.items():
        d = os.path.join(root, f"{int(seg):02x}")
        os.makedirs(d, exist_ok=True)
        lines = []
        for p in plays:
            artists = "" if p["artist_ids"] is None else ",".join(p["artist_ids"])
            lines.append(f"{p['timestamp']}\t{artists}\t{p['release_id']}\t{p['rec_id']}")
        with open(os.path.join(d, f"{user}.txt.zst"), "wb") as fh:
            fh.write(cctx.compress(("\n".join(lines) + "\n").encode()))
    return rows


def test_play_files_round_trip(spark, workdir):
    rows = write_play_tree(spark, workdir)
    with open(os.path.join(workdir, "00", "README.md"), "w") as fh:
        fh.write("not a play file\n")
    plays = read_play_files(spark, workdir)
    assert plays.count() == len(rows)
    assert dict(describe(plays))["timestamp"] == "bigint"
    got = sorted((r["user_id"], r["timestamp"], r["rec_id"]) for r in plays.collect())
    want = sorted((r["user_id"], r["timestamp"], r["rec_id"]) for r in rows)
    assert got == want
    # an empty list is written as an empty field, which reads back as NULL
    one = plays.where(F.size("artist_ids") > 1).first()
    assert all(len(a) == 36 for a in one["artist_ids"])
    bad = [r["file_path"] for r in rejected_files(spark, workdir).collect()]
    assert len(bad) == 1 and bad[0].endswith("README.md")


def test_ndjson_dumps(spark, workdir):
    path = os.path.join(workdir, "artist.json")
    with open(path, "w") as fh:
        fh.write(json.dumps({"id": "0B1C2D3E-0000-4000-8000-000000000001", "name": "A", "gender": "Female",
                             "type": "Person", "extra": 1}) + "\n")
        fh.write(json.dumps({"id": "0b1c2d3e-0000-4000-8000-000000000002", "name": "B", "gender": None,
                             "type": "Group"}) + "\n")
    df = read_dump(spark, path, "artist")
    assert df.columns == ["artist_id", "name", "gender", "type"]
    assert sorted(r["artist_id"] for r in df.collect())[0] == "0b1c2d3e-0000-4000-8000-000000000001"
    rpath = os.path.join(workdir, "recording.json")
    with open(rpath, "w") as fh:
        fh.write(json.dumps({"id": "c", "title": "t", "artist-credit": [{"artist": {"genres": [{"name": "rock"}]}}]})
                 + "\n")
    rec = read_dump(spark, rpath, "recording").first()
    assert json.loads(rec["artist_credit"]) == [{"artist": {"genres": [{"name": "rock"}]}}]


def test_segmented_write_and_idempotent_append(spark, workdir):
    plays = Fixtures(spark, SMALL_SF).plays
    out = os.path.join(workdir, "plays")
    write_segmented_plays(plays, out, rows_per_file=500)
    back = read_segments(spark, out)
    assert back.count() == plays.count()
    files = [f for _, _, fs in os.walk(out) for f in fs if f.endswith(".parquet")]
    assert len(files) >= plays.count() // 500
    solo = os.path.join(workdir, "solo")
    part = plays.where(F.size("artist_ids") == 1)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    append_segments(part.where("segment = 0 and user_id % 2 = 0"), solo, "file-a")
    append_segments(part.where("segment = 0 and user_id % 2 = 1"), solo, "file-b")
    append_segments(part.where("segment = 1"), solo, "file-c")
    for _ in range(2):  # a second file of a segment adds to the first, a file loaded again adds nothing
        append_segments(part.where("segment = 0 and user_id % 2 = 0"), solo, "file-a")
        assert read_table(spark, solo).count() == part.where("segment in (0, 1)").count()
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode


def test_small_writers(spark, workdir):
    df = spark.createDataFrame([("initial", 1234567), ("final", 1)], "step string, n_rows long")
    assert audit_lines(df) == ["initial: 1,234,567", "final: 1"]
    write_csv_report(df, os.path.join(workdir, "report"))
    back = spark.read.option("header", "true").csv(os.path.join(workdir, "report"))
    assert back.count() == 2
    assert empty_like(spark, df).count() == 0
    write_parquet(df, os.path.join(workdir, "t"))
    assert read_table(spark, os.path.join(workdir, "t"), ["step"]).columns == ["step"]
    recs = spark.createDataFrame([("1995-01-01", 1, 2, 1)], "window_start string, user_id long, item_id long, rank int")
    write_recommendations(recs, os.path.join(workdir, "recs"))
    assert os.path.isdir(os.path.join(workdir, "recs", "window_start=1995-01-01"))


def test_a_query_derives_the_views_that_it_reads(spark, workdir):
    from datetime import date

    import __spark_entry__ as entry
    from playstats.plans import fixtures

    tables = {
        "supplier": ([(i, f"s{i}") for i in range(1, 9)], "s_suppkey long, s_name string"),
        "part": ([(i, "a b", "T", i % 3) for i in range(1, 6)], "p_partkey long, p_name string, p_type string, p_size int"),
        "orders": ([(i, i % 7, date(1995, 1, 1 + i % 28)) for i in range(1, 60)], "o_orderkey long, o_custkey long, o_orderdate date"),
        "lineitem": ([(o, n, 1 + o % 8, 1 + n % 5) for o in range(1, 60) for n in (1, 2, 3)] * 2,
                     "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(workdir, f"{name}.parquet"))
    plain, got = Fixtures(spark, workdir), entry.queries()["appended_solo_plays"](spark, workdir)
    solo = plain.plays.where(F.size("artist_ids") == 1)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got) == key(solo) and got.count() > 100
    fx = Fixtures.on_demand(spark, workdir)
    assert [name for name in fixtures.MATERIALIZED_VIEWS if name in fx._cache] == ["plays"]
    # the others are derived when they are asked for, from stored ones, and once
    assert key(entry.queries()["parsed_plays"](spark, workdir)) and set(fx._cache) >= {"plays", "plays_uuid", "raw_plays"}
    assert "artist" not in fx._cache and fx.plays_uuid is Fixtures.stored(spark, workdir).plays_uuid
    for name in fixtures.MATERIALIZED_VIEWS:
        assert hasattr(fx._cache[name], "_stage_path") and key(getattr(fx, name)) == key(getattr(plain, name)), name
