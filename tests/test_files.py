"""Chunk files, play files, dumps, commit lists and the rollup stream on hand-made rows."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from playstats.operators.clean import clean_with_audit
from playstats.operators.packing import pack_whole
from playstats.operators.rollups import user_artist_rollup
from playstats.plans import jobs
from playstats.sources import (
    commits,
    load_dump,
    load_rows,
    read_loads,
    read_segments,
    scan_dump,
    scan_play_files,
    stage_load,
    vacuum,
    write_play_files,
    write_segmented_plays,
)
from playstats.sources.playfiles import parse_plays, split_rejects
from playstats.streaming import (
    compact_rollup,
    parsed_stream,
    read_clean_rollup,
    read_rejects,
    start_clean_rollup,
    start_rejects,
)

U = "0000000{}-0000-4000-8000-000000000000".format
PLAYS = "segment string, user_id string, timestamp bigint, artist_ids array<string>, release_id string, rec_id string"
NAMES = ["00", "1d", "1f", "1", "1e3", "2f", "0x1", "nan"]


def play(segment, user, time, artists=None, release=None, rec=None):
    return (segment, user, time, artists, release, rec)


# -- SNK1 ------------------------------------------------------------------------
def packed(sizes, limit):
    """Chunks by the plain rule: a chunk for each multiple of the limit that a member's start lies in."""
    out, before = [], 0
    for member, n in sorted(sizes.items()):
        if not out or out[-1][0] != before // limit:
            out.append((before // limit, []))
        out[-1][1].append(member)
        before += n
    return [tuple(m) for _, m in out]


@pytest.mark.parametrize("limit", [1, 17, 1000])
def test_packing_follows_the_rule(spark, limit):
    rng = random.Random(limit)
    keys = {f"k{k}" if k else None: {i: rng.choice([1, 2, 40, 90]) for i in range(rng.randint(1, 60))} for k in range(12)}
    df = spark.createDataFrame([(k, i, n) for k, sizes in keys.items() for i, n in sizes.items()], "k string, m bigint, n bigint")
    found = {}
    for r in pack_whole(df, "k", "m", "n", limit).orderBy("k", "chunk").collect():
        found.setdefault(r["k"], []).append(r)
    for k, sizes in keys.items():
        want = packed(sizes, limit)
        assert [(r["chunk"], r["first"], r["last"], r["members"]) for r in found[k]] == [(i + 1, m[0], m[-1], len(m)) for i, m in enumerate(want)]
        assert [r["rows"] for r in found[k]] == [sum(sizes[x] for x in m) for m in want]
        assert all(r["rows"] < limit + max(sizes.values()) for r in found[k])


def test_chunk_files_hold_whole_users(spark, workdir):
    # one user with a third of all rows, names of segments that look like numbers
    rows = [play("1d", U(1), t) for t in range(300)] + [play(NAMES[u % 8], f"{u:08d}-0000-4000-8000-000000000000", t) for u in range(60) for t in range(10)]
    out = os.path.join(workdir, "plays")
    write_segmented_plays(spark.createDataFrame(rows, PLAYS), out, rows_per_file=40)
    back = read_segments(spark, out).select("*", F.col("_metadata.file_path").alias("file"))
    assert back.count() == len(rows) and {r["segment"] for r in back.select("segment").distinct().collect()} == set(NAMES)
    assert back.groupBy("segment", "user_id").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0
    assert back.groupBy("segment", "chunk").agg(F.countDistinct("file").alias("n")).where("n > 1").count() == 0
    sizes = [r["count"] for r in back.groupBy("file").count().collect()]
    assert max(sizes) >= 300 and sorted(sizes)[-2] < 40 + 10
    # inside a file, users and times are in order
    one = next(f for f in sorted(r["file"] for r in back.select("file").distinct().collect()))
    order = [(r["user_id"], r["timestamp"]) for r in spark.read.parquet(one).collect()]
    assert order == sorted(order)


# -- SRC1-5 ------------------------------------------------------------------------
def test_play_files_round_trip_by_name(spark, workdir):
    rows = [play(s, U(i), 10 * i + t, [U(3), U(4)] if t else None, U(5), U(6)) for i, s in enumerate(NAMES[:6]) for t in range(3)]
    rows += [play("00", "readme", 1, None, U(5), U(6))]
    written = write_play_files(spark.createDataFrame(rows, PLAYS), workdir)
    assert {(r["file"], r["n_rows"]) for r in written.collect()} == {(f"{s}/{U(i)}.txt.zst", 3) for i, s in enumerate(NAMES[:6])} | {("00/readme.txt.zst", 1)}
    assert not [f for _, _, files in os.walk(workdir) for f in files if f.startswith("_")]
    good, bad = split_rejects(parse_plays(scan_play_files(spark, workdir)))
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(rows[:-1], key=repr)
    assert [(r["reject"], r["file_path"].endswith("00/readme.txt.zst")) for r in bad.collect()] == [("file_name", True)]


def write_lines(root, segment, user, lines):
    import zstandard

    os.makedirs(os.path.join(root, segment), exist_ok=True)
    with open(os.path.join(root, segment, f"{user}.txt.zst"), "wb") as fh:
        fh.write(zstandard.ZstdCompressor().compress("".join(x + "\n" for x in lines).encode()))


BAD_LINES = ["x\t\t\t", f"1\t{U(3)},y\t\t", f"\t{U(3)}\t\t", "2\t\tbad\t", "3\t\t\tbad", "4\ttoo\tfew"]


def test_batch_and_stream_treat_bad_rows_alike(spark, workdir):
    src = os.path.join(workdir, "src")
    write_lines(src, "1d", U(1), [f"5\t{U(3)}\t{U(5)}\t{U(6)}", *BAD_LINES])
    want = sorted(["line", "artist_ids", "timestamp", "release_id", "rec_id", "line"])
    jobs.import_plays(spark, src, os.path.join(workdir, "out"), use_mapping=False)
    batch = spark.read.parquet(os.path.join(workdir, "out", "rejected_plays"))
    assert sorted(r["reject"] for r in batch.collect()) == want
    assert read_segments(spark, os.path.join(workdir, "out", "plays")).count() == 1
    start_rejects(parsed_stream(spark, src), os.path.join(workdir, "bad"), os.path.join(workdir, "ck")).awaitTermination()
    assert sorted(r["reject"] for r in spark.read.parquet(os.path.join(workdir, "bad")).collect()) == want
    with pytest.raises(ValueError, match="cannot be loaded"):
        jobs.import_plays(spark, src, os.path.join(workdir, "none"), strict=True)
    assert not os.path.exists(os.path.join(workdir, "none"))


# -- SRC6-8, PIPE4 -------------------------------------------------------------------
def write_dump(path, lines):
    with open(path, "w") as fh:
        fh.writelines(x if isinstance(x, str) else json.dumps(x) + "\n" for x in lines)
    return path


def test_dump_lines_by_reason(spark, workdir):
    credit = [{"artist": {"genres": [{"name": "a|b\"c"}]}}]
    lines = [
        {"id": U(1).upper(), "title": "one", "artist-credit": credit, "more": {"x": [1]}},
        {"id": U(2), "title": None},
        '{"id": "' + U(3) + '", "title": "cut\n',
        "not json\n",
        {"title": "no key"},
        {"id": "xyz", "title": "t"},
        {"id": None, "title": "t"},
    ]
    path = write_dump(os.path.join(workdir, "recording.json"), lines)
    rows = scan_dump(spark, path, "recording").collect()
    assert sorted(r["reject"] or "" for r in rows) == sorted(["", "", "line", "line", "no_key", "bad_key", "no_key"])
    good = {r["rec_id"]: r for r in rows if r["reject"] is None}
    assert json.loads(good[U(1)]["artist_credit"]) == credit and good[U(2)]["title"] is None
    out = os.path.join(workdir, "t")
    assert load_dump(spark, path, "recording", out) == {"lines": 7, "line": 2, "no_key": 2, "bad_key": 1, "repeated_keys": 0}
    assert spark.read.parquet(out).count() == 2
    with pytest.raises(ValueError, match="cannot be loaded"):
        load_dump(spark, path, "recording", out, strict=True)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        load_dump(spark, os.path.join(workdir, "missing.json"), "recording", out)


def test_dump_with_a_repeated_key_leaves_the_old_table(spark, workdir):
    out, path = os.path.join(workdir, "t"), os.path.join(workdir, "artist.json")
    load_dump(spark, write_dump(path, [{"id": U(1), "name": "a"}]), "artist", out)
    with pytest.raises(ValueError, match="more than once"):
        load_dump(spark, write_dump(path, [{"id": U(1), "name": "a"}, {"id": U(1).upper(), "name": "b"}]), "artist", out)
    assert spark.read.parquet(out).count() == 1


# -- import to prep, PIPE1-4, JN5 -------------------------------------------------------
def test_jobs_from_files_to_rollup(spark, workdir):
    src, out = os.path.join(workdir, "src"), os.path.join(workdir, "out")
    write_lines(src, "1d", U(1), [f"5\t{U(3)}\t{U(5)}\t{U(6)}"] * 2 + [f"9\t{U(3)}\t{U(5)}\t{U(6)}", f"9\t{U(4)}\t{U(5)}\t{U(6)}"])
    write_lines(src, "00", U(2), [f"7\t{U(3)},{U(4)}\t{U(5)}\t{U(6)}", f"8\t{U(7)}\t\t"])
    dump = write_dump(os.path.join(workdir, "artist.json"), [
        {"id": U(3), "name": "a", "gender": "Female", "type": "Person"}, {"id": U(4), "name": "b", "gender": None, "type": "Group"},
        {"id": U(8), "name": "c", "gender": "Male", "type": "Person"},
    ])
    jobs.import_plays(spark, src, out)
    assert jobs.import_metadata(spark, {"artist": dump}, out, only="artist")["artist"]["lines"] == 3
    metadata = spark.read.parquet(os.path.join(out, "artist_metadata"))
    plays = read_segments(spark, os.path.join(out, "plays")).drop("chunk")
    kept = jobs.prep_plays(spark, plays, jobs.mapped_artists(spark, out), out, "2014-01-01", metadata)
    log = [r["value"] for r in spark.read.text(os.path.join(out, "exclusion_log.txt")).collect()]
    assert log == ["initial: 6", "duplicates: 1", "group: 1", "late: 0", "nonperson: 2", "nullgender: 0", "na: 0", "final: 2", "artists: 3", "coded_artists: 3"]
    jobs.solo_artist_counts(kept, out)
    counts = spark.read.parquet(os.path.join(out, "user_artist_counts")).collect()
    assert [(r["count"], r["first_time"], r["last_time"]) for r in counts] == [(2, 5, 9)]
    assert {r["segment"] for r in kept.collect()} == {"1d"}


def test_audit_plan_scans_plays_once(spark):
    from table_folders import SMALL_SF
    from playstats.plans.fixtures import Fixtures

    fx = Fixtures.stored(spark, SMALL_SF)
    kept, audit = clean_with_audit(fx.plays, fx.artist, "1999-01-01")
    counts = {r["step"]: r["n_rows"] for r in audit.collect()}
    assert counts["initial"] == fx.plays.count() and counts["final"] == kept.count()
    assert counts["initial"] - sum(n for s, n in counts.items() if s not in ("initial", "final")) == counts["final"]


def test_audit_of_no_plays(spark):
    kept, audit = clean_with_audit(spark.createDataFrame([], PLAYS), spark.createDataFrame([], "artist_id string, gender string, type string"))
    assert kept.count() == 0 and {r["n_rows"] for r in audit.collect()} == {0}


# -- SNK7 ----------------------------------------------------------------------------
def test_reload_replaces_and_failed_load_is_not_seen(spark, workdir):
    table = os.path.join(workdir, "table")
    rows = lambda *names: spark.createDataFrame([(n, i) for i, n in enumerate(names)], "segment string, x int")
    seen = lambda: sorted(tuple(r) for r in read_loads(spark, table).select("segment", "x").collect())
    with pytest.raises(ValueError, match="no load"):
        read_loads(spark, table)
    load_rows(rows(*NAMES), table, "a")
    load_rows(rows("1d"), table, "b")
    assert seen() == sorted([(n, i) for i, n in enumerate(NAMES)] + [("1d", 0)])
    load_rows(rows("2f"), table, "a")
    assert seen() == [("1d", 0), ("2f", 0)]
    with pytest.raises(Exception, match="stop here"):
        load_rows(rows("00").select("segment", F.raise_error(F.lit("stop here")).cast("int").alias("x")), table, "b")
    left = stage_load(rows("00", "1d"), table, ["segment"])
    assert seen() == [("1d", 0), ("2f", 0)]
    load_rows(rows(), table, "b")  # a load without rows is one too
    assert seen() == [("2f", 0)]
    assert {r["load"]: r["version"] for r in commits(spark, table).collect()} == {"a": 2, "b": 2}
    gone = vacuum(spark, table)
    assert left in gone and len(gone) >= 3 and seen() == [("2f", 0)]


# -- STR1-2 ------------------------------------------------------------------------
ARTISTS = [(U(3), "Female", "Person"), (U(4), None, "Group")]


def test_rollup_stream_takes_the_newest_delivery(spark, workdir):
    artists = spark.createDataFrame(ARTISTS, "artist_id string, gender string, type string")
    src, table, ck = (os.path.join(workdir, x) for x in ("src", "table", "ck"))
    line = "{}\t" + U(3) + "\t" + U(5) + "\t" + U(6)

    def deliver(arrival, files):
        for (segment, user), lines in files.items():
            write_lines(os.path.join(src, arrival), segment, user, lines)
        start_clean_rollup(parsed_stream(spark, src, "*/*/*.txt.zst"), artists, table, ck, "2014-01-01").awaitTermination()

    def found():
        return sorted(tuple(r) for r in read_clean_rollup(spark, table).collect())

    deliver("a", {("1d", U(1)): [line.format(5), line.format(5), line.format(9), *BAD_LINES], ("00", U(2)): [line.format(7)]})
    first = [(U(1), U(3), 2, 5, 9), (U(2), U(3), 1, 7, 7)]
    assert found() == first
    deliver("b", {("1d", U(1)): [line.format(5), line.format(9)]})  # the same user again
    assert found() == first
    assert compact_rollup(spark, table) == 1 and compact_rollup(spark, table) == 1 and found() == first
    deliver("c", {("00", U(2)): [f"7\t{U(4)}\t\t"], ("1e3", U(2)): [line.format(1)]})  # a file without clean plays any more
    assert found() == [(U(1), U(3), 2, 5, 9), (U(2), U(3), 1, 1, 1)]
    assert compact_rollup(spark, table) == 2 and found() == [(U(1), U(3), 2, 5, 9), (U(2), U(3), 1, 1, 1)]
    assert read_rejects(spark, table).count() == len(BAD_LINES)


def test_rollup_by_more_keys(spark):
    df = spark.createDataFrame([("a", 1, 2, 5), ("b", 1, 2, 6)], "segment string, user_id int, artist_id int, timestamp bigint")
    assert user_artist_rollup(df).count() == 1 and user_artist_rollup(df, ["segment"]).count() == 2
