"""Steps whose work must grow with their rows only."""

import os
import random
import tarfile
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from playstats import session
from playstats.operators import encode, recsys
from playstats.operators.packing import chunk_of_members, pack_whole
from playstats.session import apply_runtime_conf, follow_table_sizes
from playstats.sources.playfiles import ARCHIVE_GLOB, parse_plays, scan_play_files
from playstats.sources.sinks import write_play_files
from playstats.streaming import parsed_stream


def test_shuffles_begin_with_partitions_in_proportion_to_the_tables(spark, workdir):
    path, name = f"{workdir}/t.parquet", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.range(0, 3_000_000).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).limit(200_000).write.parquet(path)
    apply_runtime_conf(spark)
    try:
        follow_table_sizes(spark, [path])
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        one = int(spark.conf.get(name))
        follow_table_sizes(spark, [path] * 40)
        assert one >= least and int(spark.conf.get(name)) > max(4 * least, 10 * one // 2)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    finally:
        spark.conf.unset(name)


def test_members_find_the_chunks_of_the_rule_by_equal_keys(spark):
    rng = random.Random(3)
    sizes = spark.createDataFrame([(f"s{k}", m, rng.choice([1, 2, 40, 90])) for k in range(4) for m in range(200)], "k string, m bigint, n bigint")
    chunks = {(r["k"], r["chunk"]): (r["first"], r["last"], r["members"]) for r in pack_whole(sizes, "k", "m", "n", 50).collect()}
    found = {}
    for r in chunk_of_members(sizes, "k", "m", "n", 50).collect():
        found.setdefault((r["k"], r["chunk"]), []).append(r["m"])
    assert {c: (min(m), max(m), len(m)) for c, m in found.items()} == chunks


def test_placed_actions_are_the_placed_rows_of_windows(spark):
    rng, start = random.Random(5), "2014-01-01"
    day = datetime(2013, 11, 1)
    rows = {(u, rng.randint(1, 25)): day + timedelta(days=rng.randint(0, 700), minutes=rng.randint(0, 1)) for u in range(40) for _ in range(20)}
    rows |= {(u, 1000 + u): datetime(2015, 9, 20) for u in range(40)}  # items never trained
    prepared = spark.createDataFrame([(u, i, t) for (u, i), t in rows.items()], "user_id bigint, item_id bigint, ts timestamp").repartition(5)
    windows = recsys.eval_windows(prepared, start, 2, 6)
    in_windows = recsys.assign_windows(prepared, windows, start, 2, 6)
    labelled = recsys.label_rows(in_windows, 2)
    ranks = recsys.popularity_ranks(labelled.where("part = 'train'"))
    want = recsys.place_rows(labelled, ranks)
    got = recsys.place_actions(prepared, windows, recsys.split_days(in_windows, 2), ranks, start, 2, 6)
    assert got.columns == want.columns
    key = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert key(got) == key(want) and want.where("is_test = 1").count() > 20


def test_packed_keys_are_equal_for_equal_texts_only(spark):
    u, v = "0a1b2c3d-0000-4000-8000-00000000000a", "0a1b2c3d-0000-4000-8000-00000000000b"
    texts = [u, v, f"{u},{v}", f"{v},{u}", u.upper(), u[:-1], f"{u},", "", "a", ",", u.replace("-", ""), "#1", "é", f"{u}\n"]
    got = {r["t"]: bytes(r["p"]) for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", encode.packed_key(F.col("t")).alias("p")).collect()}
    assert len(set(got.values())) == len(texts)
    assert {t: encode._packed_value(t) for t in texts} == got
    assert len(got[u]) == 17 and len(got[f"{u},{v}"]) == 33


def test_packed_keys_unpack_to_their_texts(spark):
    u, v = "0a1b2c3d-0000-4000-8000-00000000000a", "0a1b2c3d-0000-4000-8000-00000000000b"
    texts = [u, v, f"{u},{v}", f"{v},{u},{u}", u.upper(), u[:-1], f"{u},", "", " ", "a", ",", u.replace("-", ""), "é", f"{u}\n", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", encode.unpacked_key(encode.packed_key(F.col("t"))).alias("back"))
    assert [r["back"] for r in rows.collect()] == texts


def shuffle_files(spark):
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    files = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(env.blockManager().diskBlockManager().getAllFiles())
    return {f.getName() for f in files if f.getName().startswith("shuffle_")}


def test_a_stored_stage_leaves_no_shuffle_on_disk(spark):
    before, held = shuffle_files(spark), spark.conf.get(session.DROP_SHUFFLES, None)
    stored = session.cut_lineage(spark.range(0, 50_000, 1, 4).groupBy((F.col("id") % 999).alias("k")).agg(F.count("id").alias("n")).repartition(3, "n"))
    assert not shuffle_files(spark) - before and spark.conf.get(session.DROP_SHUFFLES, None) == held
    assert stored.count() == 999


def encoding_rows(spark):
    rng = random.Random(9)
    lists = [[_uuid(1)], [_uuid(2), None], [_uuid(1), _uuid(2)], ["a,b"], ["a", "c"], [], None, ["[", ""]]
    users = [_uuid(7), _uuid(8).upper(), f" {_uuid(8)}", "odd", "", None, "unknown"]
    rows = [("0", rng.choice(users), rng.choice([None, *range(90)]), rng.choice(lists), rng.choice([_uuid(5), None]), _uuid(rng.randint(20, 60))) for _ in range(600)]
    rows += rows[:50]  # equal plays are kept
    known = {"user_id": [_uuid(7), _uuid(8), "odd"], "release_id": [_uuid(5)], "rec_id": [_uuid(i) for i in range(20, 50)], "artist_ids": [_uuid(1), "a", "a,b", "["]}
    ids = [(kind, key, 100 * n + i) for n, (kind, keys) in enumerate(known.items()) for i, key in enumerate(keys)]
    code = {(kind, key): n for kind, key, n in ids}
    find = lambda kind, key: None if key is None else code.get((kind, key.strip().lower()))
    want = [(s, find("user_id", u), t, [find("artist_ids", a) for a in x or []], find("release_id", r), find("rec_id", c)) for s, u, t, x, r, c in rows]
    return spark.createDataFrame(rows, PLAYS), spark.createDataFrame(ids, "entity_type string, entity_uuid string, id_num int"), want


@pytest.mark.parametrize("sliced", [False, True])
def test_encoding_keeps_every_play_whole_or_in_slices(spark, monkeypatch, sliced):
    plays, ids, want = encoding_rows(spark)
    monkeypatch.setattr(encode, "BROADCAST_CODES", 10)  # recordings are joined by a shuffle
    if sliced:
        monkeypatch.setattr(session, "SLICE_BYTES", 1)
        assert session.slices_of(plays) == session.MOST_SLICES
    coded = encode.encode_plays(plays, ids)
    got = list(map(tuple, coded.collect()))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    if sliced:  # the slices are stored: the last action moves no plays
        assert "Exchange" not in coded._jdf.queryExecution().executedPlan().toString()


def test_users_are_written_in_slices_to_the_same_files(spark, workdir):
    rows = [(s, _uuid(u), t, [_uuid(1), None] if t % 2 else None, _uuid(5), "x") for s in ("1d", "00") for u in range(40) for t in range(1 + u % 7)]
    plays = spark.createDataFrame([*rows, ("00", "notes", 1, None, "x", None)], PLAYS)
    found = {}
    for n in (1, 4):
        written = write_play_files(plays, f"{workdir}/{n}", 10, n)
        members = {}
        for name in os.listdir(f"{workdir}/{n}"):
            with tarfile.open(f"{workdir}/{n}/{name}") as tar:
                for m in tar.getmembers():
                    assert m.name not in members
                    members[m.name] = pa.CompressedInputStream(pa.BufferReader(tar.extractfile(m).read()), "zstd").read()
        found[n] = members
        assert {r["file"]: r["n_rows"] for r in written.collect()} == {k: v.count(b"\n") for k, v in members.items()}
    assert found[1] == found[4] and len(found[4]) == 81


def test_uuid_plays_are_not_stored_as_text(spark, workdir):
    from playstats.plans.fixtures import Fixtures, uuid_sql

    fx = Fixtures.on_demand(spark, workdir)
    keys = [(0, 1, 5, [7, None], 3, 4), (1, None, 6, None, None, 2), (2, 9, None, [], 1, None)]
    fx._cache["plays"] = spark.createDataFrame(keys, "segment int, user_id bigint, timestamp bigint, artist_ids array<bigint>, release_id bigint, rec_id bigint")
    want = fx._cache["plays"].selectExpr("segment", uuid_sql("u", "user_id"), "timestamp", f"transform(artist_ids, x -> {uuid_sql('a', 'x')})",
                                         uuid_sql("r", "release_id"), uuid_sql("c", "rec_id"))
    assert not hasattr(fx.plays_uuid, "_stage_path")
    assert sorted(map(tuple, fx.plays_uuid.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_entities_are_distinct_by_column(spark):
    rows = [("U1 ", ["a", None, " A"], "", "c"), ("u1", [], None, "u1"), (None, None, "r", "C")]
    plays = spark.createDataFrame(rows, "user_id string, artist_ids array<string>, release_id string, rec_id string")
    ents = encode.unique_entities(plays)
    assert sorted(map(tuple, ents.collect())) == [("artist_ids", "a"), ("rec_id", "c"), ("rec_id", "u1"), ("release_id", "r"), ("user_id", "u1")]
    assert "Expand" not in ents._jdf.queryExecution().optimizedPlan().toString()


PLAYS = "segment string, user_id string, timestamp bigint, artist_ids array<string>, release_id string, rec_id string"


def _uuid(i):
    return f"{i:08x}-0000-4000-8000-{i:012x}"


def _as_sets(df):
    return sorted(map(tuple, df.select("segment", "user_id", "timestamp", "artist_ids", "release_id", "rec_id", "reject").collect()), key=repr)


def test_archives_hold_whole_play_files_and_read_as_the_unpacked_tree(spark, workdir):
    rows = [(s, _uuid(u), t, [_uuid(1), _uuid(2)] if t % 2 else None, _uuid(5), _uuid(6)) for s in ("1d", "00") for u in range(30) for t in range(1 + u % 7)]
    rows += [("00", "notes", 1, None, "x", None)]
    plays = spark.createDataFrame(rows, PLAYS)
    written = write_play_files(plays, f"{workdir}/packed", 10)
    assert sum(r["n_rows"] for r in written.collect()) == len(rows) and written.count() == 61
    archives = os.listdir(f"{workdir}/packed")
    assert len(archives) > 8 and all(a.endswith(".tar") for a in archives)
    members = [m.name for a in archives for m in tarfile.open(f"{workdir}/packed/{a}").getmembers()]
    assert len(members) == len(set(members)) == 61
    write_play_files(plays, f"{workdir}/tree")
    packed = parse_plays(scan_play_files(spark, f"{workdir}/packed", ARCHIVE_GLOB))
    assert _as_sets(packed) == _as_sets(parse_plays(scan_play_files(spark, f"{workdir}/tree"))) and packed.count() == len(rows)


def test_archived_lines_parse_as_the_text_source_does(spark, workdir):
    lines = f"5\t{_uuid(3)}\t{_uuid(5)}\t{_uuid(6)}\r\nx\t\t\t\n\n \t \n1\ty\t\t\r2\t\tbad\t\n4\ttoo\tfew\n\t\t\t\n7\t\"{_uuid(3)}\"\t\"\t\n8\té\t\t".encode()
    os.makedirs(f"{workdir}/tree/1d"), os.makedirs(f"{workdir}/packed")
    for user, data in ((_uuid(1), lines), (_uuid(2), b""), (_uuid(3), b"\xef\xbb\xbf9\t\t\t\n" + b"\xff\t\t\t\n"), ("notes", b"1\t\t\t\n")):
        with open(f"{workdir}/tree/1d/{user}.txt.zst", "wb") as file:
            file.write(pa.compress(data, codec="zstd", asbytes=True))
    with tarfile.open(f"{workdir}/packed/a.tar", "w") as tar:
        tar.add(f"{workdir}/tree/1d", "1d")
    tree = parse_plays(scan_play_files(spark, f"{workdir}/tree"))
    assert _as_sets(parse_plays(scan_play_files(spark, f"{workdir}/packed", ARCHIVE_GLOB))) == _as_sets(tree)
    stream = parsed_stream(spark, f"{workdir}/packed", ARCHIVE_GLOB, 1)
    query = stream.writeStream.format("parquet").option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/ck")
    query.trigger(availableNow=True).start().awaitTermination()
    assert _as_sets(spark.read.parquet(f"{workdir}/out")) == _as_sets(tree)
