"""Incremental ingest equals the batch read (STR1-2)."""

import os
import shutil

from test_sources import write_play_tree

from playstats.sources import read_play_files
from playstats.streaming import batch_rollup, play_file_stream, read_rollup, start_ingest, start_rollup


def test_stream_ingest_and_rollup_equal_batch(spark, workdir):
    src = os.path.join(workdir, "src")
    write_play_tree(spark, src)
    # hold back one segment folder to arrive later
    later = os.path.join(workdir, "later")
    seg = sorted(os.listdir(src))[-1]
    shutil.move(os.path.join(src, seg), os.path.join(later, seg))

    out, ck = os.path.join(workdir, "out"), os.path.join(workdir, "ck")
    deltas, ck2 = os.path.join(workdir, "deltas"), os.path.join(workdir, "ck2")
    for _ in range(2):
        start_ingest(play_file_stream(spark, src), out, ck).awaitTermination()
        start_rollup(play_file_stream(spark, src), deltas, ck2).awaitTermination()
        if os.path.isdir(os.path.join(later, seg)):
            shutil.move(os.path.join(later, seg), os.path.join(src, seg))

    batch = read_play_files(spark, src)
    streamed = spark.read.parquet(out)
    cols = ["user_id", "timestamp", "release_id", "rec_id"]
    assert sorted(map(tuple, streamed.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
    merged = read_rollup(spark, deltas)
    want = batch_rollup(batch)
    key = ["user_id", "artist_id", "count", "first_time", "last_time"]
    assert sorted(map(tuple, merged.select(*key).collect()), key=repr) == sorted(
        map(tuple, want.select(*key).collect()), key=repr
    )
