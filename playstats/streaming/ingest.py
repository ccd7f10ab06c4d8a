"""Incremental play ingest with Structured Streaming (STR1-2).

The reference imports archives in batches and appends file by file. Here
new play files are picked up by a file-stream source; ``availableNow``
processes what has arrived and stops, so the same job serves backfills and
scheduled increments. Progress lives in the checkpoint folder: a restarted
or failed run continues where it stopped, without duplicates.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from playstats.functions import first_element
from playstats.operators.clean import clean_plays
from playstats.operators.rollups import user_artist_rollup
from playstats.schemas import DEFAULT_LATE_CUT
from playstats.sources.playfiles import (
    DEFAULT_GLOB,
    FILE_ENTRIES,
    PLAY_FILE_SCHEMA,
    archived_rows,
    folders_and_names,
    is_archive,
    parse_plays,
    play_file_options,
    split_rejects,
)
from playstats.sources.stores import completed_folders, remove_folder


def parsed_stream(spark: SparkSession, root: str, pattern: str = DEFAULT_GLOB,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """STR1 source: rows of files as they arrive, parsed as the batch read
    does, with ``file_path`` and ``reject``. The driver holds an entry for each
    file that has arrived, so many play files are to arrive in archives."""
    folders, names = folders_and_names(root, pattern)
    reader = spark.readStream.option("pathGlobFilter", names)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_archive(pattern):
        return parse_plays(archived_rows(reader.schema(FILE_ENTRIES).format("binaryFile").load(folders)))
    reader = reader.schema(PLAY_FILE_SCHEMA).options(**play_file_options())
    raw = reader.csv(folders)
    return parse_plays(raw.select("*", F.col("_metadata.file_path").alias("file_path")))


def play_file_stream(spark: SparkSession, root: str, pattern: str = DEFAULT_GLOB,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Staging plays from files as they arrive: the rows that load (same
    columns as ``read_play_files``)."""
    return split_rejects(parsed_stream(spark, root, pattern, max_files_per_trigger))[0]


def _started(writer, available_now: bool) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def start_ingest(stream: DataFrame, out_path: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """STR1 sink: append to Parquet partitioned by segment. The file sink
    keeps a log of committed files, so each input file lands exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", out_path)
        .option("checkpointLocation", checkpoint)
        .option("compression", "zstd")
        .partitionBy("segment")
        .outputMode("append")
    )
    return _started(writer, available_now)


def start_rejects(parsed: DataFrame, out_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """C2-3 for streams: rows that do not load, with file and reason, to a table of their own."""
    bad = split_rejects(parsed)[1]
    writer = bad.writeStream.format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
    return _started(writer.option("compression", "zstd").outputMode("append"), available_now)


def batch_rollup(plays: DataFrame) -> DataFrame:
    """Per-batch (user, first artist) rollup: count, first and last time."""
    return (
        plays.select("user_id", first_element("artist_ids").alias("artist_id"), "timestamp")
        .groupBy("user_id", "artist_id")
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.min("timestamp").alias("first_time"),
            F.max("timestamp").alias("last_time"),
        )
    )


def start_rollup(stream: DataFrame, deltas_path: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """STR2 over staging plays: incremental user-artist rollup.

    Every micro-batch writes its partial rollup to ``batch_id=<id>``,
    replacing that folder, so a retried batch does not double count. The
    rollup is count/min/max, which merge exactly (``read_rollup``); no state
    store has to hold every (user, artist) pair.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch_rollup(batch).write.mode("overwrite").option("compression", "zstd").parquet(
            os.path.join(deltas_path, f"batch_id={batch_id}")
        )

    return _started(stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), available_now)


def read_rollup(spark: SparkSession, deltas_path: str) -> DataFrame:
    """Merge the partial rollups into (user_id, artist_id, count, first_time, last_time)."""
    return _merged(spark.read.parquet(deltas_path))


def _merged(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("user_id", "artist_id").agg(
        F.sum("count").cast("bigint").alias("count"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
    )


# -- STR2 over clean plays, keyed by play file -----------------------------------
DELTA_SCHEMA = "segment string, user_id string, artist_id string, count bigint, first_time bigint, last_time bigint"
FILE_SCHEMA = "segment string, user_id string"


def start_clean_rollup(parsed: DataFrame, artists: DataFrame, table: str, checkpoint: str,
                       late_cut: str = DEFAULT_LATE_CUT, available_now: bool = True) -> StreamingQuery:
    """STR2: the rollup of clean plays (AGG2 after PIPE1), play file by play file.

    ``parsed`` is a ``parsed_stream``, ``artists`` the dimension with the
    files' artist keys. A play file (segment and user) is the unit: its rows
    arrive together, so exact duplicates meet in one micro-batch, and the
    newest delivery of a file stands for all before it. Every micro-batch
    writes three folders named by its id, each replaced if the batch is tried
    again: the rollup of its clean plays by file (``deltas``), the files that it
    held (``files``, so that a file which lost all its clean plays drops its old
    ones too), and the rows that do not load (``rejects``).
    """

    def write(df: DataFrame, kind: str, batch_id: int) -> None:
        path = os.path.join(table, kind, f"batch_id={batch_id}")
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read three times
        try:
            good, bad = split_rejects(batch)
            write(bad, "rejects", batch_id)
            write(batch.where("user_id IS NOT NULL").select("segment", "user_id").distinct(), "files", batch_id)
            kept = clean_plays(good, artists, late_cut, keep_segment=True)
            write(user_artist_rollup(kept, ["segment"]), "deltas", batch_id)
        finally:
            batch.unpersist()

    return _started(parsed.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint), available_now)


def _newest(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame, int]:
    """Deltas and files in force (each with ``batch_id``), and the last batch."""
    bases = completed_folders(spark, os.path.join(table, "base"), "upto")
    upto = max(bases, default=-1)
    batches = [b for b in completed_folders(spark, os.path.join(table, "deltas"), "batch_id") if b > upto]

    def rows(kind: str, schema: str) -> DataFrame:
        paths = [os.path.join(table, kind, f"batch_id={b}") for b in batches]
        columns = schema + ", batch_id bigint"
        new = spark.read.schema(columns).option("basePath", os.path.join(table, kind)).parquet(*paths) if paths else spark.createDataFrame([], columns)
        if upto < 0:
            return new
        return new.unionByName(spark.read.schema(columns).parquet(os.path.join(table, "base", f"upto={upto}", kind)))

    files = rows("files", FILE_SCHEMA).groupBy("segment", "user_id").agg(F.max("batch_id").alias("batch_id"))
    deltas = rows("deltas", DELTA_SCHEMA).join(files, ["segment", "user_id", "batch_id"], "left_semi")
    return deltas, files, max([upto, *batches])


def read_clean_rollup(spark: SparkSession, table: str) -> DataFrame:
    """(user_id, artist_id, count, first_time, last_time) of the newest delivery of every play file."""
    return _merged(_newest(spark, table)[0])


def read_rejects(spark: SparkSession, table: str) -> DataFrame:
    """All rows that did not load, with the batch that brought them."""
    return spark.read.parquet(os.path.join(table, "rejects"))


def compact_rollup(spark: SparkSession, table: str) -> int:
    """Merge all batches so far into one base, sorted by file; returns the last batch in it.

    The base is complete once its marker file exists, which is written last;
    until then readers use the base before. Merged batches and the older base
    are removed afterwards. Not while a reader of the older base still runs.
    """
    deltas, files, last = _newest(spark, table)
    old = completed_folders(spark, os.path.join(table, "base"), "upto")
    if last < 0 or last in old:
        return last
    base = os.path.join(table, "base", f"upto={last}")
    for kind, df in (("deltas", deltas), ("files", files)):
        df.repartitionByRange("segment", "user_id").sortWithinPartitions("segment", "user_id").write.mode("overwrite").option(
            "compression", "zstd"
        ).parquet(os.path.join(base, kind))
    spark.range(1).write.mode("overwrite").parquet(os.path.join(base, "whole"))
    for kind in ("deltas", "files"):
        for b in completed_folders(spark, os.path.join(table, kind), "batch_id"):
            if b <= last:
                remove_folder(spark, os.path.join(table, kind, f"batch_id={b}"))
    for b in old:
        remove_folder(spark, os.path.join(table, "base", f"upto={b}"))
    return last
