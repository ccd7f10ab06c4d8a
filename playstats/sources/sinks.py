"""Writers (SNK1-11). All Parquet output is zstd-compressed.

Row order inside files is not part of any result: readers sort if they need
an order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from playstats.operators.encode import packed_key, unpacked_key
from playstats.operators.packing import chunk_of_members
from playstats.schemas import ROWS_PER_FILE
from playstats.session import cut_lineage, cut_slices


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK3/SNK4/SNK5: query or dictionary to Parquet (zstd); ``overwrite``
    replaces the table (drop and recreate)."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_segmented_plays(plays: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """SNK1: plays under ``path/segment=<s>/chunk=<c>/``, one file a chunk, a
    user's rows all in one file, in (user, time) order.

    Users of a segment are packed in order; a file closes with the user that
    brings the segment's running count to the next multiple of
    ``rows_per_file`` (``packing.chunk_of_members``). Plays find their chunk by
    their user, with a join on equal keys: chunks grow in number with the plays,
    so to compare every play with every chunk of its segment is quadratic. No
    user is split, as the file of a user is the unit of the data set; a user
    with a large share of all plays is a large file of one task, which sorts
    and writes it in bounded memory.

    ``segment`` and ``user_id`` are never NULL in plays (``UUID_PLAY_SCHEMA``).
    """
    counts = plays.groupBy("segment", "user_id").agg(F.count(F.lit(1)).alias("n"))
    chunks = cut_lineage(chunk_of_members(counts, "segment", "user_id", "n", rows_per_file, "user-counts"), "play-chunks")
    (
        plays.join(chunks, ["segment", "user_id"])
        .select(*plays.columns, "chunk")
        .repartition("segment", "chunk")
        .sortWithinPartitions("segment", "chunk", "user_id", "timestamp")
        .write.mode("overwrite")
        .partitionBy("segment", "chunk")
        .option("compression", "zstd")
        .parquet(path)
    )


def write_play_files(plays: DataFrame, root: str, rows_per_archive: int = 0, slices: int = 1) -> DataFrame:
    """Plays as raw play files ``<root>/<segment>/<user>.txt.zst`` (the input
    form of SRC1); returns (file, n_rows) of the files written. With
    ``rows_per_archive`` they are members of archives ``<root>/*.tar``, as the
    reference's are; one closes with the file that brings it to that many rows.

    A file is one user's rows in time order, so a user is one task's work.
    Tasks write through Arrow's file systems, to a temporary name first: a
    repeated task replaces the file by the same bytes. A NULL or empty list is
    an empty field.

    Keys are moved packed (``encode.packed_key``). With ``slices`` the users are
    written in so many parts, one after the other, each of which moves its
    share of the plays only.
    """

    def field(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    lists = F.coalesce(F.array_join("artist_ids", ","), F.lit(""))

    def by_file(plays: DataFrame) -> DataFrame:
        keys = {"user": F.col("user_id"), "list": lists, "release": field("release_id"), "rec": field("rec_id")}
        rows = plays.select("segment", "timestamp", *[c.alias(n) for n, c in keys.items()])
        rows = rows.select("segment", "timestamp", *[packed_key(F.col(n)).alias(n) for n in keys])
        rows = rows.repartition("segment", "user").sortWithinPartitions("segment", "user", "timestamp")
        line = F.concat_ws("\t", field("timestamp"), *[unpacked_key(F.col(n)) for n in ("list", "release", "rec")])
        return rows.select(F.concat_ws("/", "segment", unpacked_key(F.col("user"))).alias("file"), line.alias("line"))

    def write(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(root)
        name, out, n = None, None, 0

        def closed():
            out.close()
            store.move(part, f"{base}/{name}.txt.zst")
            return pa.RecordBatch.from_arrays([pa.array([f"{name}.txt.zst"]), pa.array([n])], names=["file", "n_rows"])

        for batch in batches:
            for file, text in zip(batch.column("file").to_pylist(), batch.column("line").to_pylist()):
                if file != name:
                    if out:
                        yield closed()
                    store.create_dir(f"{base}/{file.rpartition('/')[0]}", recursive=True)
                    name, n, part = file, 0, f"{base}/{file.rpartition('/')[0]}/_{uuid.uuid4().hex}"
                    out = store.open_output_stream(part, compression="zstd")
                out.write(text.encode() + b"\n")
                n += 1
        if out:
            yield closed()

    def write_archives(number, batches):
        import itertools
        import tarfile
        import tempfile
        import uuid

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        store, base = fs.FileSystem.from_uri(root)
        task, archives, place = TaskContext.get().partitionId(), 0, None
        store.create_dir(base, recursive=True)

        class Kept:
            """A file that stays open when the compressor closes."""

            closed = False

            def __init__(self, file):
                self.write, self.flush, self.close = file.write, lambda: None, lambda: None

        def runs():
            """Lines of consecutive rows of a file."""
            for batch in batches:
                pairs = zip(batch.column("file").to_pylist(), batch.column("line").to_pylist())
                for file, found in itertools.groupby(pairs, lambda p: p[0]):
                    yield file, [line for _, line in found]

        done, tar, rows_held = [], None, 0
        for file, parts in itertools.groupby(runs(), lambda r: r[0]):
            if tar is None:
                # cuts follow the rows, so a repeated task replaces its archives by the same files
                part = f"{base}/_{uuid.uuid4().hex}"
                out = store.open_output_stream(part)
                tar = tarfile.open(fileobj=out, mode="w|")
            n = 0
            with tempfile.SpooledTemporaryFile(8 << 20) as member:
                text = pa.CompressedOutputStream(pa.PythonFile(Kept(member), "w"), "zstd")
                for _, lines in parts:
                    text.write(("\n".join(lines) + "\n").encode())
                    n += len(lines)
                text.close()
                entry = tarfile.TarInfo(f"{file}.txt.zst")
                entry.size = member.tell()
                member.seek(0)
                tar.addfile(entry, member)
            done.append((entry.name, n))
            rows_held += n
            if rows_held >= rows_per_archive:
                tar.close(), out.close()
                store.move(part, f"{base}/part-{number:02d}-{task:06d}-{archives:06d}.tar")
                tar, rows_held, archives = None, 0, archives + 1
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "n_rows"])
                done = []
        if tar is not None:
            tar.close(), out.close()
            store.move(part, f"{base}/part-{number:02d}-{task:06d}-{archives:06d}.tar")
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["file", "n_rows"])

    def written(plays: DataFrame, number: int) -> DataFrame:
        task = (lambda batches: write_archives(number, batches)) if rows_per_archive else write
        return by_file(plays).mapInArrow(task, "file string, n_rows bigint")

    return cut_slices(plays, F.xxhash64("segment", "user_id"), slices, written, "written-play-files")


def empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    """SNK6: an empty table with the same schema."""
    return spark.createDataFrame([], df.schema)


def append_segments(df: DataFrame, path: str, load: str, partition_col: str = "segment") -> None:
    """SNK7: incremental load, input file by input file.

    Rows land under ``segment=<s>/load=<load>/``. ``load`` names what is
    loaded (an input file): a second file of a segment adds to the first, and
    loading a file again replaces its own rows in the segments that it still
    has (``commits.load_rows`` replaces all of them). The overwrite mode is an
    option of this write, so the session's other queries keep theirs.
    """
    (
        df.withColumn("load", F.lit(load))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col, "load")
        .option("compression", "zstd")
        .parquet(path)
    )


def write_recommendations(recs: DataFrame, path: str) -> None:
    """SNK9: recommendation lists, one folder per window start."""
    recs.withColumn("window_start", F.col("window_start").cast("date")).write.mode("overwrite").partitionBy(
        "window_start"
    ).option("compression", "zstd").parquet(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    """SNK10: a small report (one row per window) as a single CSV with a
    header. Only for outputs of bounded size."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)


def audit_lines(audit: DataFrame) -> list[str]:
    """SNK8/SNK11: the audit counts as text lines with thousands separators.
    Collects the audit rows only (one per step)."""
    return [f"{r['step']}: {r['n_rows']:,}" for r in audit.collect()]


def write_audit(audit: DataFrame, path: str) -> None:
    """SNK8: audit counts as a text log (a folder with one part) next to the
    data, written by Spark, so that any store it can write to will do."""
    spark = audit.sparkSession
    lines = "\n".join(audit_lines(audit))
    spark.createDataFrame([(lines,)], "value string").coalesce(1).write.mode("overwrite").text(path)
