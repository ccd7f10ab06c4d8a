"""Raw play files (SRC1-5): one headerless TSV per user, zstd-compressed,
laid out as ``<root>/<segment>/<user uuid>.txt.zst``.

The reference walks tar archives in worker processes. An unpacked tree is
read by Spark's CSV source (zstd text is decoded by Spark's own codec); a
pattern that ends in ``.tar`` names archives of such files, which tasks walk
member by member, so that millions of play files are neither listed by the
driver nor opened one by one. Both give the same rows, with the user and
segment taken from each row's file path.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from playstats.functions import split_list
from playstats.schemas import CORRUPT, PLAY_FILE_RE, RAW_PLAY_SCHEMA, UUID_LIST_RE, UUID_RE

DEFAULT_GLOB, ARCHIVE_GLOB = "*/*.txt.zst", "*.tar"
#: Bytes of a member that are read or decoded at once, and rows that a task passes on at once.
MEMBER_BYTES, BATCH_ROWS = 4 << 20, 20_000
#: What Spark's text sources take for blank.
BLANK = "".join(map(chr, range(33)))
FILE_ENTRIES = "path string, modificationTime timestamp, length bigint, content binary"


def _as_row(df: DataFrame, **columns) -> DataFrame:
    """``df`` with ``columns``, each computed once: a generator of one row is a
    step that filters and projections above it are not merged with."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def parse_plays(raw: DataFrame) -> DataFrame:
    """SRC2-4, PRJ1, FN1-2, C2-3: raw rows (``file_path`` and the four text
    columns) as plays, each with a ``reject`` reason, NULL for a good row.

    Segment and user come from the file name, matched once; keys are
    lower-cased and must be UUIDs, a list of them is tested as one text; the
    user and the time must be known. A line that the text source could not
    parse (``corrupt_line``) is a reject of its own. Batch reads, streams and
    queries all parse with this function.
    """
    corrupt = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")
    named = _as_row(
        raw.select("timestamp", F.lower("artist_ids").alias("list"), F.lower("release_id").alias("release_id"),
                   F.lower("rec_id").alias("rec_id"), "file_path", corrupt.alias("corrupt")),
        name=F.regexp_extract("file_path", PLAY_FILE_RE, 0),
    )
    name = F.when(F.col("name") != "", F.col("name"))  # /segment/user.txt.zst
    rows = named.select(
        F.substring_index(F.substring_index(name, "/", -2), "/", 1).alias("segment"),
        F.substring_index(F.substring_index(name, "/", -1), ".", 1).alias("user_id"),
        "timestamp", "list", "release_id", "rec_id", "file_path", "corrupt",
    )
    bad = lambda c, pattern=UUID_RE: F.col(c).isNotNull() & ~F.col(c).rlike(pattern)
    reject = (
        F.when(F.col("user_id").isNull(), "file_name")
        .when(bad("user_id"), "user_id")
        .when(F.col("corrupt").isNotNull(), "line")
        .when(F.col("timestamp").isNull(), "timestamp")
        .when(bad("list", UUID_LIST_RE), "artist_ids")
        .when(bad("release_id"), "release_id")
        .when(bad("rec_id"), "rec_id")
    )
    return _as_row(rows, reject=reject).select(
        "segment", "user_id", "timestamp", split_list("list").alias("artist_ids"), "release_id", "rec_id", "file_path", "reject"
    )


def play_file_options() -> dict[str, str]:
    return {"sep": "\t", "header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


#: Types are fixed; a line that does not parse is kept as text.
PLAY_FILE_SCHEMA = StructType([*RAW_PLAY_SCHEMA.fields, StructField(CORRUPT, StringType())])


def folders_and_names(root: str, pattern: str) -> tuple[str, str]:
    """A pattern of files as one of folders and one of names: Spark then lists
    the folders it matches, not every file by itself."""
    folders, _, names = pattern.rpartition("/")
    return os.path.join(root, folders), names


def is_archive(pattern: str) -> bool:
    return pattern.endswith(".tar")


def archived_rows(archives: DataFrame) -> DataFrame:
    """SRC1 for archives (``path``, a batch or a stream): what the CSV source gives for their unpacked files."""

    def member_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines of the play files in archives, each with the archive's path and the member's name."""
        import tarfile

        import numpy as np
        from pyarrow import fs

        paths, counts, lines = [], [], []

        def rows() -> pa.RecordBatch:
            files = pa.array(paths, pa.string()).take(pa.array(np.repeat(np.arange(len(paths)), counts)))
            out = pa.RecordBatch.from_arrays([files, pa.array(lines, pa.string())], names=["file_path", "line"])
            paths.clear(), counts.clear(), lines.clear()
            return out

        def pieces(tar, member) -> Iterator[bytes]:
            """Decoded text, cut behind line ends."""
            raw, rest = tar.extractfile(member), b""
            if not member.size:
                return
            with pa.CompressedInputStream(pa.BufferReader(raw.read()) if member.size <= MEMBER_BYTES else pa.PythonFile(raw, "r"), "zstd") as text:
                while piece := text.read(MEMBER_BYTES):
                    whole, end, rest = (rest + piece).rpartition(b"\n")
                    yield whole + end
            yield rest

        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, place = (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if path.startswith("file:") else fs.FileSystem.from_uri(path)
                with store.open_input_stream(place) as stream, tarfile.open(fileobj=stream, mode="r|") as tar:
                    for member in tar:
                        name = member.name.rpartition("/")[2]
                        if not member.isfile() or name.startswith(("_", ".")) or not name.endswith(".txt.zst"):
                            continue
                        first = True
                        for piece in pieces(tar, member):
                            text = piece.removeprefix(b"\xef\xbb\xbf") if first else piece
                            text, first = text.replace(b"\r\n", b"\n").replace(b"\r", b"\n").decode("utf-8", "replace"), False
                            found = [x for x in text.split("\n") if x.strip(BLANK)]
                            paths.append(f"{path}/{member.name}")
                            counts.append(len(found))
                            lines += found
                            if len(lines) >= BATCH_ROWS:
                                yield rows()
        if lines:
            yield rows()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PLAY_FILE_SCHEMA.fields)
    lines = archives.select("path").mapInArrow(member_lines, "file_path string, line string")
    return lines.select(F.from_csv("line", schema, play_file_options()).alias("row"), "file_path").select("row.*", "file_path")


def scan_play_files(spark: SparkSession, root: str, pattern: str = DEFAULT_GLOB) -> DataFrame:
    """SRC1, SRC5: raw rows of every play file with their ``file_path``. A
    line of white space only is no row. Archives are listed, not read, by Spark."""
    folders, names = folders_and_names(root, pattern)
    if is_archive(pattern):
        return archived_rows(spark.read.format("binaryFile").option("pathGlobFilter", names).load(folders))
    raw = spark.read.schema(PLAY_FILE_SCHEMA).options(**play_file_options(), pathGlobFilter=names).csv(folders)
    return raw.select("*", F.col("_metadata.file_path").alias("file_path"))


def read_play_files(spark: SparkSession, root: str, pattern: str = DEFAULT_GLOB) -> DataFrame:
    """SRC1-4 + PRJ1: staging plays (segment, user_id, timestamp, artist_ids
    array, release_id, rec_id). Files whose name is not ``<hex>/<uuid>.txt.zst``
    are skipped (see ``rejected_files``); other rejects are left to the load
    (``require_no_rejects``)."""
    rows = parse_plays(scan_play_files(spark, root, pattern))
    return rows.where(F.col("user_id").isNotNull()).drop("reject", "file_path")


def reject_counts(parsed: DataFrame) -> DataFrame:
    """(reject, n_rows) of parsed rows that are not good."""
    return parsed.where(F.col("reject").isNotNull()).groupBy("reject").agg(F.count(F.lit(1)).alias("n_rows"))


def split_rejects(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plays that load, and the rows that do not with file and reason."""
    good = parsed.where(F.col("reject").isNull()).drop("reject", "file_path")
    bad = parsed.where(F.col("reject").isNotNull()).select("file_path", "reject", "user_id", "timestamp", "artist_ids", "release_id", "rec_id")
    return good, bad


def require_no_rejects(parsed: DataFrame) -> None:
    """C2/C3 as a hard check: a row with a bad key aborts the load; rows of
    skipped files do not count."""
    found = {r["reject"]: r["n_rows"] for r in reject_counts(parsed).collect() if r["reject"] != "file_name"}
    if found:
        raise ValueError(f"rows that cannot be loaded: {found}")


def rejected_files(spark: SparkSession, root: str, pattern: str = "*/*") -> DataFrame:
    """SRC4: (file_path) of files under ``root`` whose names do not follow
    the play-file pattern, as an audit of what ``read_play_files`` skips."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "false")
        .load(os.path.join(root, pattern))
        .select(F.col("path").alias("file_path"))
    )
    return files.where(F.regexp_extract("file_path", PLAY_FILE_RE, 0) == "")
