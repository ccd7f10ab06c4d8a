"""Loads with a commit list (SNK7): readers take the files of committed loads only.

``<table>/data/attempt=<attempt>/`` holds the files of one attempt at a load and
never changes once written. A commit is one row of ``<table>/commits``: the load,
a version, the attempt and the names of its files. The newest version of a load
counts, so a reload replaces all rows of the load before, in whatever segments
they were, and one that fails leaves no commit and is not seen. ``vacuum``
removes attempts that no commit in force names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from playstats.sources.stores import file_system, files_under
from playstats.sources.tables import read_text_partitions

COMMIT_SCHEMA = "load string, version bigint, attempt string, n_files bigint, files array<string>"


def commits(spark: SparkSession, table: str) -> DataFrame:
    """The commit in force of every load."""
    fs, where = file_system(spark, f"{table}/commits")
    if not fs.exists(where):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    newest = Window.partitionBy("load").orderBy(F.desc("version"), F.desc("attempt"))
    rows = spark.read.schema(COMMIT_SCHEMA).json(f"{table}/commits")
    return rows.withColumn("place", F.row_number().over(newest)).where("place = 1").drop("place")


def stage_load(df: DataFrame, table: str, partition_cols: list[str]) -> str:
    """Write an attempt at a load without committing it; returns the attempt."""
    attempt = uuid.uuid4().hex
    df.write.partitionBy(*partition_cols).option("compression", "zstd").parquet(_folder(table, attempt))
    return attempt


def _folder(table: str, attempt: str) -> str:
    return f"{table}/data/attempt={attempt}"


def commit_load(spark: SparkSession, table: str, load: str, attempt: str) -> None:
    """Put an attempt in force: one small file that appears as a whole."""
    files = files_under(spark, _folder(table, attempt))
    last = commits(spark, table).where(F.col("load") == load).agg(F.max("version")).first()[0] or 0
    row = (load, last + 1, attempt, len(files), files)
    spark.createDataFrame([row], COMMIT_SCHEMA).coalesce(1).write.mode("append").json(f"{table}/commits")


def load_rows(df: DataFrame, table: str, load: str, partition_cols: tuple[str, ...] = ("segment",)) -> None:
    """SNK7: load ``df`` as ``load``, in place of all rows that an earlier load of this name brought."""
    commit_load(df.sparkSession, table, load, stage_load(df, table, list(partition_cols)))


def read_loads(spark: SparkSession, table: str, partition_cols: tuple[str, ...] = ("segment",)) -> DataFrame:
    """The rows of all loads in force, partition columns as text.

    One scan of the files that the commits name; other files in their folders
    are not read. The driver sees the files' names, as in any listing.
    """
    paths = [f"{_folder(table, c['attempt'])}/{f}" for c in commits(spark, table).collect() for f in c["files"]]
    if not paths:
        raise ValueError(f"no load of {table} is committed, or none has rows")
    return read_text_partitions(spark, paths, [*partition_cols, "attempt"], f"{table}/data").drop("attempt")


def vacuum(spark: SparkSession, table: str) -> list[str]:
    """Remove attempts that no commit in force names; returns them. Not for a table that is just being loaded."""
    kept = {c["attempt"] for c in commits(spark, table).select("attempt").collect()}
    fs, where = file_system(spark, f"{table}/data")
    gone = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().removeprefix("attempt=") not in kept]
    for path in gone:
        fs.delete(path, True)
    return sorted(p.getName().removeprefix("attempt=") for p in gone)
