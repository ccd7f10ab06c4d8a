"""Spark session settings the library relies on.

Everything time-related is defined in UTC, ANSI mode stays on (Spark's
default), and adaptive execution is enabled so joins and shuffles are
re-planned from runtime sizes (skew splitting, partition coalescing).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Runtime SQL settings the queries assume. They are session settings, so they
# can be applied to a session someone else built (the driver's, a notebook's).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a task's share of a shuffle, compressed; its hash tables and sorts are several times that
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

#: Bytes of stored tables for each partition that a shuffle begins with.
TABLE_BYTES_PER_PARTITION = 2 << 20
#: Estimated bytes of rows that are moved as a whole, and slices of more rows, at most.
SLICE_BYTES, MOST_SLICES = 64 << 20, 4
#: Whether Spark deletes the shuffles of a finished action at once, not when the driver's heap is collected.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    # a listing of many files in few tasks a core, not in a task for each file
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(4 * spark.sparkContext.defaultParallelism))
    return spark


def follow_table_sizes(spark: SparkSession, paths: list[str]) -> SparkSession:
    """Let shuffles begin with partitions in proportion to the tables in ``paths``.

    Adaptive execution merges small partitions but splits none for aggregates,
    windows and sorts, so with a fixed number a task's rows would grow with the
    tables. The session's own number is the least.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf, total = spark._jsc.hadoopConfiguration(), 0
    for p in paths:
        fs = path(p).getFileSystem(conf)
        total += fs.getContentSummary(path(p)).getLength() if fs.exists(path(p)) else 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(least, total // TABLE_BYTES_PER_PARTITION)))
    return spark


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "playstats",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests, the bench and local runs.

    On a cluster, leave ``master`` unset and let spark-submit decide; the
    shuffle partition count should then follow the data size (AQE coalesces
    small partitions at runtime).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    settings = {"spark.driver.memory": "8g", **(extra or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


# Per application: the private folder made when none is configured (tests),
# and the folder already handed to the SparkContext.
_LOCAL_DIRS: dict[str, str] = {}
_ACTIVE_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is used as is. Only when it is
    unset and all tasks run in this process (local tests) is a private scratch
    folder created; on a cluster that would lose rows, so it is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="playstats-ckpt-")
            spark.sparkContext.setCheckpointDir(_LOCAL_DIRS[app])
        return _LOCAL_DIRS[app]
    if _ACTIVE_DIRS.get(spark.sparkContext.applicationId) != configured:
        spark.sparkContext.setCheckpointDir(configured)
        _ACTIVE_DIRS[spark.sparkContext.applicationId] = configured
    return configured


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder, grouped by application,
    so that a finished run's stages go in one folder."""
    app = spark.sparkContext.applicationId
    return os.path.join(ensure_checkpoint_dir(spark), "playstats-stages", app, f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, name: str = "stage", rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Used between pipeline stages whose output is read several times: it is
    computed once, a lost executor re-reads the files instead of recomputing
    the lineage, and later plans start from a plain scan. Parquet is columnar
    and compressed, unlike an RDD checkpoint's serialized rows. The shuffles
    that made it are deleted when it is written. With
    ``rows_per_file`` a task begins a new file after so many rows, so that a
    table made by few tasks can be read by many.
    """
    spark, path = df.sparkSession, stage_path(df.sparkSession, name)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    stored = spark.read.parquet(path)
    stored._stage_path = path
    return stored


def slices_of(df: DataFrame, most: int = MOST_SLICES) -> int:
    """Slices in which ``df`` is to be moved by ``cut_slices``, from the optimizer's estimate of its bytes: no job is run."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(1, min(most, estimate // SLICE_BYTES))


def cut_slices(df: DataFrame, by: Column, slices: int, step: Callable[[DataFrame, int], DataFrame], name: str) -> DataFrame:
    """``step`` of ``df``, stored slice by slice: of the rows whose ``by`` (never NULL) has the same remainder, which it is told.

    The shuffles of a slice are deleted before the next begins, so that they
    hold a share of the rows on disk, not all of them. ``df`` is read once a
    slice; ``step`` must need no rows of other slices.
    """
    parts = [cut_lineage(step(df.where(F.pmod(by, F.lit(slices)) == k) if slices > 1 else df, k), name) for k in range(slices)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def remove_stage(*stored: DataFrame) -> None:
    """Delete tables of ``cut_lineage`` that nothing will read again, in whatever store they are."""
    for df in stored:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stage_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
