"""Folders of a table in whatever store Spark writes to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def files_under(spark: SparkSession, root: str) -> list[str]:
    """Names of the data files below ``root``, relative to it."""
    fs, where = file_system(spark, root)
    top, found = fs.makeQualified(where).toString().rstrip("/") + "/", []
    listed = fs.listFiles(where, True)
    while listed.hasNext():
        name = listed.next().getPath().toString()
        if not name.rpartition("/")[2].startswith(("_", ".")):
            found.append(name.removeprefix(top))
    return sorted(found)


def completed_folders(spark: SparkSession, root: str, column: str) -> list[int]:
    """Numbers n of the folders ``<root>/<column>=<n>`` that a writer has completed:
    those with a ``_SUCCESS`` file, or with one in their last part, ``whole``."""
    fs, where = file_system(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    names = [n for n in names if n.startswith(f"{column}=")]
    done = [n for n in names if any(fs.exists(path(f"{root}/{n}/{f}")) for f in ("_SUCCESS", "whole/_SUCCESS"))]
    return sorted(int(n.partition("=")[2]) for n in done)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)
