"""Parquet tables (SRC9-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """SRC9/SRC12/SRC15: a Parquet file or folder; ``columns`` selects a
    subset (Spark prunes the scan to it)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_text_partitions(spark: SparkSession, paths: str | list[str], columns: list[str], base: str | None = None) -> DataFrame:
    """Parquet folders whose partition ``columns`` are text, whatever they look
    like: without a schema Spark reads folders such as ``1d``, ``2f`` and ``00`` as
    numbers, and different names as the same value."""
    reader = spark.read.option("basePath", base) if base else spark.read
    paths = [paths] if isinstance(paths, str) else paths
    found = reader.parquet(*paths).schema
    fields = [StructField(f.name, StringType()) if f.name in columns else f for f in found.fields]
    return reader.schema(StructType(fields)).parquet(*paths)


def read_segments(spark: SparkSession, root: str) -> DataFrame:
    """SRC10/SRC11: all segments under ``root/segment=<s>/``; ``segment`` is a
    text column (partition discovery), so no per-segment loop is needed and
    filters on it prune folders."""
    return read_text_partitions(spark, root, ["segment"], root)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """SRC13/SRC14: make a DataFrame addressable by name in SQL."""
    df.createOrReplaceTempView(name)
    return df


def save_table(df: DataFrame, database: str, name: str, location: str | None = None) -> DataFrame:
    """SNK5, SRC13: ``df`` as the table ``database.name`` of the session's
    catalog, in place of one that is there, whatever its columns; read it by
    that name. A new database is made in ``location`` (the warehouse if None)."""
    spark = df.sparkSession
    if not spark.catalog.databaseExists(database):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`" + (f" LOCATION '{location}'" if location else ""))
    df.write.mode("overwrite").option("compression", "zstd").format("parquet").saveAsTable(f"`{database}`.`{name}`")
    return spark.table(f"`{database}`.`{name}`")


def drop_database(spark: SparkSession, database: str) -> None:
    """Remove a database and the tables in it."""
    spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")


def list_columns(spark: SparkSession, database: str) -> DataFrame:
    """SRC16: (table_name, column_name, data_type) of a database's tables, from the catalog."""
    rows = [
        (t.name, c.name, c.dataType)
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
        for c in spark.catalog.listColumns(f"`{database}`.`{t.name}`")
    ]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def describe(df: DataFrame) -> list[tuple[str, str]]:
    """SRC16: column names and types (schema only, no job)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def list_tables(spark: SparkSession) -> list[str]:
    """SRC16: ``SHOW TABLES``."""
    return [t.name for t in spark.catalog.listTables()]
