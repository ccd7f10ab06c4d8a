"""Places of rows in an order, without a window over all rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from playstats.session import cut_lineage


def with_row(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored, with a ``row`` number that tells equal rows apart.

    Ranges are sampled from the stored table, so its rows must not change
    from one reading to the next, as numbers made on the fly may.
    """
    return cut_lineage(df.withColumn("row", F.monotonically_increasing_id()), name)


def with_place(stored: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``stored`` (from ``with_row``) with ``place``: from 0 in each ``key`` (never null) by ``order``, then ``row``.

    Rows are sorted by range partitions and numbered inside them; a key's
    rows in one partition are a run, and the runs' lengths, a row for each
    key and partition, give the offsets. Equal rows differ in ``row``, so that
    any number of them is dealt over several partitions.
    """
    by = [key, *order, "row"]
    placed = stored.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.select("*", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part"))
    placed = cut_lineage(placed, name)
    runs = placed.groupBy(key, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(key, "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    return placed.join(runs, [key, "part"]).withColumn("place", F.col("at") + F.col("offset")).drop("at", "part", "offset")
