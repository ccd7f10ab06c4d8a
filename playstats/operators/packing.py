"""Packing of whole groups into files of about a size (SNK1), without a window over all groups of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from playstats.session import cut_lineage


def running_total(sizes: DataFrame, key: str, member: str, size: str, name: str = "sizes") -> DataFrame:
    """``sizes`` (a row for each member of a key) with ``before``: the sum of ``size`` of the key's smaller members.

    Members are sorted by range partitions. A window sums inside a partition
    only; the partitions' totals, a row for each key and partition, give what
    lies before them.
    """
    stored = cut_lineage(sizes, name)  # range bounds are sampled from it
    placed = stored.repartitionByRange(key, member).select("*", F.spark_partition_id().alias("part"))
    placed = cut_lineage(placed, f"{name}-placed")
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(key, "part").agg(F.sum(size).alias("total"))
    totals = F.broadcast(totals.select(key, "part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset")))
    same = F.col(f"here.{key}").eqNullSafe(F.col(f"there.{key}")) & (F.col("here.part") == F.col("there.part"))
    joined = placed.alias("here").join(totals.alias("there"), same).select("here.*", "there.offset")
    inside = Window.partitionBy(key, "part").orderBy(member).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("offset") + F.coalesce(F.sum(size).over(inside), F.lit(0))
    return joined.withColumn("before", before.cast("long")).drop("part", "offset")


def chunk_of_members(sizes: DataFrame, key: str, member: str, size: str, limit: int, name: str = "packing") -> DataFrame:
    """(key, member, ``chunk``): the chunk of every member, by the rule and with the numbers of ``pack_whole``."""
    placed = running_total(sizes, key, member, size, name)
    slotted = cut_lineage(placed.select(key, member, F.floor(F.col("before") / F.lit(limit)).alias("slot")), f"{name}-slots")
    number = F.row_number().over(Window.partitionBy(key).orderBy("slot"))
    chunks = slotted.select(key, "slot").distinct().withColumn("chunk", number)
    return slotted.join(chunks, [key, "slot"]).select(key, member, "chunk")


def pack_whole(sizes: DataFrame, key: str, member: str, size: str, limit: int, name: str = "packing") -> DataFrame:
    """Chunks of whole members: (key, ``chunk`` from 1, ``first`` and ``last`` member, ``members``, ``rows``).

    Members come in order; a chunk closes with the member that brings the
    key's running count to the next multiple of ``limit``. So the first chunk
    holds ``limit`` rows or just above, no chunk holds more than ``limit`` rows
    beside its last member's, and the mean is ``limit``.
    """
    placed = running_total(sizes, key, member, size, name)
    chunks = placed.groupBy(key, F.floor(F.col("before") / F.lit(limit)).alias("slot")).agg(
        F.min(member).alias("first"), F.max(member).alias("last"), F.count(F.lit(1)).alias("members"), F.sum(size).cast("long").alias("rows")
    )
    # a member larger than the limit leaves slots without a chunk; a row here is a file
    number = F.row_number().over(Window.partitionBy(key).orderBy("slot"))
    return chunks.select(key, number.alias("chunk"), "first", "last", "members", "rows")
