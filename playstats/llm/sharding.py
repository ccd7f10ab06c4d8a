"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

1. Ring. Every shard owns ``vnodes`` points of the ring, at hashes of its
   number and the point's; a document lies at a hash of its id and belongs to
   the arc that ends at the next point clockwise. The points of a shard never
   move, so one more shard changes only the arcs that its own points cut.
2. Loads. Rows are counted by arc: shards x vnodes counts, whatever the
   input. A shard holds so many rows at most (``capacities``). In every wave,
   each arc offers the rows it has left to the shard of its end point, in the
   next wave to that of the point after, and so on clockwise; a shard takes
   offers in ring order while it has room. So its own arcs come first, and
   only rows that overflow a full shard move on.
3. Runs. What a shard takes of an arc is a run of places in the arc, by ring
   hash. Each run uses up an arc or fills a shard, so there are at most arcs +
   shards of them; that table is broadcast, and a row finds the run that holds
   its place. Places come from range partitions (``places.with_place``), so an
   arc with a third of all rows (one id many times) is no task of its own.

With ``slack`` 0 the capacities are the floor or ceiling of rows / shards and
add up to the rows: all shards fill up and counts differ by one at most. With
a slack, a shard holds (1 + slack) of the mean at most, and fewer rows leave
their arcs' shards.

Only DataFrame expressions work on rows. The driver sees the counts by arc.

Defined results: a null text has size 1 (no bytes, plus 1) and the checksum
of no bytes, 0; a null id is a key like any other, hashed as the empty text.
Rows that share an id share an arc and are told apart by size, checksum and
then their place in the table; equal rows may go to different shards if one
is full. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from playstats.llm.common import prepare
from playstats.llm.places import with_place, with_row

SHARDS, VNODES = 16, 64
#: Hexadecimal digits of an MD5 that give a position on the ring: 60 bits.
DIGITS = 15


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, clockwise."""
    at = lambda s, v: int(hashlib.md5(f"shard {s}/{v}".encode()).hexdigest()[:DIGITS], 16)
    return sorted((at(s, v), s) for s in range(shards) for v in range(vnodes))


def ring_position(key: Column) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("long")


def arc_of(position: Column, points: list[tuple[int, int]]) -> Column:
    """The number of the first point at or after ``position``, 0 beyond the last: a binary search in an array."""
    ends = F.lit(np.array([p for p, _ in points], np.int64))
    n = len(points)
    steps = F.lit(np.array([1 << b for b in reversed(range(n.bit_length()))], np.int32))
    before = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(ends, at + step - 1) < position, at + step).otherwise(at))
    return F.pmod(before, F.lit(n))


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard holds at most."""
    if slack > 0:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def deal_arcs(counts: dict[int, int], owners: list[int], room: list[int]) -> list[dict[str, int]]:
    """Runs (arc, first and last place, shard, slot of the first) that place all counted rows."""
    room, held, left = list(room), [0] * len(room), dict(sorted(counts.items()))
    if sum(left.values()) > sum(room):
        raise ValueError("the shards cannot hold all rows")
    runs, wave = [], 0
    taken = dict.fromkeys(left, 0)
    while left:
        for arc, n in left.items():
            shard = owners[(arc + wave) % len(owners)]
            n = min(n, room[shard])
            if n:
                runs.append({"arc": arc, "first": taken[arc], "last": taken[arc] + n - 1, "shard": shard, "slot": held[shard]})
                room[shard] -= n
                held[shard] += n
                taken[arc] += n
        left = {arc: counts[arc] - taken[arc] for arc in left if counts[arc] > taken[arc]}
        wave += 1
    return runs


def shard_by_ring(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    vnodes: int = VNODES,
    slack: float = 0.0,
) -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``shard``, ``slot`` in it, and ``home_shard``, its arc's own."""
    spark = prepare(docs.sparkSession)
    points = ring_points(shards, vnodes)
    owners = [s for _, s in points]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    position = ring_position(F.col(f"`{id_col}`"))
    picked = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        position.alias("position"),
    )
    keyed = with_row(picked.withColumn("arc", arc_of(F.col("position"), points)), "sharding-keys")
    counts = {r["arc"]: r["n"] for r in keyed.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = deal_arcs(counts, owners, capacities(sum(counts.values()), shards, slack))

    table = F.from_json(F.lit(json.dumps(runs)), "array<struct<arc:int,first:bigint,last:bigint,shard:int,slot:bigint>>")
    runs = spark.range(1).select(F.inline(table))
    placed = with_place(keyed, "arc", ["position", "id", "size", "text_crc32"], "sharding-places")
    # arcs + shards runs at most, see above
    out = placed.join(F.broadcast(runs), "arc").where("place BETWEEN first AND last")
    home = F.element_at(F.lit(np.array(owners, np.int32)), F.col("arc") + 1)
    return out.select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("slot") + F.col("place") - F.col("first")).alias("slot"), home.alias("home_shard")
    )
