"""Merkle manifest of a dataset: one hash tree for each group, joined by a tree of their roots.

1. Leaves. The hash of a row's fields; texts are read once and not carried on.
2. Blocks. A leaf's place in its tree comes from range partitions
   (``places.with_place``). ``fanout ** block_levels`` consecutive leaves are
   a block, the partition of the exchange; one task hashes it to its subtree
   root.
3. Butterfly exchange. In round r, blocks whose numbers differ in digit r only
   (base ``fanout``) form an aligned group of ``fanout`` blocks. They swap the
   roots of their subtrees, and each of them hashes the common ancestor for
   itself and notes the others' roots as a step of its proof. After the last
   round every block holds the tree's root and all upper steps of its proofs;
   nothing is sent down again. A tree's blocks are filled up to a power of the
   fanout by empty ones (fewer than ``fanout`` for each real one), so that
   every group is whole; an empty block learns its ancestors like any other.
   A round is one shuffle of a row for each block; a group is ``fanout`` rows.
4. The trees' roots are the leaves of the upper tree, made the same way.
5. Every block's leaves are read again beside its upper steps, and each leaf
   gets its whole proof. Proofs are neither shuffled nor stored.

A node is the hash of its children's digests, joined as hexadecimal text; a
last run of fewer children, even of one, is hashed alike. A proof is a list of
steps (``left``, ``right``): the texts of the other children before and after.

Defined results: rows of a null group form a tree of their own, the first; a
null id comes first in its tree; rows with the same id are ordered by their
leaves, equal rows are interchangeable. A field that is null enters the leaf
as ``-``. An empty table has no tree and no rows. Columns that are not named
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from playstats.llm.common import prepare
from playstats.llm.places import with_place, with_row
from playstats.session import cut_lineage, remove_stage

FANOUT, BLOCK_LEVELS = 2, 12
#: Rounds of the exchange in one job.
ROUNDS_A_JOB = 4
STEPS = "array<struct<left:string,right:string>>"


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*fields: Column) -> Column:
    return sha256_hex(F.concat(*[field_text(f) for f in fields]))


def proof_text(proof: Column) -> Column:
    """All siblings of a proof, level by level, from left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(proof, leaf, lambda h, s: sha256_hex(F.concat(s["left"], h, s["right"])))


def block_tree(leaves: list[str], fanout: int, levels: int | None = None) -> list[list[str]]:
    """The levels of a block's tree from its leaves up: ``levels`` above them, or as many as lead to one node."""
    out = [leaves]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        below = out[-1]
        out.append([hashlib.sha256("".join(below[i : i + fanout]).encode()).hexdigest() for i in range(0, len(below), fanout)])
    return out


def _block_roots(placed: DataFrame, fanout: int, block_levels: int) -> DataFrame:
    """(tree, part, root, lifted): a block's root, and the same ``block_levels`` above its leaves."""

    def roots(key, table):
        ordered = table.sort_by("place").column("leaf").to_pylist()
        own = block_tree(ordered, fanout)[-1][0]
        lifted = block_tree(ordered, fanout, block_levels)[-1][0]
        return pa.table({"tree": [key[0].as_py()], "part": [key[1].as_py()], "root": [own], "lifted": [lifted]})

    return placed.select("tree", "part", "place", "leaf").groupBy("tree", "part").applyInArrow(roots, "tree string, part bigint, root string, lifted string")


def _swap(state: DataFrame, fanout: int, done: int) -> DataFrame:
    """Round ``done`` of the exchange; trees that need no more rounds pass."""
    stride, going = fanout**done, F.col("rounds") > done
    digit = F.when(going, F.floor(F.col("part") / F.lit(stride)) % fanout).otherwise(F.lit(0)).cast("int")
    member = F.struct(F.col("digit"), "part", "real", "digest", "proof")
    groups = state.withColumn("digit", digit).groupBy("tree", "blocks", "rounds", (F.col("part") - F.col("digit") * stride).alias("group"))
    groups = groups.agg(F.array_sort(F.collect_list(member)).alias("members"))
    swapped = groups.select(
        "tree", "blocks", "rounds", F.explode("members").alias("me"), F.transform("members", lambda m: F.struct(m["digit"], m["digest"])).alias("all")
    )

    def side(wanted) -> Column:
        return F.array_join(F.transform(F.filter("all", wanted), lambda m: m["digest"]), "")

    left, right, joined = (side(lambda m: m["digit"] < F.col("me.digit")), side(lambda m: m["digit"] > F.col("me.digit")), side(lambda m: F.lit(True)))
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    # a group of empty blocks stays without a digest
    return swapped.select(
        "tree",
        "blocks",
        "rounds",
        F.col("me.part").alias("part"),
        F.col("me.real").alias("real"),
        F.when(~going, F.col("me.digest")).when(joined != "", sha256_hex(joined)).alias("digest"),
        F.when(going & F.col("me.real"), F.concat("me.proof", step)).otherwise(F.col("me.proof")).alias("proof"),
    )


def butterfly(roots: DataFrame, fanout: int = FANOUT, name: str = "merkle") -> DataFrame:
    """(tree, part, blocks, proof, digest) of every block: its upper steps and its tree's root."""
    blocks = roots.groupBy("tree").agg(F.count(F.lit(1)).alias("blocks"))
    # powers of the fanout up to more blocks than a long can number places of
    powers = [fanout**i for i in range(64) if fanout**i < 2**62]
    table = F.lit(np.array(powers, np.int64))
    blocks = blocks.withColumn("rounds", F.size(F.filter(table, lambda p: p < F.col("blocks"))))
    state = roots.join(blocks, "tree").withColumn("digest", F.when(F.col("blocks") > 1, F.col("lifted")).otherwise(F.col("root")))
    slots = F.sequence(F.col("part"), F.get(table, F.col("rounds")) - 1, F.col("blocks"))
    state = state.select("tree", "blocks", "rounds", F.explode(slots).alias("slot"), "part", "digest")
    real = F.col("slot") == F.col("part")
    state = state.select(
        "tree", "blocks", "rounds", F.col("slot").alias("part"), real.alias("real"), F.when(real, F.col("digest")).alias("digest"), F.array().cast(STEPS).alias("proof")
    )
    state = cut_lineage(state, f"{name}-blocks")
    rounds = state.agg(F.max("rounds")).first()[0] or 0
    for done in range(rounds):
        state = _swap(state, fanout, done)
        if done % ROUNDS_A_JOB == ROUNDS_A_JOB - 1:
            state = cut_lineage(state, f"{name}-round")
    return cut_lineage(state.where("real").select("tree", "part", "blocks", "proof", "digest"), f"{name}-upper")


def _with_proofs(placed: DataFrame, upper: DataFrame, carry: list[str], fanout: int, block_levels: int) -> DataFrame:
    """Each leaf of ``placed`` (its columns ``carry``) with its proof, and the columns of its block in ``upper``."""
    carried = placed.select("tree", "part", "place", "leaf", *carry)
    fields = [f for f in carried.schema.fields if f.name in ("leaf", *carry)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", subroot string, root string, proof {STEPS}"
    kind = pa.struct([("left", pa.string()), ("right", pa.string())])

    def prove(key, leaves, above):
        leaves, above = leaves.sort_by("place"), above.to_pylist()[0]
        n = leaves.num_rows
        levels = block_tree(leaves.column("leaf").to_pylist(), fanout, block_levels if above["blocks"] > 1 else None)
        lefts, rights = np.empty((n, len(levels) - 1 + len(above["proof"])), object), None
        rights = lefts.copy()
        for depth, nodes in enumerate(levels[:-1]):
            runs = [i // fanout * fanout for i in range(len(nodes))]
            left = np.array(["".join(nodes[s:i]) for i, s in enumerate(runs)], object)
            right = np.array(["".join(nodes[i + 1 : s + fanout]) for i, s in enumerate(runs)], object)
            at = np.arange(n) // fanout**depth
            lefts[:, depth], rights[:, depth] = left[at], right[at]
        for depth, step in enumerate(above["proof"], len(levels) - 1):
            lefts[:, depth], rights[:, depth] = step["left"], step["right"]
        steps = pa.StructArray.from_arrays([pa.array(lefts.ravel(), pa.string()), pa.array(rights.ravel(), pa.string())], fields=list(kind))
        ends = np.arange(n + 1, dtype=np.int32) * lefts.shape[1]
        out = {f.name: leaves.column(f.name) for f in fields}
        out |= {"subroot": pa.array([above["subroot"]] * n, pa.string()), "root": pa.array([above["root"]] * n, pa.string())}
        return pa.table(out | {"proof": pa.ListArray.from_arrays(ends, steps)})

    return carried.groupBy("tree", "part").cogroup(upper.groupBy("tree", "part")).applyInArrow(prove, schema)


def merkle_manifest(
    docs: DataFrame,
    fields: list[str],
    id_col: str = "doc_id",
    group_col: str = "lang",
    carry: dict[str, Column] | None = None,
    fanout: int = FANOUT,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """One row per input row: id, ``leaf``, ``subroot``, ``root`` and ``proof``, and what ``carry`` computes from a row.

    ``fields`` enter the leaves in this order; the rows of a group, in the
    order of ids, are the leaves of a tree, and the trees are ordered by group.
    """
    prepare(docs.sparkSession)
    carry = carry or {}
    group = F.col(f"`{group_col}`").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("tree"),
        F.col(f"`{id_col}`").alias("id"),
        leaf_hash(*[F.col(f"`{c}`") for c in fields]).alias("leaf"),
        *[c.alias(n) for n, c in carry.items()],
    )
    size = fanout**block_levels
    in_blocks = lambda placed: placed.withColumn("part", F.floor(F.col("place") / F.lit(size)))

    stored = with_row(leaves, "merkle-leaves")
    placed = in_blocks(with_place(stored, "tree", ["id", "leaf"], "merkle-places"))
    upper = butterfly(_block_roots(placed, fanout, block_levels), fanout)
    # the upper tree has one leaf for each tree
    tops = upper.where("part = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("digest").alias("leaf"))
    tops = in_blocks(with_place(with_row(tops, "merkle-tops"), "tree", ["name"], "merkle-top-places"))
    above = butterfly(_block_roots(tops, fanout, block_levels), fanout, "merkle-top")
    above = above.select("tree", "part", "blocks", "proof", F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    tops = _with_proofs(tops, above, ["name"], fanout, block_levels).select(F.col("name").alias("tree"), "root", F.col("proof").alias("upper_proof"))

    upper = upper.join(tops, "tree").select("tree", "part", "blocks", F.concat("proof", "upper_proof").alias("proof"), F.col("digest").alias("subroot"), "root")
    upper = cut_lineage(upper, "merkle-whole-upper")
    remove_stage(stored)  # the places hold the leaves too
    out = _with_proofs(placed, upper, ["id", *carry], fanout, block_levels)
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", "root", "proof", *carry)
