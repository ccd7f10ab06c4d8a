"""Mixing sources to target weights: temperature, bisected, then block permutations.

1. Tokens (words) of each document and of each source are counted.
2. A source with share p gets weight ``p ** a / sum(p ** a)``. The exponent a
   in [0, 1] is bisected: the largest one whose weights' entropy reaches
   ``target_entropy`` (a part of the largest possible, log of the number of
   sources), but no smaller than the least one that repeats no source more
   than ``max_repeats`` times within the budget.
3. A weight becomes a quota of ``floor(weight * budget)`` tokens: whole copies
   of the source, and the room that they leave, less than one copy. Documents
   fall into hashed blocks; an epoch of a source is a permutation of its
   blocks, ordered by a hash of source, epoch and block, and inside a block of
   its documents, by a hash of id and epoch.
4. The room is filled in rounds. Documents that are not taken yet and would
   fit by themselves are taken in the permutation's order as long as all of
   them together fit; what is left is the room of the next round. It ends when
   no document fits any more, so a quota stays short by less than the smallest
   document that was left out.

Only DataFrame expressions are used. The sources' table is never collected:
every round of the bisection evaluates 15 exponents by one aggregation and
so halves the interval four times. A round of the filling finds one place in
the order, the first document that is too much: by sums over cells of the
blocks' hashes, then over the blocks of one cell, then over the ids of one
block, so no window runs over all blocks or documents of a source. A source
remembers the room and that place of each round; whether a document is taken
follows from these, without lists of documents.

Defined results: a null text has no tokens; documents without tokens fit any
room and are taken where their place in the order comes before the last place
of a round; a source without any tokens has no weight and is left out. A null
source is a source of its own. Rows that share an id lie in one block, one
after the other, and are taken one by one like others. With no tokens at all
the result is empty. Extra columns are passed on by ``mix_sources``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from playstats.llm.common import prepare, words_of
from playstats.llm.places import with_row
from playstats.operators.packing import running_total
from playstats.session import cut_lineage

TARGET_ENTROPY, MAX_REPEATS, BLOCK_TOKENS = 0.99, 2.0, 200_000
ROUNDS, POINTS = 9, 15


def block_of(doc_id: Column, n_blocks: int) -> Column:
    """Block of an id; the hash is one that any engine has."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(n_blocks))


def _order_key(*parts: Column) -> Column:
    return F.md5(F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def bisect_exponent(totals: DataFrame, budget: int, target_entropy: float, max_repeats: float) -> float:
    """The exponent for per-source ``tokens`` (one row a source), to 9 places."""
    span = totals.where("tokens > 0").agg(F.max("tokens").alias("top"), F.count("*").alias("n"), F.sum("tokens").alias("all")).first()
    if not span["n"]:
        return 1.0
    top, goal = float(span["top"]), target_entropy * math.log(span["n"])
    x = F.log(F.col("tokens") / F.lit(top))

    def meets(exponents: list[float], repeats: bool) -> list[bool]:
        sums = []
        for a in exponents:
            sums += [F.sum(F.exp(a * x)), F.sum(x * F.exp(a * x)), F.max(F.exp((a - 1) * x))]
        row = totals.where("tokens > 0").agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        out = []
        for i in range(len(exponents)):
            z, zx, rep = row[3 * i : 3 * i + 3]
            if repeats:
                out.append(budget / top * rep / z <= max(max_repeats, budget / span["all"]) + 1e-12)
            else:
                out.append(math.log(z) - exponents[i] * zx / z >= goal - 1e-12)
        return out

    # entropy falls with the exponent: the largest that still meets the goal, or 0 if none does
    low, high = 0.0, 1.0
    first = meets([1.0], False)[0]
    for _ in range(0 if first else ROUNDS):
        inner = [low + (high - low) * k / (POINTS + 1) for k in range(1, POINTS + 1)]
        last = sum(meets(inner, False))
        low, high = low + (high - low) * last / (POINTS + 1), low + (high - low) * (last + 1) / (POINTS + 1)
    by_entropy = 1.0 if first else low
    # repetition falls with the exponent too: the smallest that keeps the limit
    low, high = 0.0, 1.0
    if meets([by_entropy], True)[0]:
        return round(by_entropy, 9)
    for _ in range(ROUNDS):
        inner = [low + (high - low) * k / (POINTS + 1) for k in range(1, POINTS + 1)]
        over = POINTS - sum(meets(inner, True))
        low, high = low + (high - low) * over / (POINTS + 1), low + (high - low) * (over + 1) / (POINTS + 1)
    return round(max(by_entropy, high), 9)


def source_weights(totals: DataFrame, exponent: float, budget: int) -> DataFrame:
    """source, tokens, weight and quota of each source with tokens."""
    power = F.pow(F.col("tokens").cast("double"), F.lit(exponent))
    whole = totals.where("tokens > 0").agg(F.sum(power)).first()[0]
    weight = power / F.lit(whole) if whole else F.lit(0.0)
    # a millionth of a token against rounding errors: at exponent 1 a quota is all of a source
    quota = F.floor(weight * F.lit(float(budget)) + F.lit(1e-6)).cast("long")
    return totals.where("tokens > 0").select("source", "tokens", weight.alias("weight"), quota.alias("quota"))


def _source_key(source: Column) -> Column:
    """A key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def _counted(docs: DataFrame, id_col: str, source_col: str, text_col: str, kept: Column | None = None) -> DataFrame:
    """Id, source and tokens of every row, and its number ``row``; ``kept`` goes along."""
    picked = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").alias("source"),
        F.size(words_of(F.col(f"`{text_col}`"))).cast("long").alias("n_tokens"),
        *([] if kept is None else [kept.alias("kept")]),
    )
    return with_row(picked, "mixing-tokens")


#: One round of a source: its room, and the first place in the order that it does not take.
PLACE = "struct<room:bigint,bkey:string,dkey:string,row:bigint>"


def _taken(n: Column, bkey: Column, dkey: Column, row: Column, fills: Column) -> Column:
    """Whether some round takes a document: it fits the round's room and comes before the round's place."""
    return F.exists(fills, lambda f: (n <= f["room"]) & (F.struct(bkey, dkey, row) < F.struct(f["bkey"], f["dkey"], f["row"])))


def _first_too_much(rows: DataFrame, part: str, before: Column) -> DataFrame:
    """(skey, the first ``part`` whose running sum is more than the room, the sum ``before`` it, its ``rows``).

    ``rows`` has skey, room, n, ``part`` and ``before``, the sum of what comes before all of a source's rows here.
    """
    sums = rows.groupBy("skey", "room", part).agg(F.sum("n").alias("n"), F.max(before).alias("start"), F.count(F.lit(1)).alias("rows"))
    order = Window.partitionBy("skey").orderBy(part)
    upto = sums.withColumn("upto", F.col("start") + F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    found = F.min(F.struct(part, (F.col("upto") - F.col("n")).alias("before"), "rows"))
    return upto.where("upto > room").groupBy("skey").agg(found.alias("found")).select("skey", f"found.{part}", "found.before", "found.rows")


def _round(partial: DataFrame, state: DataFrame) -> DataFrame:
    """The state (skey, room, fills, open) after one more round; ``open`` if some document was still to be taken."""
    rows = partial.join(state.where("open").drop("open"), "skey")
    rows = rows.where((F.col("n") <= F.col("room")) & ~_taken(F.col("n"), F.col("bkey"), F.col("dkey"), F.col("row"), F.col("fills")))
    rows = rows.select("skey", "room", "n", F.substring("bkey", 1, 3).alias("cell"), "bkey", "dkey", "row")

    def inside(found: DataFrame, part: str) -> DataFrame:
        return rows.drop("before").join(found.select("skey", part, "before"), ["skey", part])

    cells = _first_too_much(rows, "cell", F.lit(0))
    blocks = _first_too_much(inside(cells, "cell"), "bkey", F.col("before"))
    within = inside(blocks, "bkey")
    ids = cut_lineage(_first_too_much(within, "dkey", F.col("before")).join(blocks.select("skey", "bkey"), "skey"), "mixing-places")
    alone, tied = ids.where("rows = 1").withColumn("row", F.lit(-1).cast("long")), ids.where("rows > 1")
    places = alone.select("skey", "bkey", "dkey", "row", "before")
    if tied.take(1):
        # rows of one id: placed by their numbers, which range partitions sort
        same = rows.join(tied.select("skey", "bkey", "dkey", "before"), ["skey", "bkey", "dkey"])
        placed = running_total(same.withColumnRenamed("before", "start"), "skey", "row", "n", "mixing-ties").withColumn("before", F.col("start") + F.col("before"))
        first = F.min(F.struct("row", "bkey", "dkey", "before"))
        found = placed.where("before + n > room").groupBy("skey").agg(first.alias("f"))
        places = places.unionByName(found.select("skey", "f.bkey", "f.dkey", "f.row", "f.before"))

    # a source without a place takes all that was eligible
    sums = rows.groupBy("skey").agg(F.sum("n").alias("all"))
    end = F.lit("~")  # after any hexadecimal digit
    found = sums.join(places, "skey", "left")
    after = state.join(found, "skey", "left")
    place = F.struct("room", F.coalesce("bkey", end).alias("bkey"), F.coalesce("dkey", end).alias("dkey"), F.coalesce("row", F.lit(-1)).alias("row"))
    some = F.col("all").isNotNull()
    return after.select(
        "skey",
        (F.col("room") - F.when(some, F.coalesce("before", "all")).otherwise(0)).alias("room"),
        F.when(some, F.array_append("fills", place)).otherwise(F.col("fills")).alias("fills"),
        # all eligible documents were taken, or none was there
        (some & F.col("before").isNotNull()).alias("open"),
    )


def mix_plan(
    counted: DataFrame, budget: int | None, target_entropy: float, max_repeats: float, block_tokens: int
) -> tuple[DataFrame, int]:
    """(skey, copies, fills, quota, short) of every source, and the number of blocks of a source.

    Every document of a source is taken ``copies`` times, those that ``fills``
    take once more; ``short`` is what is left of the quota.
    """
    totals = cut_lineage(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "mixing-totals")
    whole = totals.agg(F.sum("tokens")).first()[0] or 0
    budget = whole if budget is None else min(budget, int(whole * max_repeats))
    n_blocks = max(1, math.ceil(whole / block_tokens))
    exponent = bisect_exponent(totals, budget, target_entropy, max_repeats)
    quotas = source_weights(totals, exponent, budget)
    copies = F.floor(F.col("quota") / F.col("tokens"))
    quotas = quotas.select(_source_key(F.col("source")).alias("skey"), copies.alias("copies"), "quota", (F.col("quota") - copies * F.col("tokens")).alias("room"))
    quotas = cut_lineage(quotas, "mixing-quotas")

    parts = counted.select(_source_key(F.col("source")).alias("skey"), "source", "id", F.col("n_tokens").alias("n"), "row")
    partial = parts.join(quotas.where("room > 0").select("skey", F.col("copies").alias("epoch")), "skey")
    bkey, dkey = _order_keys(F.col("id"), F.col("source"), F.col("epoch"), block_of(F.col("id"), n_blocks))
    partial = cut_lineage(partial.select("skey", "n", bkey.alias("bkey"), dkey.alias("dkey"), "row"), "mixing-partial")
    state = quotas.select("skey", "room", F.array().cast(f"array<{PLACE}>").alias("fills"), (F.col("room") > 0).alias("open"))
    while True:
        state = cut_lineage(_round(partial, state), "mixing-state")
        if not state.where("open").take(1):
            break
    plan = quotas.select("skey", "copies", "quota").join(state.select("skey", "fills", F.col("room").alias("short")), "skey")
    return cut_lineage(plan, "mixing-plan"), n_blocks


def _order_keys(doc_id: Column, source: Column, epoch: Column, block: Column) -> tuple[Column, Column]:
    """What orders the documents of an epoch of a source: its block's hash, then its own."""
    return _order_key(source, epoch, block), _order_key(doc_id, epoch)


def _repeated(rows: DataFrame, plan: DataFrame, n_blocks: int) -> DataFrame:
    """``rows`` (with id, source, n_tokens and row) once for each epoch that takes them; ``epoch`` counts from 0."""
    rows = rows.withColumn("block", block_of(F.col("id"), n_blocks)).withColumn("skey", _source_key(F.col("source")))
    joined = rows.join(plan.select("skey", "copies", "fills"), "skey")
    bkey, dkey = _order_keys(F.col("id"), F.col("source"), F.col("copies"), F.col("block"))
    joined = joined.withColumn("bkey", F.when(F.size("fills") > 0, bkey)).withColumn("dkey", F.when(F.size("fills") > 0, dkey))
    once_more = _taken(F.col("n_tokens"), F.col("bkey"), F.col("dkey"), F.col("row"), F.col("fills"))
    times = F.col("copies") + F.coalesce(once_more, F.lit(False)).cast("long")
    joined = joined.withColumn("times", times).where("times > 0")
    out = joined.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    return out.drop("times", "copies", "fills", "skey", "bkey", "dkey")


def mixing_schedule(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    budget: int | None = None,
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row for each document and epoch that is taken: id, source, n_tokens, block, epoch and the block's order key.

    Reading in the order of epoch and ``block_key`` gives the mixture;
    ``budget`` is in tokens, all tokens of ``docs`` if None.
    """
    prepare(docs.sparkSession)
    counted = _counted(docs, id_col, source_col, text_col)
    plan, n_blocks = mix_plan(counted, budget, target_entropy, max_repeats, block_tokens)
    out = _repeated(counted, plan, n_blocks)
    key = _order_key(F.col("source"), F.col("epoch"), F.col("block"))
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "n_tokens", "block", "epoch", key.alias("block_key"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    budget: int | None = None,
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mixture takes it."""
    prepare(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    counted = _counted(docs, id_col, source_col, text_col, row)
    plan, n_blocks = mix_plan(counted.drop("kept"), budget, target_entropy, max_repeats, block_tokens)
    return _repeated(counted, plan, n_blocks).select("kept.*")


def mixing_report(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    budget: int | None = None,
    target_entropy: float = TARGET_ENTROPY,
    max_repeats: float = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """(source, ``tokens``, ``target``, ``realised``) of every source with tokens."""
    prepare(docs.sparkSession)
    counted = _counted(docs, id_col, source_col, text_col)
    plan, _ = mix_plan(counted, budget, target_entropy, max_repeats, block_tokens)
    totals = counted.groupBy(F.col("source").alias(source_col)).agg(F.sum("n_tokens").alias("tokens"))
    found = totals.withColumn("skey", _source_key(F.col(f"`{source_col}`"))).join(plan, "skey")
    return found.select(source_col, "tokens", F.col("quota").alias("target"), (F.col("quota") - F.col("short")).alias("realised"))
