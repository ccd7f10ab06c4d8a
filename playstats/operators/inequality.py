"""Inequality and rank statistics: Gini (AGG30), log histogram (AGG31),
fractional ranks (WIN2/WIN3), Lorenz curves (WIN4) and exact order
statistics (AGG29).

All of them need positions in sorted order. Sorting every row in one window
would put the whole table into one task, so they work on the histogram of
values instead: one row per distinct value with its frequency. The number of
items below a value (a prefix sum over sorted values) is computed in two
levels: values are cut into ranges that follow the data (quantiles of the
distinct values, from a mergeable sketch), the ranges' totals give each
range's offset, and a window inside each range adds the rest. So continuous
values, nearly all of them distinct and close together, are spread as evenly
as counts are. Results are joined back by value where rows are needed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from playstats.session import cut_lineage


DEC = "decimal(38,0)"


#: Ranges that the distinct values are cut into; each holds about as many of them.
RANGES = 1024


def _with_range(hist: DataFrame, value: str, ranges: int) -> DataFrame:
    """``hist`` with ``__b``, the number of a value's range: how many of the
    cuts lie below it, by a binary search in the sorted array of cuts.

    The cuts are approximate quantiles; their error moves rows between
    neighbouring ranges but no result. The sum over ``f`` makes the sketch read
    the same aggregate as the histogram's other reader, which Spark then
    shares between the two.
    """
    shares = F.lit(np.arange(1, ranges) / ranges)
    sketch = F.struct(F.percentile_approx(value, shares, 10 * ranges).alias("cuts"), F.sum("f").alias("n"))
    cuts = hist.agg(sketch).scalar()["cuts"]
    steps = F.lit(np.array([1 << b for b in reversed(range((ranges - 1).bit_length()))], np.int32))
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("__cuts", at + step - 1) < F.col(value), at + step).otherwise(at))
    return hist.withColumn("__cuts", cuts).withColumn("__b", below).drop("__cuts")


def value_histogram(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """(groups..., value, f): frequency of each distinct value."""
    groups = groups or []
    return df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("f"))


def with_below(hist: DataFrame, value: str, weights: list[str], groups: list[str] | None = None,
               ranges: int = RANGES) -> DataFrame:
    """Adds ``<w>_below`` (sum of weight ``w`` over smaller values of the
    group) and ``<w>_total`` (over the whole group) to a histogram with ``f``.

    Range offsets and totals come from windows over at most ``ranges`` rows
    per group; the rest is a window inside a range of a group.
    """
    groups = groups or []
    hb = _with_range(hist, value, ranges)
    totals = hb.groupBy(*groups, "__b").agg(*[F.sum(w).alias(f"__t_{w}") for w in weights])
    wb = Window.partitionBy(*groups).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*groups)
    offsets = totals.select(
        *groups,
        "__b",
        *[F.coalesce(F.sum(f"__t_{w}").over(wb), F.lit(0)).alias(f"__o_{w}") for w in weights],
        *[F.sum(f"__t_{w}").over(wall).alias(f"__a_{w}") for w in weights],
    )
    wi = Window.partitionBy(*groups, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inner = hb.select(
        "*", *[F.coalesce(F.sum(w).over(wi), F.lit(0)).alias(f"__i_{w}") for w in weights]
    )
    # groups can be NULL (e.g. unknown gender), so they are matched with <=>
    # at most ``ranges`` rows per group; sized at runtime by adaptive execution
    offsets = offsets.withColumnRenamed("__b", "__ob")
    for g in groups:
        offsets = offsets.withColumnRenamed(g, f"__og_{g}")
    cond = inner["__b"] == offsets["__ob"]
    for g in groups:
        cond = cond & inner[g].eqNullSafe(offsets[f"__og_{g}"])
    joined = inner.join(offsets, cond)
    return joined.select(
        *[c for c in hist.columns],
        *[(F.col(f"__o_{w}") + F.col(f"__i_{w}")).alias(f"{w}_below") for w in weights],
        *[F.col(f"__a_{w}").alias(f"{w}_total") for w in weights],
    )


def gini(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """Gini coefficient of ``value`` (per group): sum((2i-n-1) x_i) / (n sum x)
    with x ascending and i = 1..n.

    On the histogram a block of f equal values v that follows ``below``
    smaller items holds ranks below+1 .. below+f, so it adds
    v * (2 (f below + f (f+1)/2) - f (n+1)). For integer values the numerator
    is exact (decimal(38,0)); other values are added up as doubles. Like the
    reference, a value <= 0 is an error (C4).
    """
    groups = groups or []
    exact = isinstance(df.schema[value].dataType, IntegralType)
    number = DEC if exact else "double"
    hist = value_histogram(df, value, groups).withColumn("vf", F.col(value) * F.col("f"))
    hb = with_below(hist, value, ["f", "vf"], groups).withColumnsRenamed({"f_total": "n", "vf_total": "s"})
    f = F.col("f").cast(number)
    term = F.col(value).cast(number) * (
        F.lit(2).cast(number) * (f * F.col("f_below").cast(number)) + f * (f + F.lit(1).cast(number))
        - f * (F.col("n").cast(number) + F.lit(1).cast(number))
    )
    out = hb.groupBy(*groups).agg(
        F.sum(term).alias("num"), F.max("n").alias("n"), F.max("s").alias("s"), F.min(value).alias("lo")
    )
    g = F.col("num").cast("double") / (F.col("n").cast("double") * F.col("s").cast("double"))
    checked = F.when(F.col("lo") <= 0, F.raise_error(F.lit(f"gini: {value} must be > 0"))).otherwise(g)
    return out.select(*groups, F.col("n").alias("n_items"), checked.alias("gini"))


def fractional_rank(df: DataFrame, value: str, out: str, descending: bool = True,
                    groups: list[str] | None = None) -> DataFrame:
    """pandas ``rank(method='max', ascending=...) / n`` as a column ``out``.

    Descending, ties max: items with a value >= v, over n. Ascending, ties
    max: items with a value <= v, over n. Computed on the value histogram and
    joined back by value (and group).
    """
    groups = groups or []
    hist = value_histogram(df, value, groups)
    hb = with_below(hist, value, ["f"], groups).withColumnRenamed("f_total", "__n")
    if descending:
        r = (F.col("__n") - F.col("f_below")) / F.col("__n")
    else:
        r = (F.col("f_below") + F.col("f")) / F.col("__n")
    ranks = hb.select(*groups, F.col(value).alias("__v"), r.cast("double").alias(out))
    cond = df[value] == ranks["__v"]
    for g in groups:
        ranks = ranks.withColumnRenamed(g, f"__g_{g}")
        cond = cond & df[g].eqNullSafe(ranks[f"__g_{g}"])
    # one row per distinct value; sized at runtime by adaptive execution
    joined = df.join(ranks, cond, "left")
    return joined.drop("__v", *[f"__g_{g}" for g in groups])


def fractional_ranks(df: DataFrame, ranks: dict[str, str], descending: bool = True) -> DataFrame:
    """Several ``fractional_rank`` columns (``{out: value}``) on one table.

    ``df`` (one row per entity, computed from the plays) is read once per
    rank and once for the result, so it is written to the checkpoint folder
    first instead of being recomputed from the plays each time.
    """
    base = cut_lineage(df, "ranked") if len(ranks) > 1 else df
    out = base
    for name, value in ranks.items():
        hist = value_histogram(base, value)
        hb = with_below(hist, value, ["f"]).withColumnRenamed("f_total", "__n")
        r = (F.col("__n") - F.col("f_below")) if descending else (F.col("f_below") + F.col("f"))
        table = hb.select(F.col(value).alias("__v"), (r / F.col("__n")).cast("double").alias(name))
        # one row per distinct value; sized at runtime by adaptive execution
        out = out.join(table, out[value] == table["__v"], "left").drop("__v")
    return out


def lorenz_points(df: DataFrame, value: str, groups: list[str] | None = None) -> DataFrame:
    """WIN4: one Lorenz point per distinct value (and group).

    ``rank`` = items with a value <= v over n; ``cum_fraction`` = sum of
    values <= v over the total. These are the curve's points at the end of
    each run of ties, so no order among equal values is needed.
    """
    groups = groups or []
    hist = value_histogram(df, value, groups).withColumn("vf", F.col(value) * F.col("f"))
    hb = with_below(hist, value, ["f", "vf"], groups).withColumnsRenamed({"f_total": "__n", "vf_total": "__s"})
    return hb.select(
        *groups,
        value,
        F.col("f").alias("n_items"),
        ((F.col("f_below") + F.col("f")) / F.col("__n")).cast("double").alias("rank"),
        ((F.col("vf_below") + F.col("vf")) / F.col("__s")).cast("double").alias("cum_fraction"),
    )


def order_statistics(df: DataFrame, columns: list[str], shares: dict[str, float]) -> DataFrame:
    """(variable, n, mean, std, min, max and a column for each of ``shares``)
    of numeric columns: exact percentiles, interpolated between neighbours.

    The value at place i (from 0) is the one with ``below <= i < below + f``, so
    one aggregation over the histogram picks all percentiles; no task holds
    the values of a column. Deviations are taken from the exact mean. A column
    without values has no row.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("v")) for c in columns])
    hist = value_histogram(df.select(F.inline(pairs)), "v", ["variable"]).withColumn("vf", F.col("v") * F.col("f"))
    hb = with_below(hist, "v", ["f", "vf"], ["variable"]).withColumn("mean", F.col("vf_total") / F.col("f_total"))

    def at(place: Column) -> Column:
        here = (F.col("f_below") <= place) & (place < F.col("f_below") + F.col("f"))
        return F.max(F.when(here, F.col("v")))

    picked = []
    for name, share in shares.items():
        place = F.lit(share) * (F.col("f_total") - 1)
        low, high = at(F.floor(place)), at(F.ceil(place))
        picked.append((low + (high - low) * F.max(place - F.floor(place))).alias(name))
    squares = F.sum(F.col("f") * F.pow(F.col("v") - F.col("mean"), 2))
    n = F.max("f_total")
    return hb.groupBy("variable").agg(
        n.cast("double").alias("n"), F.max("mean").alias("mean"), F.when(n > 1, F.sqrt(squares / (n - 1))).alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"), *picked,
    )


def log_histogram(df: DataFrame, value: str, bins: int = 100) -> DataFrame:
    """AGG31: histogram of ln(value) in ``bins`` equal-width bins between the
    smallest and largest log; the last bin is closed on the right. Values
    <= 0 have no log and are left out. Every bin is returned, empty ones with
    0 users; without any value there is no bin."""
    logs = df.where(F.col(value) > 0).select(F.ln(F.col(value).cast("double")).alias("x"))
    bounds = logs.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(width > 0, F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counted = logs.select(b.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("users"))
    every = logs.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).where(lo.isNotNull())
    counted = every.join(counted, "bin", "left").withColumn("users", F.coalesce("users", F.lit(0)))
    # edges rounded to 9 places: ln may differ in the last bit between engines
    return counted.select(
        "bin",
        F.round(lo + F.col("bin") * width, 9).alias("bin_start"),
        F.round(lo + (F.col("bin") + 1) * width, 9).alias("bin_end"),
        "users",
    )
