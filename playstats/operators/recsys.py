"""Sliding-window evaluation of a popularity recommender (REC1-7).

The reference loops over calendar windows in Python and trains a model per
window in a process pool. Here every window is a value of a key column
``k``: each action is assigned to the (at most size/step) windows that
contain it, and training, splitting, ranking and scoring are grouped by
``k``, so all windows run in the same few shuffles.

Defaults of the evaluation toolkit the reference calls (public
documentation, not visible in its tree): items a user has in training are
not recommended; NDCG weights rank r by 1 / max(1, log2 r) and its ideal
list holds all of the user's test items; RBP uses patience 0.85 without
normalisation; reciprocal rank is 0 when nothing is hit; per-window means
include users without hits. Ties in popularity are broken by item id.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from playstats.functions import shift_days, shift_months
from playstats.session import cut_lineage
from playstats.schemas import (
    EVAL_LIST_LENGTH,
    EVAL_MIN_TEST_ROWS,
    EVAL_MIN_USER_ACTIONS,
    EVAL_MIN_WINDOW_ROWS,
    EVAL_STEP_MONTHS,
    EVAL_WINDOW_MONTHS,
    RBP_PATIENCE,
    epoch_seconds,
)


#: Item ids of one run when items are ranked, and ranks of a window that are broadcast.
ITEMS_OF_A_RUN, HEAD_RANKS = 4096, 1000
#: Actions of a task that expands them to the windows they are in, and rows of the lists that a task makes.
TASK_ACTIONS, TASK_LIST_ROWS = 150_000, 4_000_000


def _ts(day: str) -> Column:
    return F.lit(day).cast("date").cast("timestamp")


def prepare_actions(
    actions: DataFrame,
    data_from: str,
    data_to: str,
    min_actions: int = EVAL_MIN_USER_ACTIONS,
) -> DataFrame:
    """(user, item, first_time) -> (user_id, item_id, ts, rating).

    FLT9: a date string bound covers its whole day. JN13: users with at
    least ``min_actions`` actions after the date cut (one pass, not a core).
    The date cut is on the raw epoch column so it reaches the scan.
    """
    lo, hi = epoch_seconds(data_from), epoch_seconds(data_to) + 86400
    a = actions.where((F.col("first_time") >= lo) & (F.col("first_time") < hi)).select(
        F.col("user").alias("user_id"),
        F.col("item").alias("item_id"),
        F.timestamp_seconds("first_time").alias("ts"),
    )
    active = (
        a.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_actions).select("user_id")
    )
    # size of ``active`` is only known at runtime: adaptive execution picks
    # broadcast or a skew-split shuffle join from the measured size
    return a.join(active, "user_id", "left_semi").withColumn("rating", F.lit(1))


def eval_windows(
    prepared: DataFrame,
    start: str,
    step: int = EVAL_STEP_MONTHS,
    size: int = EVAL_WINDOW_MONTHS,
) -> DataFrame:
    """REC1: windows (k, window_start, window_end) with end <= the last action.

    Derived from one aggregate (the latest action), so the table has one
    row per window: its size is the data's time span over the step. Bounds
    are start + k*step months (clipped to the month's end); advancing the
    previous bound, as the reference does, gives the same windows for
    starts on day 1-28.
    """
    s = _ts(start)
    mx = prepared.agg(F.max("ts").alias("max_ts"))
    top = F.floor(F.months_between(F.col("max_ts"), s) / step).cast("int")
    ks = F.when(top >= 0, F.sequence(F.lit(0), top)).otherwise(F.array().cast("array<int>"))
    w = mx.select("max_ts", F.explode(ks).alias("k"))
    w = w.select(
        "k",
        (s + F.make_ym_interval(F.lit(0), F.col("k") * step)).alias("window_start"),
        (s + F.make_ym_interval(F.lit(0), F.col("k") * step + size)).alias("window_end"),
        "max_ts",
    )
    return w.where(F.col("window_end") <= F.col("max_ts")).drop("max_ts")


def assign_windows(
    prepared: DataFrame,
    windows: DataFrame,
    start: str,
    step: int = EVAL_STEP_MONTHS,
    size: int = EVAL_WINDOW_MONTHS,
) -> DataFrame:
    """Each action once per window containing it: ``start <= ts <= end - 1 day``
    with the upper bound at midnight (later actions on that day fall out).

    Candidate windows come from the action's month offset (an equi-join on
    ``k`` against the small window table), then the exact bounds are applied.
    """
    lo, hi = candidate_windows(start, step, size)
    cand = F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    x = prepared.withColumn("k", F.explode(cand))
    return _inside(x, windows).select("k", "user_id", "item_id", "ts")


def candidate_windows(start: str, step: int = EVAL_STEP_MONTHS, size: int = EVAL_WINDOW_MONTHS) -> tuple[Column, Column]:
    """First and last number of the windows that may contain ``ts``, by its month; none if the last is smaller."""
    d0 = datetime.strptime(start, "%Y-%m-%d")
    m = (F.year("ts") - d0.year) * 12 + (F.month("ts") - d0.month)
    lo = F.greatest(F.lit(0), F.ceil((m - size) / F.lit(float(step))).cast("int"))
    return lo, F.floor(m / F.lit(float(step))).cast("int")


def _inside(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows with a ``k`` whose window contains their ``ts``."""
    # one row per window (time span / step): structurally small;
    # window bounds stay in the window table; rows carry only its key
    bounds = windows.select("k", "window_start", shift_days(F.col("window_end"), -1).alias("last_ts"))
    return rows.join(F.broadcast(bounds), "k").where(F.col("ts").between(F.col("window_start"), F.col("last_ts"))).drop("window_start", "last_ts")


def label_rows(
    in_windows: DataFrame,
    step: int = EVAL_STEP_MONTHS,
    min_rows: int = EVAL_MIN_WINDOW_ROWS,
) -> DataFrame:
    """REC2, FLT11: temporal train/test labels per window.

    ``test_start`` = last action - ``step`` months; train is up to
    ``test_start - 1 day`` (inclusive), test from ``test_start``; actions in
    the day between belong to neither and are dropped. Windows with fewer
    than ``min_rows`` actions are dropped. Adds ``part`` = 'train' / 'test'.
    """
    return _labelled(in_windows, split_days(in_windows, step, min_rows)).select("k", "user_id", "item_id", "part")


def split_days(in_windows: DataFrame, step: int = EVAL_STEP_MONTHS, min_rows: int = EVAL_MIN_WINDOW_ROWS) -> DataFrame:
    """(k, ``test_start``) of the windows with ``min_rows`` actions or more: one row per window."""
    stats = in_windows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("max_ts"))
    return stats.where(F.col("n") >= min_rows).select("k", shift_months(F.col("max_ts"), -step).alias("test_start"))


def _labelled(in_windows: DataFrame, days: DataFrame) -> DataFrame:
    days = days.select("*", shift_days(F.col("test_start"), -1).alias("train_end"))
    wd = in_windows.join(F.broadcast(days), "k")  # one row per window
    part = F.when(F.col("ts") <= F.col("train_end"), "train").when(
        F.col("ts") >= F.col("test_start"), "test"
    )
    return wd.withColumn("part", part).where(F.col("part").isNotNull())


def popularity_ranks(train: DataFrame) -> DataFrame:
    """REC3 model: (k, item_id, cnt, pop_rank) — rank 1 is the item with the
    most training actions in window k, ties by item id.

    Items of a window are cut into runs of ids with the same count. A run is
    numbered inside, and the runs' sizes, one row a run, give each its offset,
    so no task sorts all items of a window.
    """
    pop = cut_lineage(train.groupBy("k", "item_id").agg(F.count(F.lit(1)).alias("cnt")), "popularity")  # read twice
    pop = pop.withColumn("run", F.floor(F.col("item_id") / ITEMS_OF_A_RUN))
    runs = pop.groupBy("k", "cnt", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("k").orderBy(F.desc("cnt"), "run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("k", "cnt", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("k", "cnt", "run").orderBy("item_id")
    ranked = pop.withColumn("place", F.row_number().over(inside)).join(runs, ["k", "cnt", "run"])
    return ranked.select("k", "item_id", "cnt", (F.col("offset") + F.col("place")).cast("int").alias("pop_rank"))


def place_rows(labelled: DataFrame, ranks: DataFrame) -> DataFrame:
    """Rows (k, user_id, rank, is_train, is_test) of a user in the order of
    popularity ranks, with what lies before each: ``shift``, the number of
    training items of lower rank, ``prev``, the highest of their ranks (0 if
    none), and ``nth``, the number of test rows up to here.

    A user's list skips the items seen in training, so an unseen item of rank
    r is at place r - shift: places follow from running counts over the sorted
    rows, and a user holds no list, array or set of items. Test items that were
    never trained have no rank, come last and take no place.
    """
    return _placed(labelled.join(ranks.select("k", "item_id", F.col("pop_rank").alias("rank")), ["k", "item_id"], "left"))


def _placed(rows: DataFrame) -> DataFrame:
    is_train = (F.col("part") == "train").cast("int").alias("is_train")
    is_test = (F.col("part") == "test").cast("int").alias("is_test")
    rows = rows.select("k", "user_id", "rank", is_train, is_test)
    # users first, as the sort compares by its first column; one frame for all three
    order = Window.partitionBy("user_id", "k").orderBy(F.asc_nulls_last("rank"), F.desc("is_train"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    seen = F.when(F.col("is_train") == 1, F.col("rank"))
    return rows.select(
        "*",
        F.coalesce(F.sum("is_train").over(before), F.lit(0)).cast("int").alias("shift"),
        F.coalesce(F.max(seen).over(before), F.lit(0)).alias("prev"),
        (F.coalesce(F.sum("is_test").over(before), F.lit(0)) + F.col("is_test")).alias("nth"),
    )


def tasks_for(spark: SparkSession, n_rows: int, rows_of_a_task: int) -> int:
    """Partitions of a shuffle whose rows become many more behind it; one a core at least."""
    return max(2, spark.sparkContext.defaultParallelism, -(-n_rows // rows_of_a_task))


def place_actions(prepared: DataFrame, windows: DataFrame, days: DataFrame, ranks: DataFrame, start: str,
                  step: int = EVAL_STEP_MONTHS, size: int = EVAL_WINDOW_MONTHS) -> DataFrame:
    """``place_rows`` of ``label_rows`` of ``assign_windows``, with shuffles that carry an action once.

    An action is in up to ``size / step`` windows. It gets its item's ranks in all
    of them by one join on the item, goes to its user's task, and becomes a row
    for each window there: rows of a window are neither shuffled nor stored.
    """
    n_windows, (lo, hi) = windows.count(), candidate_windows(start, step, size)
    by_window = F.map_from_entries(F.collect_list(F.struct("k", "pop_rank")))
    in_order = lambda found: F.transform(F.sequence(F.lit(0), F.lit(n_windows)), lambda k: F.try_element_at(found, k))
    lists = ranks.groupBy("item_id").agg(by_window.alias("found")).select("item_id", in_order(F.col("found")).alias("ranks"))
    none = F.array_repeat(F.lit(None).cast("int"), n_windows + 1)
    in_each = F.slice(F.coalesce("ranks", none), lo + 1, F.greatest(hi - lo + 1, F.lit(0))).alias("ranks")
    actions = prepared.select("user_id", "item_id", "ts").join(lists, "item_id", "left").select("user_id", "ts", in_each)
    actions = actions.repartition(tasks_for(prepared.sparkSession, prepared.count(), TASK_ACTIONS), "user_id")
    rows = actions.select("user_id", "ts", lo.alias("first"), F.posexplode("ranks").alias("pos", "rank"))
    rows = rows.select("user_id", "ts", "rank", (F.col("first") + F.col("pos")).alias("k"))
    return _placed(_labelled(_inside(rows, windows), days))


def _inv_log_discount(r: Column) -> Column:
    return F.lit(1.0) / F.greatest(F.lit(1.0), F.log2(r.cast("double")))


def user_scores(placed: DataFrame, n: int = EVAL_LIST_LENGTH, patience: float = RBP_PATIENCE) -> DataFrame:
    """One row per (window, user) that has training actions (JN12): ``n_train``,
    ``n_test``, ``last_seen`` (the highest rank seen), and for REC4-6 the sums
    over hits, ``ndcg``, ``rbp`` and ``reciprank``.

    A test item is hit at its place if that is at most ``n``; an item that is in
    training too has the place of a seen one and is never recommended. Test
    rows of users without training rows are dropped here, as the split requires.
    """
    test = F.col("is_test") == 1
    place = F.col("rank") - F.col("shift")
    unseen = F.col("rank") > F.col("prev")
    hit = F.when(test & unseen & (place <= n), place)
    scores = placed.groupBy("k", "user_id").agg(
        F.sum("is_train").alias("n_train"),
        F.sum("is_test").alias("n_test"),
        F.max(F.when(F.col("is_train") == 1, F.col("rank"))).alias("last_seen"),
        F.coalesce(F.sum(F.when(hit.isNotNull(), _inv_log_discount(hit))), F.lit(0.0)).alias("dcg"),
        F.sum(F.when(test, _inv_log_discount(F.col("nth")))).alias("idcg"),
        F.coalesce(F.sum(F.pow(F.lit(patience), hit - 1)), F.lit(0.0)).alias("hits"),
        F.coalesce(F.max(F.lit(1.0) / hit), F.lit(0.0)).alias("reciprank"),
    )
    return scores.where(F.col("n_train") > 0).select(
        "k", "user_id", "n_train", "n_test", "last_seen", (F.col("dcg") / F.col("idcg")).alias("ndcg"),
        ((F.lit(1.0) - F.lit(patience)) * F.col("hits")).alias("rbp"), "reciprank",
    )


def window_sizes(users: DataFrame, windows: DataFrame, min_test: int = EVAL_MIN_TEST_ROWS) -> DataFrame:
    """AGG32, FLT11: train and test rows per window; windows with fewer than
    ``min_test`` test rows are left out. One row per window."""
    sizes = (
        users.groupBy("k")
        .agg(F.sum("n_train").cast("bigint").alias("train_size"), F.sum("n_test").cast("bigint").alias("test_size"))
        .where(F.col("test_size") >= min_test)
    )
    return sizes.join(F.broadcast(windows), "k").select("k", "window_start", "window_end", "train_size", "test_size")


def free_ranges(placed: DataFrame, users: DataFrame, n: int = EVAL_LIST_LENGTH) -> DataFrame:
    """REC3 per test user: the list as ranges (k, user_id, low, high, shift) of
    popularity ranks; rank r of a range is at place r - shift.

    A range is the gap before an item seen in training, cut at place ``n``, or
    what follows the last one. A user has at most ``n`` of them, however many
    items were seen: gaps that begin beyond place ``n`` are left out.
    """
    low, wanted = F.col("prev") + 1, (F.col("n_test") > 0)
    gaps = placed.where((F.col("is_train") == 1) & (F.col("rank") > low) & (low - F.col("shift") <= n))
    gaps = gaps.select("k", "user_id", low.alias("low"), F.least(F.col("rank") - 1, F.lit(n) + F.col("shift")).alias("high"), "shift")
    gaps = gaps.join(users.where(wanted).select("k", "user_id"), ["k", "user_id"], "left_semi")
    begin = F.col("last_seen") + 1
    rest = users.where(wanted & (begin - F.col("n_train") <= n)).select(
        "k", "user_id", begin.alias("low"), (F.lit(n) + F.col("n_train")).cast("int").alias("high"), F.col("n_train").cast("int").alias("shift")
    )
    return gaps.unionByName(rest)


def recommend_top_n(ranges: DataFrame, ranks: DataFrame, head: int = HEAD_RANKS) -> DataFrame:
    """REC3: (k, user_id, item_id, rank); ranks past the window's items drop.

    Almost all lists end among a window's first ranks. Those ranks' items are
    one array a window (at most ``head`` ids), broadcast and looked up in the
    row, so the users of a window do not meet on its few popular ranks. Ranges
    that reach further are joined to the ranks.
    """
    first = ranks.where(F.col("pop_rank") <= head).groupBy("k").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pop_rank", "item_id"))), lambda x: x["item_id"]).alias("items")
    )
    near = F.col("high") <= head
    items = F.slice("items", F.col("low"), F.col("high") - F.col("low") + 1)
    place = (F.col("low") + F.col("pos") - F.col("shift")).cast("bigint").alias("rank")
    looked_up = ranges.where(near).join(F.broadcast(first), "k").select("k", "user_id", "low", "shift", F.posexplode(items).alias("pos", "item_id"))
    far = ranges.where(~near).select("k", "user_id", "low", "shift", F.posexplode(F.sequence("low", "high")).alias("pos", "pop_rank"))
    joined = far.join(ranks.select("k", "pop_rank", "item_id"), ["k", "pop_rank"])
    columns = ("k", "user_id", "item_id", place)
    return looked_up.select(*columns).unionByName(joined.select(*columns))


def evaluate(
    actions: DataFrame,
    start: str,
    data_from: str,
    data_to: str,
    n: int = EVAL_LIST_LENGTH,
    step: int = EVAL_STEP_MONTHS,
    size: int = EVAL_WINDOW_MONTHS,
) -> dict[str, DataFrame]:
    """PIPE7: the evaluation stages as DataFrames.

    Stage outputs read several times later are written to the shared
    checkpoint folder (``cut_lineage``): each is computed once, a lost
    executor re-reads it instead of recomputing from the raw actions, and
    later plans stay small.
    """
    prepared = cut_lineage(prepare_actions(actions, data_from, data_to), "actions")
    # one row per window each
    windows = cut_lineage(eval_windows(prepared, start, step, size), "windows")
    days = cut_lineage(split_days(assign_windows(prepared, windows, start, step, size), step), "split-days")
    # an item's actions meet before they become rows of windows, in four tasks, as one item may have a large share
    by_item = prepared.repartition("item_id", F.pmod(F.xxhash64("user_id"), F.lit(4)))
    labelled = _labelled(assign_windows(by_item, windows, start, step, size), days)
    # small (items x windows) and read by the rows and by the lists
    ranks = cut_lineage(popularity_ranks(labelled.where(F.col("part") == "train")), "ranks")
    placed = cut_lineage(place_actions(prepared, windows, days, ranks, start, step, size), "placed")
    # one row per (window, user): read by sizes, lists and metrics
    users = cut_lineage(user_scores(placed, n), "user_scores")
    sizes = window_sizes(users, windows)
    kept = users.join(F.broadcast(sizes.select("k")), "k", "left_semi")  # one row per window
    per_user = kept.where(F.col("n_test") > 0).select("k", "user_id", "ndcg", "rbp", "reciprank")
    ranges = free_ranges(placed, kept, n)
    # a range is up to n rows of lists: tasks are made for those
    n_lists = kept.where(F.col("n_test") > 0).count()
    ranges = ranges.repartition(tasks_for(placed.sparkSession, n_lists * n, TASK_LIST_ROWS), "k", "user_id")
    means = per_user.groupBy("k").agg(F.avg("ndcg").alias("ndcg"), F.avg("rbp").alias("rbp"), F.avg("reciprank").alias("reciprank"))
    return {
        "windows": windows,
        "sizes": sizes,
        "ranks": ranks,
        "recs": recommend_top_n(ranges, ranks),
        "per_user": per_user,
        "metrics": means.join(F.broadcast(sizes), "k"),
    }
