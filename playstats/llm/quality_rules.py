"""Quality rules: a table of thresholds compiled into Spark projections.

Every metric is a Spark SQL expression over one document's text, so the
filter is a narrow transformation: no shuffle and no user functions.

Defined results: a null text counts as empty; an empty text has zero for all
counts and ratios and fails the base rule (fewer than 10 words). Repeated
rows are judged one by one. Columns other than the id and the text are not
read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from playstats.llm.common import SPACE, words_of

#: Frequent words of the four languages, matched in lower case.
STOP_WORDS = (
    "the of and to in a is that for it on was be with as by this are from at or an have not "
    "der die und das von den mit ist im zu für auf des dem nicht ein eine sich als auch "
    "de la le et les un une du que est pour dans qui par sur pas au ce avec "
    "el los las y en por con para se es del lo como su"
).split()


@dataclass(frozen=True)
class Rule:
    """A document of at least ``min_words`` words passes if ``low <= metric <= high``; None is no bound."""

    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: The threshold table. ``n_words`` and ``repeat_ratio`` are the base rules.
BASE_RULES = (Rule("n_words", 10, None), Rule("repeat_ratio", None, 0.2))
RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbol_ratio", None, 0.02),
    Rule("shout_ratio", None, 0.3),
    # short texts may well have no stop word, or one line twice
    Rule("stop_ratio", 0.02, None, min_words=40),
    Rule("dup_line_ratio", None, 0.5),
)

WINDOW = 5

#: Metrics by name, over the columns that _parts makes. Counts come first;
#: ratios are per word, per line or per code point and 0 where there are none.
COUNTS = {
    "n_words": "size(words)",
    "word_chars": "char_length(array_join(words, ''))",
    "n_symbols": "char_length(text) - char_length(regexp_replace(text, '[#*$%&|<>]+', ''))",
    "n_dup_lines": "size(lines) - size(array_distinct(lines))",
    "n_repeat_words": (
        "aggregate(starts, named_struct('last', -1, 'n', 0), (a, i) -> named_struct('last', i, 'n', "
        f"a.n + if(a.last < 0, {WINDOW}, least({WINDOW}, i - a.last))), a -> a.n)"
    ),
    "n_shout": "size(filter(words, w -> endswith(w, '!')))",
    "n_stop": "size(filter(words, w -> lower(w) IN ({stop})))",
    "n_lines": "size(lines)",
}
RATIOS = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "word_chars"),
    "shout_ratio": ("n_shout", "n_words"),
    "stop_ratio": ("n_stop", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
    "repeat_ratio": ("n_repeat_words", "n_words"),
}


def _parts(df: DataFrame, keep: list[str]) -> DataFrame:
    """Words, lines and the starts of repeated windows of each text.

    A window is known by a 64-bit hash of its words' hashes. Only texts in
    which some hash repeats are sorted; equal windows are then neighbours.
    """
    df = df.withColumn("words", words_of(F.col("text")))
    # a pattern that ends in $ would also match before a final line separator such as U+2028
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda line: F.trim(line, F.lit(SPACE)) != ""))
    df = df.withColumn("h", F.expr("transform(words, w -> xxhash64(w))"))
    inner = ", ".join(f"h[i + {k}]" for k in range(WINDOW))
    df = df.withColumn(
        "win",
        F.expr(
            f"if(size(h) < {WINDOW}, cast(array() as array<bigint>), "
            f"transform(sequence(0, greatest(size(h) - {WINDOW}, 0)), i -> xxhash64({inner})))"
        ),
    )
    df = df.withColumn(
        "placed",
        F.expr(
            "if(size(array_distinct(win)) < size(win), array_sort(transform(win, (w, i) -> struct(w, i))), "
            "cast(array() as array<struct<w: bigint, i: int>>))"
        ),
    )
    twice = "(k > 0 AND x.w = placed[greatest(k - 1, 0)].w) OR (k < size(placed) - 1 AND x.w = placed[least(k + 1, size(placed) - 1)].w)"
    df = df.withColumn(
        "starts", F.expr(f"array_sort(transform(filter(transform(placed, (x, k) -> struct(x.i, {twice} as twice)), x -> x.twice), x -> x.i))")
    )
    return df.select(*keep, "text", "words", "lines", "starts")


def _passes(rules) -> Column:
    ok = F.lit(True)
    for r in rules:
        short = F.col("n_words") < F.lit(r.min_words)
        if r.low is not None:
            ok = ok & (short | (F.col(r.metric) >= F.lit(r.low)))
        if r.high is not None:
            ok = ok & (short | (F.col(r.metric) <= F.lit(r.high)))
    return ok


def quality_metrics(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base_rules: tuple[Rule, ...] = BASE_RULES,
    rules: tuple[Rule, ...] = RULES,
    stop_words: list[str] = STOP_WORDS,
) -> DataFrame:
    """All metrics, ``base_failed`` and ``kept`` of every row, under the id's own name."""
    df = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = _parts(df, ["id"])
    stop = ", ".join("'" + w.replace("'", "\\'") + "'" for w in stop_words)
    df = df.select("id", *[F.expr(e.replace("{stop}", stop)).cast("long").alias(n) for n, e in COUNTS.items()])
    ratio = {n: F.when(F.col(w) > 0, F.col(p) / F.col(w)).otherwise(0.0).alias(n) for n, (p, w) in RATIOS.items()}
    df = df.select("*", *ratio.values())
    df = df.withColumn("base_failed", ~_passes(base_rules)).withColumn("kept", ~F.col("base_failed") & _passes(rules))
    # A generator of one row: a filter on a metric stays above it. Pushed down,
    # the condition would write out every metric anew wherever another uses it.
    return df.withColumnRenamed("id", id_col).select(F.inline(F.array(F.struct("*"))))


def quality_filter(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep.

    Row and verdict come from the same projection, so nothing is joined back
    and repeated ids are judged by their own texts.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text")
    )
    return quality_metrics(packed, "row", "text", **options).where("kept").select("row.*")
