"""Quality classifier: regularised quadratic discriminant on document statistics.

Every text becomes a vector of transformed statistics, in Arrow batches. For
each class the labelled rows give a count, a sum and a sum of outer products,
which Spark adds up; only these sums, of fixed size, reach the driver. A
class covariance is shrunk twice:

    S_k = (1 - a) * cov_k + a * pooled,  then  (1 - b) * S_k + b * mean(diag S_k) * I

and its Cholesky factor is computed once. A document's score is the logistic
function of the difference of the two classes' log densities,

    -1/2 * |L_k^-1 (x - m_k)|^2 - sum(log(diag L_k)) + log(prior_k),

divided by ``temperature``.

All labelled rows are learned from; no sample is taken. Inputs of a score are
statistics of the text alone.

Defined results: a null text counts as empty; an empty text has the vector of
an empty document and a score like any other. A label row counts once for
each document row with its id; labels that disagree count as they are. If a
class has no labelled row, the other class's prior alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from playstats.llm.common import flat_words, prepare, released, slices, text_column, word_codes
from playstats.session import cut_lineage

FEATURES = (
    "log_words", "log_mean_word", "word_length_spread", "distinct_words", "symbol_chars", "upper_letters", "other_chars",
    "shout_words", "digit_chars", "repeat_neighbours", "repeat_bigrams", "dup_lines", "log_line_words", "top_word", "frequent_words",
)
#: Shrinkage towards the pooled covariance and towards a multiple of the identity, and the score's temperature.
TO_POOLED, TO_IDENTITY, TEMPERATURE = 0.1, 0.02, 4.0
THRESHOLD = 0.3
#: Short function words of several languages.
FREQUENT = "the of and to in a is that for on was be with der die und das von zu de la le et les des el los y en que un une".split()


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A share in [0, 1] on a square-root scale, 0 where there is nothing to share."""
    return np.sqrt(np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0))


def _count(texts: pa.Array, pattern: str) -> np.ndarray:
    return pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(float)


def _distinct(rows: np.ndarray, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the number of distinct codes and the count of the most frequent one."""
    if not len(rows):
        return np.zeros(n), np.zeros(n)
    pairs = np.sort(rows.astype(np.int64) << 40 | codes)
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    runs, owner = np.diff(first, append=len(pairs)), pairs[first] >> 40
    top = np.zeros(n)
    np.maximum.at(top, owner, runs)
    return np.bincount(owner, minlength=n).astype(float), top


def features(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text."""
    n = len(texts)
    words, rows = flat_words(texts)
    codes, distinct_words = word_codes(words)
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(float)
    n_words = np.bincount(rows, minlength=n).astype(float)
    chars = np.bincount(rows, lengths, n)
    mean = np.divide(chars, n_words, out=np.zeros(n), where=n_words > 0)
    square = np.bincount(rows, lengths**2, n)
    spread = np.sqrt(np.maximum(np.divide(square, n_words, out=np.zeros(n), where=n_words > 0) - mean**2, 0))
    distinct, top = _distinct(rows, codes, n)
    same = rows[1:] == rows[:-1]
    neighbours = np.bincount(rows[1:][same & (codes[1:] == codes[:-1])], minlength=n)
    # a bigram of a batch by its two codes; the batch bounds both
    grams = (codes[:-1] * max(len(distinct_words), 1) + codes[1:])[same]
    _, gram_codes = np.unique(grams, return_inverse=True)
    n_grams = np.maximum(n_words - 1, 0)
    distinct_grams, _ = _distinct(rows[1:][same], gram_codes, n)
    shout = pc.ends_with(distinct_words, "!").to_numpy(zero_copy_only=False)
    known = pc.is_in(pc.ascii_lower(distinct_words), pa.array(FREQUENT, distinct_words.type)).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(texts, "\n")
    lines, line_rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]")
    line_codes, _ = word_codes(pc.filter(lines, full))
    line_rows = pc.filter(line_rows, full).to_numpy(zero_copy_only=False)
    n_lines = np.bincount(line_rows, minlength=n).astype(float)
    distinct_lines, _ = _distinct(line_rows, line_codes, n)
    columns = (
        np.log1p(n_words),
        np.log1p(mean),
        np.log1p(spread),
        _share(distinct, n_words),
        _share(_count(texts, r"[#*$%&|<>@^~_=+{}\[\]\\]"), chars),
        _share(_count(texts, r"\p{Lu}"), chars),
        _share(_count(texts, r"[^\p{L}\s]"), chars),
        _share(np.bincount(rows, shout[codes] if len(codes) else None, n), n_words),
        _share(_count(texts, r"[0-9]"), chars),
        _share(neighbours, n_words),
        _share(np.maximum(n_grams - distinct_grams, 0), n_grams),
        _share(n_lines - distinct_lines, n_lines),
        np.log1p(np.divide(n_words, n_lines, out=np.zeros(n), where=n_lines > 0)),
        _share(top, n_words),
        _share(np.bincount(rows, known[codes] if len(codes) else None, n), n_words),
    )
    return np.stack(columns, axis=1)


@dataclass(frozen=True)
class QuadraticDiscriminant:
    """Means, inverse Cholesky factors and constants of the two classes; class 1 is the good one."""

    means: np.ndarray
    whiten: np.ndarray
    constants: np.ndarray
    temperature: float = TEMPERATURE

    @classmethod
    def fit(cls, counts, sums, products, to_pooled=TO_POOLED, to_identity=TO_IDENTITY, temperature=TEMPERATURE) -> "QuadraticDiscriminant":
        """From each class's count, sum of vectors and sum of outer products."""
        d = len(sums[0])
        means = [s / max(n, 1) for n, s in zip(counts, sums, strict=True)]
        scatter = [p - n * np.outer(m, m) for n, p, m in zip(counts, products, means, strict=True)]
        pooled = sum(scatter) / max(sum(counts) - 2, 1)
        whiten, constants = [], []
        for n, s in zip(counts, scatter, strict=True):
            shrunk = (1 - to_pooled) * s / max(n - 1, 1) + to_pooled * pooled
            level = np.trace(shrunk) / d or 1.0
            shrunk = (1 - to_identity) * shrunk + to_identity * level * np.eye(d)
            factor = np.linalg.cholesky(shrunk)
            whiten.append(np.linalg.inv(factor))
            constants.append(np.log((n + 1) / (sum(counts) + 2)) - np.log(np.diag(factor)).sum())
        if min(counts) == 0:  # nothing is known of one class's density
            whiten, constants = [np.zeros((d, d))] * 2, [np.log((n + 1) / (sum(counts) + 2)) for n in counts]
        return cls(np.array(means), np.array(whiten), np.array(constants), temperature)

    def score(self, x: np.ndarray) -> np.ndarray:
        density = [c - 0.5 * (((x - m) @ w.T) ** 2).sum(axis=1) for m, w, c in zip(self.means, self.whiten, self.constants, strict=True)]
        return 1 / (1 + np.exp(np.clip((density[0] - density[1]) / self.temperature, -700, 700)))


def document_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x): the vector of every row, in a stored table."""
    prepare(docs.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                x = features(text_column(part, "text"))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], names=["id", "x"])

    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return cut_lineage(plain.mapInArrow(released(measure), "id bigint, x array<double>"), "quality-features")


def fit_classifier(measured: DataFrame, labels: DataFrame, **options) -> QuadraticDiscriminant:
    """Fit on ``labels`` (``id``, ``label`` 0 or 1); each task sends one row of sums for each class."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            x = np.array(batch.column("x").to_pylist(), float).reshape(len(label), -1)
            for k in (0, 1):
                own = x[label == k]
                if len(own):
                    new = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
                    sums[k] = sums.get(k, 0) + new
        for k, values in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([values.tolist()])], names=["label", "sums"])

    labelled = measured.join(labels, "id").select("label", "x").where("label in (0, 1)")
    parts = labelled.mapInArrow(add_up, "label int, sums array<double>")
    # summed by place in Spark, so that the driver gets one row for each class and place
    placed = parts.select("label", F.posexplode("sums").alias("place", "value")).groupBy("label", "place").agg(F.sum("value").alias("value"))
    d = len(FEATURES)
    total = np.zeros((2, 1 + d + d * d))
    for row in placed.collect():
        total[row["label"], row["place"]] = row["value"]
    return QuadraticDiscriminant.fit(
        total[:, 0], list(total[:, 1 : 1 + d]), [t[1 + d :].reshape(d, d) for t in total], **options
    )


def quality_scores(measured: DataFrame, model: QuadraticDiscriminant, threshold: float = THRESHOLD) -> DataFrame:
    """(id, score, predicted) of every row of ``document_features``."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), float).reshape(batch.num_rows, -1)
            score = model.score(x) if len(x) else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(score, pa.float64()), pa.array((score >= threshold).astype(np.int32))], names=["id", "score", "predicted"]
            )

    return measured.mapInArrow(judge, "id bigint, score double, predicted int")
