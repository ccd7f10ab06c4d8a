import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from playstats.llm.quality_classifier import FEATURES, QuadraticDiscriminant, document_features, features, fit_classifier, quality_scores

TEXTS = [
    "", " \n ", "one", "The cat, the DOG! the the the\nline two 12\nline two 12\n", "É# $x\n\n" + "a b " * 20, "wow! so! many!", "x" * 200000, "a b c d " * 20000,
    "Plain words and more plain words in a row.",
]


def plain(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    chars, n = sum(map(len, words)), len(words)
    share = lambda a, b: math.sqrt(a / b) if b else 0.0
    mean = chars / n if n else 0
    spread = math.sqrt(max(sum(len(w) ** 2 for w in words) / n - mean**2, 0)) if n else 0
    grams = list(zip(words, words[1:]))
    return {
        "log_words": math.log1p(n), "log_mean_word": math.log1p(mean), "word_length_spread": math.log1p(spread),
        "distinct_words": share(len(set(words)), n), "repeat_neighbours": share(sum(a == b for a, b in grams), n),
        "repeat_bigrams": share(len(grams) - len(set(grams)), len(grams)), "dup_lines": share(len(lines) - len(set(lines)), len(lines)),
        "log_line_words": math.log1p(n / len(lines)) if lines else 0.0, "top_word": share(max(map(words.count, set(words[:50])), default=0), n),
        "shout_words": share(sum(w.endswith("!") for w in words), n), "digit_chars": share(sum(c in "0123456789" for c in text), chars),
        "upper_letters": share(sum(c.isupper() for c in text), chars),
    }


def test_features_against_plain_python():
    got = features(pa.array(TEXTS, pa.large_string()))
    for row, text in zip(got, TEXTS, strict=True):
        for name, value in plain(text).items():
            assert abs(row[FEATURES.index(name)] - value) < 1e-6, (name, text[:40])
    alone = np.concatenate([features(pa.array([t], pa.large_string())) for t in TEXTS])
    assert np.allclose(got, alone)


def test_scores_against_direct_densities():
    rng = np.random.default_rng(2)
    x = [rng.normal(0, 1, (80, 3)) @ rng.normal(0, 1, (3, 3)) + k for k in (0, 2)]
    model = QuadraticDiscriminant.fit([80, 80], [a.sum(0) for a in x], [a.T @ a for a in x], 0.2, 0.1, 1.0)
    cov = [np.cov(a.T) for a in x]
    pooled = sum((len(a) - 1) * c for a, c in zip(x, cov)) / 158
    points, logs = rng.normal(1, 2, (50, 3)), []
    for a, c in zip(x, cov):
        s = 0.8 * c + 0.2 * pooled
        s = 0.9 * s + 0.1 * np.trace(s) / 3 * np.eye(3)
        d = points - a.mean(0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d) - 0.5 * np.linalg.slogdet(s)[1])
    assert np.allclose(model.score(points), 1 / (1 + np.exp(logs[0] - logs[1])))


def test_held_out_accuracy(spark):
    from playstats.llm.q_quality_classifier import op5_quality_classifier

    folder = "/root/testdata/sf0.01"
    rows = op5_quality_classifier(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93


def test_edges(table):
    df = table([(1, None), (1, ""), (2, "some words here"), (None, "no id"), (3, "x" * 100000)], x=1, label=2, score=3)
    measured = document_features(df)
    labels = df.where("doc_id < 3").select(F.col("doc_id").alias("id"), (F.col("doc_id") - 1).cast("int").alias("label"))
    rows = quality_scores(measured, fit_classifier(measured, labels)).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    one_class = fit_classifier(measured, labels.where("label = 1"))
    assert all(r["score"] > 0.5 for r in quality_scores(measured, one_class).collect())
    none = fit_classifier(measured, labels.limit(0))
    assert all(r["score"] == 0.5 for r in quality_scores(measured, none).collect())
    assert document_features(df.limit(0)).count() == 0
