import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from playstats.llm.mixing import bisect_exponent, mix_sources, mixing_report, mixing_schedule


def corpus(table):
    rows = []
    for i in range(400):
        rows.append((i, "w " * (5 + i % 17)))
    df = table(rows)
    from pyspark.sql import functions as F

    share = F.when(F.col("doc_id") % 10 < 7, "big").when(F.col("doc_id") % 10 < 9, "mid").otherwise("small")
    return df.withColumn("source", share)


def entropy(tokens):
    total = sum(tokens)
    return -sum(t / total * math.log(t / total) for t in tokens if t)


def test_quotas_entropy_and_repeats(table):
    df = corpus(table)
    before = Counter()
    for r in df.collect():
        before[r["source"]] += len(r["text"].split())
    rows = mixing_schedule(df, target_entropy=0.9, max_repeats=3.0, block_tokens=100).collect()
    after = Counter()
    for r in rows:
        after[r["source"]] += r["n_tokens"]
    assert abs(entropy(after.values()) / math.log(3) - 0.9) < 0.02
    assert sum(after.values()) <= sum(before.values())
    assert sum(after.values()) > 0.95 * sum(before.values())
    assert all(after[s] <= 3 * before[s] for s in before)
    copies = Counter((r["source"], r["doc_id"]) for r in rows)
    for s in before:  # an epoch is complete before the next one starts
        own = [copies[s, r["doc_id"]] for r in df.where(df.source == s).collect()]
        assert max(own) - min(own) <= 1


def test_repetition_limit_wins(table):
    df = corpus(table)
    rows = mixing_schedule(df, target_entropy=1.0, max_repeats=1.5, block_tokens=100).collect()
    before = {r["source"]: r["n"] for r in df.selectExpr("source", "size(split(trim(text), ' ')) n").groupBy("source").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    after = Counter()
    for r in rows:
        after[r["source"]] += r["n_tokens"]
    assert all(after[s] <= 1.5 * before[s] + 1 for s in before) and after["small"] > 1.3 * before["small"]


def test_native_plans(table):
    out = mix_sources(corpus(table))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("goal", [0.5, 0.9, 0.99])
def test_bisection_against_a_fine_grid(spark, goal):
    tokens = [1000, 300, 50, 7]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(tokens)], "source string, tokens bigint")
    got = bisect_exponent(df, sum(tokens), goal, 1e9)
    weigh = lambda a: entropy([t**a for t in tokens]) / math.log(4)
    grid = max([a / 10000 for a in range(10001) if weigh(a / 10000) >= goal])
    assert abs(got - grid) < 2e-4


def test_edges(table):
    df = table([(1, "a b"), (1, "a b"), (None, "c d e"), (2, None), (3, "")], block=1, copies=2, epoch="x")
    out = mix_sources(df, target_entropy=0.0)
    assert out.columns == df.columns
    # the source of document 2 has no tokens
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "1", "3", "None"]
    assert mix_sources(df.limit(0)).count() == 0
    assert mix_sources(table([(1, None)])).count() == 0
    null_source = table([(1, "a b c"), (2, "d e f")]).selectExpr("doc_id", "text", "cast(null as string) source")
    assert mix_sources(null_source).count() == 2


def test_whole_corpus_at_natural_shares(table):
    df = corpus(table)
    assert mix_sources(df, target_entropy=0.0).count() == df.count()


def realised(df, **options):
    return {r["source"]: (r["target"], r["realised"]) for r in mixing_report(df, **options).collect()}


def test_a_document_that_does_not_fit_leaves_room_for_others(spark):
    small = [(i, "a", "w " * 10) for i in range(200)]
    df = spark.createDataFrame([*small, (900, "a", "w " * 5000), *[(1000 + i, "b", "w " * 5) for i in range(100)]], "doc_id bigint, source string, text string")
    for budget in (3000, 5500):
        options = {"budget": budget, "target_entropy": 0.0, "block_tokens": 1000}
        target, got = realised(df, **options)["a"]
        taken = Counter(r["doc_id"] for r in mix_sources(df, **options).collect())
        length = {i: len(t.split()) for i, _, t in df.select("doc_id", "source", "text").collect()}
        assert sum(n * length[i] for i, n in taken.items() if i < 1000) == got <= target
        left_out = [n for i, n in length.items() if i < 1000 and i not in taken]
        assert got > 1900 and target - got < min(left_out, default=1)


def test_room_is_filled_up_to_the_smallest_document_left_out(spark):
    rows = [(i, f"s{i % 4}", "w " * (1 + (i * 7919) % (40 + 60 * (i % 4)))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    options = {"target_entropy": 0.999, "max_repeats": 2.5, "block_tokens": 300}
    taken = Counter()
    for r in mixing_schedule(df, **options).collect():
        taken[r["doc_id"], r["epoch"]] += 1
    assert set(taken.values()) == {1}
    report = realised(df, **options)
    for s in ("s0", "s1", "s2", "s3"):
        own = {i: len(t.split()) for i, x, t in rows if x == s}
        target, got = report[s]
        last = target // sum(own.values())
        assert all((i, e) in taken for i in own for e in range(last))
        assert got == sum(own[i] for i, e in taken if i in own) <= target
        left_out = [n for i, n in own.items() if (i, last) not in taken]
        assert target - got < min(left_out)


def test_repeated_ids_are_taken_one_by_one(spark):
    rows = [(3, "a", "w " * 10)] * 50 + [(None, "b", "w " * 7)] * 30 + [(i, "c", "w " * 9) for i in range(100, 130)] + [(7, "c", "")] * 5
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("skey", F.lit("clash")).withColumn("row", F.lit(0))
    for budget in (100, 455, 980):
        report = realised(df, budget=budget, block_tokens=100)
        out = Counter(r["source"] for r in mix_sources(df, budget=budget, block_tokens=100).where("text <> ''").collect())
        for s, n in (("a", 10), ("b", 7), ("c", 9)):
            target, got = report[s]
            assert got == n * out[s] and target - got < n


def test_one_very_long_document(spark):
    df = spark.createDataFrame([(1, "a", "w " * 100_000), *[(i, "b", "w") for i in range(2, 40)]], "doc_id bigint, source string, text string")
    assert mix_sources(df, target_entropy=0.0).count() == 39
    report = realised(df, budget=50_000, target_entropy=0.0)
    assert report["a"][1] == 0 and report["b"][1] == report["b"][0]
