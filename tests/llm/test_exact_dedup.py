import hashlib

import numpy as np
import pytest

from playstats.llm import exact_dedup as module
from playstats.llm.exact_dedup import Directory, exact_dedup

PAIRS = (
    [(i, f"text number {i % 40}") for i in range(200)] + [(500 + i, "HOT copy" if i % 2 else "hot COPY") for i in range(120)]
    + [(900, None), (901, ""), (902, " "), (903, "É"), (904, "é"), (905, "x" * 300000), (906, "X" * 300000), (7, "again seven"), (None, "null id"), (None, None)]
)


def norm(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def check(rows):
    groups = {}
    for i, t in PAIRS:
        groups.setdefault(norm(t), []).append(i)
    assert len(rows) == len(PAIRS)
    for r in rows:
        mine = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r["text_sha256"])
        assert r["group_size"] == len(mine) and r["keep_id"] == max((x for x in mine if x is not None), default=None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in rows) == len(groups)


def test_against_brute_force(table):
    check(exact_dedup(table(PAIRS, key=1, n=2, last=3).repartition(6), log2_bits=14, capacity=10).collect())


def test_small_flushes(table):
    check(exact_dedup(table(PAIRS).repartition(3), log2_bits=14, flush_bytes=10).collect())


def test_colliding_keys_are_chained(table, monkeypatch):
    # three keys for all texts: every bucket is one key with many texts
    monkeypatch.setattr(module, "text_keys", lambda texts: np.array([len(t) % 3 for t in texts.to_pylist()], np.int64))
    rows = exact_dedup(table(PAIRS).repartition(4), log2_bits=14, capacity=5).collect()
    check(rows)
    assert max(r["chain"] for r in rows) > 5


def test_repeated_rows_and_empty_table(table):
    rows = exact_dedup(table([(1, "a"), (1, "a"), (1, "b")]), log2_bits=14).collect()
    assert sorted((r["group_size"], r["kept"]) for r in rows) == [(1, True), (2, False), (2, True)]
    assert exact_dedup(table([(1, "a")]).limit(0), log2_bits=14).count() == 0


@pytest.mark.parametrize("step", [2, 5])
def test_directory_splits_until_buckets_fit(spark, step):
    keys = [int(k) for k in np.random.default_rng(1).integers(-(2**63), 2**63, 900)] + [12345] * 60 + list(range(50))
    df = spark.createDataFrame([(k,) for k in keys], "key bigint")
    directory = Directory.build(df, capacity=25, step=step)
    bucket = directory.bucket(np.array(keys, np.int64))
    for b in set(bucket.tolist()):
        own = [k for k, x in zip(keys, bucket, strict=True) if x == b]
        assert len(own) <= 25 or len(set(own)) == 1 or directory.depths[b] > 55
    assert directory.starts == sorted(directory.starts) and directory.starts[0] == 0


def test_result_comes_from_the_owners(table, monkeypatch):
    """With owners that mistake the texts, no group is right: nothing beside the index groups them."""

    class OneText(module._Chain):
        def add(self, text, n, last, ties):
            return super().add(b"same", n, last, ties)

    rows = [(1, "a"), (2, "b"), (2, "b"), (3, "a"), (3, "a")]
    right = exact_dedup(table(rows), log2_bits=14).collect()
    assert sorted((r["keep_id"], r["group_size"], r["kept"]) for r in right) == [(2, 2, False), (2, 2, True), (3, 3, False), (3, 3, False), (3, 3, True)]
    monkeypatch.setattr(module, "_Chain", OneText)
    wrong = exact_dedup(table(rows), log2_bits=14).collect()
    assert sorted((r["keep_id"], r["group_size"]) for r in wrong) != sorted((r["keep_id"], r["group_size"]) for r in right)


def test_sizes_follow_the_rows(table, monkeypatch):
    monkeypatch.setattr(module, "CAPACITY", 1)
    monkeypatch.setattr(module, "BUCKETS", 64)
    monkeypatch.setattr(module, "CELLS", 8)  # counts go on in many small rounds
    check(exact_dedup(table(PAIRS)).collect())
