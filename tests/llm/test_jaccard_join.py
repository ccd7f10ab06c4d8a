import random
import re

import pytest

from playstats.llm.jaccard_join import drop_near_copies, jaccard_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, min(len(words), 1))))


def brute(pairs, size, percent):
    sets = [shingles(t, size) for _, t in pairs]
    parent = list(range(len(pairs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(pairs)):
        groups.setdefault(find(i), []).append(pairs[i][0])
    return sets, [min((x for x in groups[find(i)] if x is not None), default=None) for i in range(len(pairs))], groups


def corpus():
    rng = random.Random(4)
    pairs, words = [], [f"w{i}" for i in range(400)]
    for base in range(6):
        text = [rng.choice(words) for _ in range(rng.choice((30, 60, 150)))]
        for copy in range(25):
            own = list(text)
            for _ in range(copy % 6):
                own[rng.randrange(len(own))] = rng.choice(words)
            pairs.append((base * 100 + copy, " ".join(own) if copy % 3 else " ".join(own).upper()))
    shared = " ".join(rng.choice(words) for _ in range(40))
    pairs += [(1000 + i, shared + " " + " ".join(rng.choice(words) for _ in range(200))) for i in range(30)]
    pairs += [(2000 + i, t) for i, t in enumerate([None, "", " ", "a", "A", "a b", "b a", "a b c", "a b c d", "a  b\tc\nd", "x" * 50000, "w1 " * 5000])]
    return [*pairs, (3000, "a b c d"), (3000, "quite another text of the same id"), (None, "a b"), (None, "of no id at all")]


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (2, 60)])
def test_components_against_brute_force(table, size, percent):
    pairs = corpus()
    sets, want, _ = brute(pairs, size, percent)
    got = jaccard_components(table(pairs, k=1, token=2, n="x").repartition(5), words=size, percent=percent).collect()
    key = lambda rows: sorted(map(str, rows))
    assert key((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == key((p[0], len(s), w) for p, s, w in zip(pairs, sets, want, strict=True))


def test_one_row_of_each_component_stays(table):
    pairs = corpus() + [(7, corpus()[7][1])]
    df = table(pairs, k=1, leads="x", row="y")
    _, want, groups = brute(pairs, 5, 80)
    out = drop_near_copies(df, words=5, percent=80)
    assert out.columns == df.columns
    kept = sorted((r["doc_id"] for r in out.collect()), key=str)
    assert kept == sorted((min((x for x in g if x is not None), default=None) for g in groups.values()), key=str)


def test_empty_table(table):
    assert jaccard_components(table([(1, "a")]).limit(0)).count() == 0
    assert drop_near_copies(table([(1, "a")]).limit(0)).count() == 0
    assert drop_near_copies(table([(1, None), (2, "")])).count() == 2
