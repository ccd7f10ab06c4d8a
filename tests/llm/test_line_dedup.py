import numpy as np

from playstats.llm import bloom
from playstats.llm.line_dedup import line_dedup, line_dedup_report

SPACE = " \t\n\x0b\x0c\r"
LONG = "a line that several documents share"
PAIRS = [
    (5, LONG + "\nonly here, in document five"), (2, f"  {LONG.upper()}\t\nshort\n" + LONG), (9, LONG), (9, "another row of document nine\n" + LONG),
    (1, None), (3, ""), (4, "short\nshort"), (7, "only here twice over\nonly here twice over"), (8, "ÀÉ unicode line ÀÉ\n\n"), (6, "àé unicode line àé"),
    (None, LONG + "\nonly here, in document five"), (11, "word " * 30000 + "\n" + LONG), (12, "123456789\n1234567890"), (13, "123456789\n 1234567890\r"),
]


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(pairs):
    holders = {}
    for i, t in pairs:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        first = lambda k: min(holders[k], key=lambda x: (x is None, x))
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or first(key(x)) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_against_brute_force(table):
    df = table(PAIRS, keys="x", n_lines=1, row=2)
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in line_dedup_report(df, log2_bits=16).collect()]
    assert sorted(got, key=str) == brute(PAIRS)


def test_small_filters_make_suspects_not_errors(table):
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in line_dedup_report(table(PAIRS), log2_bits=4).collect()]
    assert sorted(got, key=str) == brute(PAIRS)


def test_rows_and_columns_stay(table):
    df = table(PAIRS, id=1, key="k")
    out = line_dedup(df, log2_bits=16)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    assert sorted((r["doc_id"], r["text"] or "") if r["doc_id"] is not None else (-1, r["text"]) for r in out.collect()) == sorted(
        (-1 if i is None else i, t) for i, _, _, t in brute(PAIRS)
    )
    assert line_dedup(df.limit(0), log2_bits=16).count() == 0


def test_filter_holds_all_repeats(spark):
    rng = np.random.default_rng(3)
    once = rng.integers(-(2**63), 2**63, 3000)
    values = [int(x) for x in np.concatenate([once, once[:500]])]
    df = spark.createDataFrame([(v,) for v in values], "h bigint").repartition(7)
    packed = np.frombuffer(bloom.seen_twice(df, 18), np.uint8)
    assert bloom.in_filter(packed, once[:500], 18).all()
    assert bloom.in_filter(packed, once[500:], 18).mean() < 0.05
    held = np.frombuffer(bloom.seen_once(df, 18), np.uint8)
    assert bloom.in_filter(held, once, 18).all()
