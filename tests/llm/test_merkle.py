"""The manifest against a plain tree, the exchange against the plain tree's nodes, and edges."""

import hashlib

import pytest
from pyspark.sql import functions as F

from playstats.llm.merkle import fold, merkle_manifest, proof_text

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves, fanout):
    """Root, and the siblings of each leaf from its level up."""
    proofs, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, place in enumerate(at):
            run = place // fanout * fanout
            proofs[i].append((level[run:place], level[place + 1 : run + fanout]))
            at[i] = place // fanout
        level = [H("".join(level[s : s + fanout])) for s in range(0, len(level), fanout)]
    return level[0], proofs


def plain_manifest(rows, fanout):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(row)))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    made = {n: plain_tree([x[2] for x in sorted(trees[n])], fanout) for n in names}
    root, upper = plain_tree([made[n][0] for n in names], fanout)
    out = []
    for n, above in zip(names, upper, strict=True):
        for (has, i, own), below in zip(sorted(trees[n]), made[n][1], strict=True):
            text = "".join("".join(a + b) for a, b in below + above)
            out.append((i if has else None, own, made[n][0], root, H(text)))
    return sorted(out, key=str)


def rows_of(n, langs=("en", None, "", "de", "ß")):
    return [(i, None if i % 11 == 0 else f"s{i % 3}", langs[min(i % 9, len(langs) - 1)] if i % 9 else "en", None if i % 5 == 0 else i, None if i % 13 == 0 else f"text {i} é") for i in range(n)]


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def found(df):
    text = F.sha2(proof_text(F.col("proof")), 256)
    rows = df.select("doc_id", "leaf", "subroot", "root", text.alias("p"), (fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok")).collect()
    assert all(r["ok"] for r in rows)
    return sorted((tuple(r)[:5] for r in rows), key=str)


@pytest.mark.parametrize("n,fanout,levels", [(1, 2, 12), (37, 2, 1), (65, 2, 2), (100, 3, 1)])
def test_same_as_a_plain_tree(spark, n, fanout, levels):
    rows = rows_of(n)
    out = merkle_manifest(spark.createDataFrame(rows, SCHEMA), FIELDS, fanout=fanout, block_levels=levels)
    assert found(out) == plain_manifest(rows, fanout)


def test_one_lang_of_many_blocks(spark):
    rows = [(i, "s", "en", i, "t") for i in range(131)] + [(200, "s", "fr", 1, "t")]
    out = merkle_manifest(spark.createDataFrame(rows, SCHEMA), FIELDS, block_levels=1)
    assert found(out) == plain_manifest(rows, 2)


def test_nulls_repeats_and_long_texts(spark):
    rows = [(None, None, None, None, None)] * 2 + [(5, "s", "en", 3, "abc")] * 40 + [(5, "s", "en", 3, "x" * 200_000), (None, "s", "en", 1, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("tree", "part", "place", "row", "proof", "root", "at"):
        df = df.withColumn(c, F.lit("clash"))
    assert found(merkle_manifest(df, FIELDS, block_levels=2)) == plain_manifest(rows, 2)


def test_empty_table(spark):
    assert merkle_manifest(spark.createDataFrame([], SCHEMA), FIELDS).collect() == []


def test_a_changed_field_is_noticed(spark):
    rows = rows_of(40)
    out = merkle_manifest(spark.createDataFrame(rows, SCHEMA), FIELDS, block_levels=2)
    changed = out.select(fold(F.sha2(F.concat("leaf", F.lit("!")), 256), F.col("proof")).alias("f"), "root").where("f = root")
    assert changed.count() == 0


def test_carried_columns(spark):
    df = spark.createDataFrame(rows_of(20), SCHEMA)
    out = merkle_manifest(df, FIELDS, carry={"more": F.col("n_chars") + 1}, block_levels=1)
    assert {(r["doc_id"], r["more"]) for r in out.collect()} == {(r[0], None if r[3] is None else r[3] + 1) for r in rows_of(20)}
