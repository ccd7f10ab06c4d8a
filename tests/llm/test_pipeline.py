import hashlib
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from playstats.llm.bpe import read_ranks
from playstats.llm.quality_rules import quality_metrics
from playstats.session import cut_lineage

from test_jaccard_join import brute as near
from test_line_dedup import brute as lines
from test_quality_rules import brute as metrics

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pairs = {r["doc_id"]: r["text"] for r in docs.collect()}
    steps, df = [], docs
    for _, stage in corpus_pipeline.STAGES:
        df = cut_lineage(stage(spark, df, FOLDER), "pipeline-test")
        steps.append(df)
    for step in steps[:-1]:
        assert sorted(step.columns) == sorted(COLUMNS)

    good = {r["doc_id"]: r["text"] for r in steps[0].collect()}
    kept = {r["doc_id"] for r in quality_metrics(docs).where("kept").collect()}
    assert set(good) == kept and all(not metrics(t)["base_failed"] for t in good.values())
    assert all(good[i] == pairs[i] for i in good)

    unrepeated = {r["doc_id"]: r["text"] for r in steps[1].collect()}
    assert unrepeated == {i: t for i, _, _, t in lines(list(good.items()))}

    left = {r["doc_id"]: r["text"] for r in steps[2].collect()}
    _, component, _ = near(list(unrepeated.items()), 5, 80)
    assert left == {i: unrepeated[i] for i in set(component)}

    mixed = steps[3].collect()
    assert set(r["doc_id"] for r in mixed) <= set(left) and all(left[r["doc_id"]] == r["text"] for r in mixed)
    tokens = lambda rows: sum(len(r["text"].split()) for r in rows)
    whole = sum(len(t.split()) for t in left.values())
    assert 0.9 * whole < tokens(mixed) <= whole and max(Counter(r["doc_id"] for r in mixed).values()) <= 3

    usual = tiktoken.Encoding("usual", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(public_tokenizers.path(corpus_pipeline.RANK_FILE)), special_tokens={})
    got = sorted((r["doc_id"], list(r["ids"]), r["n_tokens"], r["decoded_sha256"]) for r in steps[4].collect())
    want = []
    for r in mixed:
        ids = usual.encode_ordinary(r["text"])
        want.append((r["doc_id"], ids, len(ids), hashlib.sha256(r["text"].encode()).hexdigest()))
    assert got == sorted(want)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "ids", "n_tokens", "decoded_sha256"] and out.count() > 0
