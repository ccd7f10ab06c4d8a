import random
import struct

import public_tokenizers
import pytest
import regex
import tiktoken

from playstats.llm.bpe import Vocabulary, bpe_decode, bpe_encode, bpe_round_trip, encode_texts, read_ranks

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module", params=["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def rank_file(request):
    return public_tokenizers.path(request.param)


def texts():
    rng = random.Random(5)
    letters = "aaabbc dé\n\t 12!ßλ漢字\x1c\x85\xa0'sẞ"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(120))) for _ in range(1500)]
    out += [bytes(rng.choices(range(32, 127), k=60)).decode() for _ in range(1500)]
    return [*out, "", "a" * 30000, " " * 4000, "ab" * 9999, "\U0001f600" * 50, "the cat 's'll", None]


def test_as_tiktoken_and_back(spark, rank_file):
    ranks = read_ranks(rank_file)
    usual = tiktoken.Encoding("usual", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*enumerate(texts()), (None, "no id"), (1, "same id")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as ids", "'y' as id").repartition(4)
    got = bpe_decode(bpe_encode(df, rank_file, PATTERN, corpus_bytes=20000), rank_file).collect()
    want = sorted((str(i), tuple(usual.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows)
    assert sorted((str(r["doc_id"]), tuple(r["ids"]), bytes(r["decoded"])) for r in got) == want
    assert bpe_encode(df.limit(0), rank_file, PATTERN).count() == 0
    both = bpe_round_trip(df, rank_file, PATTERN).collect()
    assert sorted((str(r["doc_id"]), tuple(r["ids"]), bytes(r["decoded"])) for r in both) == want
    assert all(struct.unpack(f"<{len(r['ids'])}I", r["packed_ids"]) == tuple(r["ids"]) for r in both)


def test_out_of_order_ranks():
    # the merges of later tokens make pairs of earlier ones
    ranks = {bytes([b]): b for b in range(256)} | {b"abcd": 256, b"bc": 257, b"abc": 258, b"cd": 259, b"da": 260, b"ab": 300}
    vocabulary, rng = Vocabulary(ranks), random.Random(2)
    pieces = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    ids, counts = encode_texts(vocabulary, regex.compile(r"\S+"), pieces)
    at = 0
    for piece, n in zip(pieces, counts, strict=True):
        whole = ranks.get(piece.encode())
        assert ids[at : at + n].tolist() == ([whole] if whole is not None else vocabulary.greedy(piece.encode()))
        at += n
