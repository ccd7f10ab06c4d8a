import re

import numpy as np
import pyarrow as pa

from playstats.llm.common import flat_words, mix64, slices, sort_rows, text_column, word_hashes
from playstats.llm.shingles import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [None, "", " ", "A b  c", "é\x0bÀ b\x1cc\xa0d", "x" * 5000, "one two three four " * 50] * 40


def batch():
    return pa.RecordBatch.from_arrays([pa.array(TEXTS)], names=["text"])


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_slices_keep_texts_and_words():
    seen = []
    for part in slices(batch(), "text", 7000):
        texts = text_column(part, "text")
        assert texts.to_pylist() == [t or "" for t in part.column("text").to_pylist()]
        words, rows = flat_words(texts, lower=True)
        want = [(w, i) for i, t in enumerate(texts.to_pylist()) for w in WORD.findall(lower(t))]
        assert list(zip(words.to_pylist(), rows.tolist(), strict=True)) == want
        seen += part.column("text").to_pylist()
    assert seen == TEXTS


def test_hashes_do_not_depend_on_the_slice():
    whole, rows = shingle_sets(text_column(batch(), "text"), 3)
    at = 0
    for part in slices(batch(), "text", 300):
        h, r = shingle_sets(text_column(part, "text"), 3)
        for i in range(part.num_rows):
            assert sorted(h[r == i].tolist()) == sorted(whole[rows == at].tolist())
            at += 1
    words = pa.array(["a", "", "ab", "ba", "a", "é"], pa.large_string())
    assert word_hashes(words)[0] == word_hashes(words)[4] and len(set(word_hashes(words).tolist())) == 5
    assert (word_hashes(words.slice(2)) == word_hashes(words)[2:]).all()
    assert (word_hashes(pa.array(['cde', 'a', '', 'ab'], pa.large_string()).slice(1)) == word_hashes(words)[:3]).all()


def test_sort_rows_with_keys_that_differ_in_low_bits():
    rows, keys = np.array([1, 0, 1, 1, 0]), np.array([5, 9, 4, 6, 9], np.uint64)
    order = sort_rows(rows, keys)
    assert rows[order].tolist() == [0, 0, 1, 1, 1] and keys[order].tolist() == [9, 9, 4, 5, 6]
    assert len(np.unique(mix64(np.arange(10000)))) == 10000
