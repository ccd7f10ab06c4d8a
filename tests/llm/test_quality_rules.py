import re
from collections import Counter

from playstats.llm.quality_rules import quality_filter, quality_metrics

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", " \n\t ", "one", "a b c d e a b c d e", "x " * 40, "the cat sat on the mat and the dog ran off to be with it",
    "\n\nline one here\n line one here\nline one here\n \n", "a#b $c %d & | < > * # not a fine text of many words to be kept here",
    "the same five words again " * 3 + "and then some other words that do not repeat in any way at all in this text",
    "wow! such! shout! very! loud! so! many! marks! in! here! the! of!", "w\x1cx y\xa0z \x0bv\x0cu\rt the of and to in a is that",
    "aaaa " * 30000,
    "a\n\x85\n\x85", "a\n\u2028\nb\u2028\nb\u2028\n \u2029\n\t\u2029\n\u2029", "\x85 \n\r\n\x0c\n\u2029 \r\n\u2029 \r",
]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words),
    }


def test_metrics_against_brute_force(table):
    df = table(enumerate(TEXTS), words="x", h=1, n_words=3, kept=False)
    got = {r["doc_id"]: r.asDict() for r in quality_metrics(df).collect()}
    for i, text in enumerate(TEXTS):
        want = brute(text)
        assert {k: got[i][k] for k in want} == want, text
        assert not (want["base_failed"] and got[i]["kept"])


def test_filter_keeps_rows_and_columns(table):
    good = "the cat sat on the mat and the dog ran off to be with it"
    df = table([(1, good), (1, good), (2, "no"), (None, good), (3, None)], n_words="clash", kept="clash")
    out = quality_filter(df)
    assert out.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "1", "None"]
    assert quality_filter(df.limit(0)).count() == 0


def test_native_plan(table):
    plan = quality_metrics(table([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
