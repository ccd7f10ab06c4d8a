import random
import textwrap

import pytest

from playstats.llm.license_scan import NOTICES as TEMPLATES, Scanner, bigrams, dice, normalise

PROSE = "one two three four five six seven eight nine ten eleven twelve of the under a to any in this software and so on"


def best_of_all_spans(text, threshold=0.8):
    """Best score of each template over all contiguous word spans."""
    words, best = normalise(text), {}
    for name, template in TEMPLATES.items():
        grams = bigrams(normalise(template))
        score = max((dice(bigrams(words[i:j]), grams) for i in range(len(words)) for j in range(i + 1, len(words) + 1)), default=0.0)
        if score >= threshold:
            best[name] = score
    return best


def best_found(text, scanner=Scanner(TEMPLATES, 0.8)):
    best = {}
    for name, _, _, score in scanner.scan(text):
        best[name] = max(score, best.get(name, 0.0))
    return best


@pytest.mark.parametrize("name", TEMPLATES)
def test_exact_notice_inside_wrapped_prose(name):
    text = f"{PROSE} {TEMPLATES[name]} {PROSE}"
    for width in (24, 30, 72):
        assert best_found(textwrap.fill(text, width, break_long_words=False, break_on_hyphens=False))[name] == 1.0
    assert best_found(f"{PROSE}\n" + "\n\n".join(TEMPLATES[name].split()) + f"\n{PROSE}")[name] == 1.0  # a word and a blank line in turn


def test_best_scores_against_all_word_spans():
    rng = random.Random(4)
    for _ in range(60):
        words = rng.choices(PROSE.split(), k=rng.randrange(12))
        for name in rng.choices(list(TEMPLATES), k=2):
            part = TEMPLATES[name].split()
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(part))
                part[at : at + rng.randrange(2)] = rng.choices(PROSE.split() + part, k=rng.randrange(3))
            words += part + rng.choices(PROSE.split(), k=rng.randrange(6))
        text = "".join(w + rng.choice(" \n") for w in words[:70])
        assert best_found(text) == best_of_all_spans(text), text


def test_few_words_repeated_against_all_word_spans():
    templates = {"a": "x y z x w y", "b": "x y x y z", "c": "w z y x"}
    rng = random.Random(5)
    for _ in range(400):
        words = rng.choices("xyzwq", k=rng.randrange(2, 24))
        threshold = rng.choice([0.5, 0.6, 0.8])
        scanner, want = Scanner(templates, threshold), {}
        for name, template in templates.items():
            grams = bigrams(normalise(template))
            score = max(dice(frozenset(zip(words[i:j], words[i + 1 : j])), grams) for i in range(len(words)) for j in range(i + 2, len(words) + 1))
            if score >= threshold:
                want[name] = score
        assert best_found(" ".join(words), scanner) == want, words


def test_repeated_notices_make_few_spans():
    lines = ["Released under the MIT License."] * 300
    found = Scanner(TEMPLATES, 0.8).scan("\n".join(lines))
    assert {(i, j) for name, i, j, s in found if name == "MIT" and s == 1.0} == {(i, i) for i in range(300)}
    assert len(found) < 2000
    assert Scanner({"one": "word"}, 0.8).scan("a\nword") == [("one", 1, 1, 1.0)]
