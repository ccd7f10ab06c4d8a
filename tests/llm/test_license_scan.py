import re

from playstats.llm.license_scan import TEMPLATES, Scanner, bigrams, dice, license_scan, normalise

MIT = TEMPLATES["MIT-notice"]
TEXTS = [
    None, "", "plain text of no licence", "Released under the MIT License.", "released UNDER the mit license", "MIT",
    "intro line\nLicensed under CC BY-NC 4.0.\nmore text", MIT.replace(" of this ", "\nof this\n"), "license " * 2000,
    "Words before. Licensed under the Apache License, Version 2.0. Words after that go on and on in one line",
    "\n".join(["This work is licensed under the", "GNU General Public License, version 3.", "x", "y", "z", "u"]),
    "Released under the license of MIT", "under the\n" * 50,
]


def brute(text, lines=4, threshold=0.8):
    rows = (text or "").split("\n")
    blocks = [rows[i:j] for i in range(len(rows)) for j in range(i + 1, min(i + lines, len(rows)) + 1)] + [rows]
    best = 0.0
    for name, t in TEMPLATES.items():
        grams = bigrams(normalise(t))
        for block in blocks:
            best = max(best, dice(bigrams([w for x in block for w in normalise(x)]), grams))
        n = len(normalise(t))
        for row in rows:
            words = normalise(row)
            for size in {len(normalise(x)) for x in TEMPLATES.values()}:
                for k in range(max(len(words) - 1, 0)):
                    best = max(best, dice(bigrams(words[k : k + size]), grams)) if len(words) < 300 else best
    return best if best >= threshold else None


def test_best_score_against_brute_force(table):
    got = {r["doc_id"]: r for r in license_scan(table(enumerate(TEXTS), license="x", score="y")).collect()}
    for i, text in enumerate(TEXTS):
        want = brute(text)
        assert (got[i]["score"] is None) == (want is None), text
        assert want is None or abs(got[i]["score"] - want) < 1e-12, text
        assert got[i]["n_matches"] == len(got[i]["spans"])


def test_spans_point_at_lines(table):
    r = license_scan(table([(1, "a b\nReleased under the MIT License.\nc d")])).first()
    assert r["license"] == "MIT" and r["spans"][0]["first_line"] == 1
    assert license_scan(table([(1, "x")]).limit(0)).count() == 0


def test_size_bounds_of_templates():
    scanner = Scanner(TEMPLATES, 0.8)
    for n in (0, 3, 5, 20, 150, 3000):
        names = {name for _, name, _ in scanner.templates[: scanner.largest(n)]}
        # the best that n bigrams can score is 2 n / (n + size), if all are the template's
        assert names == {name for size, name, _ in scanner.templates if n and 2 * min(n, size) / (min(n, size) + size) >= 0.8 - 1e-12}


def test_too_large_templates_are_not_grown(monkeypatch):
    grown = []
    grow = Scanner.grow
    monkeypatch.setattr(Scanner, "grow", lambda self, g, lines, k, size, t: grown.append(size) or grow(self, g, lines, k, size, t))
    scanner = Scanner(TEMPLATES, 0.8)
    assert {m[0] for m in scanner.scan("\n".join(TEMPLATES["MIT-notice"].split()))} == {"MIT-notice"}
    assert grown and max(grown) < len(bigrams(normalise(TEMPLATES["MIT-text"])))


FULL = [name for name in TEMPLATES if name.endswith(("-text", "-header"))]


def test_whole_licence_texts_in_long_files(table):
    prose = "\n".join(f"line {i} of the work and of its terms, that any person may read in the {i % 37} parts" for i in range(1500))
    marked = lambda text: "\n".join(" * " + line for line in text.split("\n"))
    rows = [(i, f"{prose}\n/*\n{marked(TEMPLATES[name])}\n */\n{prose}") for i, name in enumerate(FULL)]
    got = {r["doc_id"]: {s["license"]: s["score"] for s in sorted(r["spans"], key=lambda s: s["score"])} for r in license_scan(table(rows)).collect()}
    assert len(FULL) == 7
    for i, name in enumerate(FULL):
        assert got[i][name] == 1.0, name


def test_altered_licence_text_scores_below_one(table):
    words = TEMPLATES["BSD-3-Clause-text"].replace("copyright holder", "University").split()
    row = license_scan(table([(1, " ".join(["intro"] * 50 + words))])).first()
    scores = {s["license"]: s["score"] for s in row["spans"]}
    assert 0.9 < scores["BSD-3-Clause-text"] < 1.0
