"""Licence scan: word spans of a text compared to licence templates by Dice over word bigrams.

A span is any run of consecutive words, across line ends. Texts and templates
are normalised alike: lower case, every run of other characters than letters
and digits is one space. Their word bigrams are sets; Dice is
``2 * common / (size of span + size of template)``.

Sizes bound what can match: with a threshold ``t`` a span has between
``t / (2 - t)`` and ``(2 - t) / t`` times as many bigrams as its template.
Templates are kept by size, and those too large for all bigrams of a text are
not looked at; nor are those of which the text, or its rest from a place on,
holds fewer bigrams than the lower bound asks for.

For the others, spans are grown from the first of each run of the template's
bigrams in the text. No match is better than those found this way: a span that
begins or ends with another bigram, or with one that it holds again, scores no
higher than the shorter span without it, and one that begins later in the run
no higher than the longer one. Growing ends at the bigram it began with (then
the next one of the run has its turn), and when the span has so many other
bigrams that even the whole template would score less than the threshold: the
upper bound. So the work grows with the text, also if it repeats.

A match is the best span grown from a place, the shortest of these, reported
by its first and last line; matches of the same lines are one. Behind a span
that equals the template, growing goes on at its end.

Each document is scanned alone, in Arrow batches, without a shuffle.

Defined results: a null or empty text has no match. Of several matches the
highest score is reported as the best, then the smallest name. Repeated rows
are scanned one by one; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Short licence notices as found at the head of files.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files to deal in the Software without restriction"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

#: The notices, and whole licence texts by the names of their files.
TEMPLATES = NOTICES | {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}

THRESHOLD = 0.8
SCHEMA = "doc_id bigint, license string, score double, n_matches bigint, spans array<struct<license: string, first_line: int, last_line: int, score: double>>"
_GAPS = re.compile(r"[\W_]+")


def normalise(text: str) -> list[str]:
    return _GAPS.sub(" ", text.lower()).split()


def bigrams(words: list[str]) -> frozenset:
    """Word bigrams; one word alone stands for itself."""
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset((w,) for w in words)


def dice(a: frozenset, b: frozenset) -> float:
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


class Scanner:
    """Templates by size, ready to be compared with spans of at most ``max_lines`` lines (none: any number)."""

    def __init__(self, templates: dict[str, str], threshold: float, max_lines: int | None = None):
        self.threshold, self.max_lines = threshold, max_lines
        made = ((name, bigrams(normalise(text))) for name, text in templates.items())
        self.templates = sorted(((len(g), name, g) for name, g in made if g), key=lambda made: made[:2])
        self.sizes = [size for size, _, _ in self.templates]
        self.known: dict[tuple, list[int]] = {}  # bigram -> templates that hold it
        for i, (_, _, grams) in enumerate(self.templates):
            for x in grams:
                self.known.setdefault(x, []).append(i)
        self.one_word = any(len(x) == 1 for x in self.known)

    def largest(self, n_grams: int) -> int:
        """How many templates, from the smallest, some span of ``n_grams`` different bigrams may match."""
        return bisect_right(self.sizes, n_grams * (2 - self.threshold) / self.threshold + 1e-9)

    def grow(self, grams: list[tuple], lines: list[int], k: int, size: int, template: frozenset) -> tuple[float, int, bool]:
        """Score and last bigram of the best span that begins with bigram ``k``, and whether no limit but the text's and the size's ended it."""
        seen, common, best, free = set(), 0, (0.0, k), self.max_lines is None
        last_line = len(lines) if self.max_lines is None else lines[k] + self.max_lines - 1
        most = (2 - self.threshold) / self.threshold * size - size + 1e-9  # other bigrams, if the whole template were there
        for p in range(k, len(grams)):
            x = grams[p]
            if x in seen:
                if x == grams[k]:
                    free = False
                    break
                continue
            if lines[min(p + 1, len(lines) - 1)] > last_line:
                break
            seen.add(x)
            if x in template:
                common += 1
                score = 2 * common / (len(seen) + size)
                if score > best[0]:
                    best = score, p
            elif len(seen) - common > most:
                break
        return *best, free

    def scan(self, text: str) -> list[tuple[str, int, int, float]]:
        """(template, first line, last line, score) of every match, line numbers from 0."""
        words, lines = [], []
        for i, line in enumerate(text.split("\n")):
            found = normalise(line)
            words += found
            lines += [i] * len(found)
        grams = list(zip(words, words[1:]))
        known, places, fit = self.known, {}, self.largest(len(set(grams)))
        for k, x in enumerate(grams):
            if x in known:
                for i in known[x]:
                    if i < fit:
                        places.setdefault(i, []).append(k)
        matches: dict[tuple[str, int, int], float] = {}

        def add(name: str, i: int, j: int, score: float) -> None:
            matches[name, i, j] = max(score, matches.get((name, i, j), 0.0))

        t = self.threshold
        for i, at in places.items():
            size, name, template = self.templates[i]
            least = t / (2 - t) * size - 1e-9  # different bigrams that a match shares with the template
            if len({grams[k] for k in at}) < least:
                continue
            covered, exact_end = -2, -1
            for n, k in enumerate(at):
                if len(at) - n < least:
                    break
                if k <= exact_end:
                    continue
                if k == covered + 1:
                    covered = k
                    continue
                score, p, free = self.grow(grams, lines, k, size, template)
                if score >= t:
                    add(name, lines[k], lines[p + 1], score)
                if score == 1.0:
                    exact_end = p
                elif free:
                    covered = k
        if self.one_word:
            for word, line in zip(words, lines):
                for i in known.get((word,), ()):
                    add(self.templates[i][1], line, line, 1.0)
        return [(name, i, j, score) for (name, i, j), score in matches.items()]


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: dict[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
    max_lines: int | None = None,
) -> DataFrame:
    """One row per document: the best licence (null if none), its score, and the matching spans."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold, max_lines)
        span = pa.struct([("license", pa.string()), ("first_line", pa.int32()), ("last_line", pa.int32()), ("score", pa.float64())])
        for batch in batches:
            best, scores, counts, spans = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = scanner.scan(text) if text else []
                score, name = min(((-s, n) for n, _, _, s in found), default=(None, None))
                best.append(name)
                scores.append(score and -score)
                counts.append(len(found))
                spans.append([{"license": n, "first_line": i, "last_line": j, "score": s} for n, i, j, s in sorted(found, key=lambda f: (f[1], f[2], f[0]))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(best, pa.string()), pa.array(scores, pa.float64()), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span))],
                names=["doc_id", "license", "score", "n_matches", "spans"],
            )

    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return picked.mapInArrow(scan, SCHEMA).withColumnRenamed("doc_id", id_col)
