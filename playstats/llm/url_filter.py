"""URL filter: a weighted vocabulary matched by an Aho-Corasick automaton.

Terms are matched in the lower-cased (A-Z) url wherever both neighbours are
no letter or digit. One strict term rejects a url, and so do
``soft_limit`` or more distinct soft terms whose weights together reach
``weight_limit``: two ordinary terms are enough, a light and an ordinary one
are not. A term found again adds nothing. Host and path rules come first: the
longest rule that fits decides, and only urls without a fitting rule are left
to the vocabulary.

The automaton is built once for each task from a vocabulary that is a
parameter; rows stream through in Arrow batches, without a shuffle.

Defined results: a null url, or one without ``://``, has an empty host and
path and fits no rule; a null url matches no term and is allowed. An empty
table gives an empty result, repeated rows are judged one by one, and other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from pyspark.sql import functions as F

#: Fixed values of the vocabulary. One strict term is enough.
STRICT_TERMS = (
    "porn xxx casino viagra cialis hentai escort payday-loan cheap-pills spam-farm "
    "phishing warez malware-download fake-rolex"
).split()
#: Soft terms and their weights.
SOFT_TERMS = {
    "ads": 1.0, "track": 1.0, "click": 1.0, "adult": 1.5, "bet": 1.0, "bonus": 1.0, "cheap": 1.0, "coupon": 1.0,
    "dating": 1.5, "deal": 0.5, "free": 0.5, "loan": 1.0, "lottery": 1.5, "pills": 1.5, "poker": 1.5, "prize": 1.0,
    "promo": 0.5, "sale": 0.5, "sex": 1.5, "spam": 1.5, "torrent": 1.5, "winner": 1.0,
}
SOFT_LIMIT, WEIGHT_LIMIT = 2, 2.0

#: (verdict, host, path)
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

SCHEMA = (
    "page_id bigint, host string, path string, rule string, verdict string, "
    "strict_terms array<string>, soft_terms array<string>, soft_weight double"
)
_HOST = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_TO_LOWER = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


@dataclass(frozen=True)
class UrlVocabulary:
    """Strict terms, weighted soft terms, and the limits that soft hits must both reach."""

    strict: tuple[str, ...] = tuple(STRICT_TERMS)
    soft: tuple[tuple[str, float], ...] = tuple(SOFT_TERMS.items())
    soft_limit: int = SOFT_LIMIT
    weight_limit: float = WEIGHT_LIMIT

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for term, weight in self.soft:
            machine.add_word(term, (term, weight, False))
        for term in self.strict:
            machine.add_word(term, (term, 0.0, True))
        machine.make_automaton()
        return machine


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    found = _HOST.search(url) if url else None
    return (found[1].translate(_TO_LOWER), found[2]) if found else ("", "")


def rule_for(host: str, path: str, rules) -> tuple[str, str] | None:
    """The longest rule whose host is ``host`` or a parent domain and whose path begins ``path``."""
    fits = [
        (len(h) + len(p), h + p, verdict)
        for verdict, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else None


def term_hits(url: str, machine) -> tuple[list[str], dict[str, float]]:
    """Strict terms and weighted soft terms found between boundaries; each once."""
    low = url.translate(_TO_LOWER)
    strict, soft = set(), {}
    for end, (term, weight, is_strict) in machine.iter(low):
        start = end - len(term)
        if (start >= 0 and low[start].isalnum()) or (end + 1 < len(low) and low[end + 1].isalnum()):
            continue
        if is_strict:
            strict.add(term)
        else:
            soft[term] = weight
    return sorted(strict), soft


def url_filter(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    vocabulary: UrlVocabulary = UrlVocabulary(),
    rules=RULES,
) -> DataFrame:
    """One row per url: host, path, the rule that decided, the verdict and the terms found."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = vocabulary.automaton()
        for batch in batches:
            out = {name: [] for name in ("page_id", "host", "path", "rule", "verdict", "strict_terms", "soft_terms", "soft_weight")}
            for page, url in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), strict=True):
                host, path = host_and_path(url)
                rule = rule_for(host, path, rules) if host else None
                strict, soft = term_hits(url or "", machine)
                bad = bool(strict) or (len(soft) >= vocabulary.soft_limit and sum(soft.values()) >= vocabulary.weight_limit)
                verdict = rule[1] if rule else "block" if bad else "allow"
                row = (page, host, path, rule and rule[0], verdict, strict, sorted(soft), float(sum(soft.values())))
                for values, value in zip(out.values(), row, strict=True):
                    values.append(value)
            kinds = (pa.int64(), *[pa.string()] * 4, pa.list_(pa.string()), pa.list_(pa.string()), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], names=list(out))

    picked = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    return picked.mapInArrow(judge, SCHEMA).withColumnRenamed("page_id", id_col)
