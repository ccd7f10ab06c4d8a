import re

from playstats.llm.url_filter import SOFT_TERMS, STRICT_TERMS, RULES, UrlVocabulary, url_filter

URLS = [
    None, "", "no scheme/net/", "http://a.net", "http://a.net/", "HTTP://A.NET/x?y", "https://m.EXAMPLE.net/en/1#top",
    "http://example.com/de/1", "http://xexample.com/de/1", "http://b.org/fr/", "http://b.org/casino", "http://b.org/casinos",
    "http://b.org/my-casino/", "http://cheap.bet.org/x", "http://cheapbet.org/x", "http://spam-farm.example.org/en",
    "http://example.com/free-free", "http://éfree.com/pills", "a://b://c/d?e", "http://x.net:80/", "://", "http:///path",
    "http://example.com/" + "a" * 50000 + "/xxx", "http://b.org/poker", "http://b.org/poker", "http://net/",
    "http://b.org/free-deal", "http://b.org/free-bet", "http://b.org/free/deal/promo", "http://b.org/free/deal/promo/sale",
    "http://b.org/free-poker", "http://b.org/bet/bonus", "http://b.org/poker-poker-poker",
]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in RULES if ("." + host).endswith("." + h) and path.startswith(p)]
    if host and fits:
        rule, verdict = max(fits, key=lambda f: len(f[0]))
        return host, path, rule, verdict
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    has = lambda t: any(
        not low[m.start() - 1 : m.start()].isalnum() and not low[m.end() : m.end() + 1].isalnum()
        for m in re.finditer(f"(?={re.escape(t)})()", low) if True
        for m in [re.compile(re.escape(t)).match(low, m.start())]
    )
    soft = [t for t in SOFT_TERMS if has(t)]
    bad = any(has(t) for t in STRICT_TERMS) or (len(soft) >= 2 and sum(SOFT_TERMS[t] for t in soft) >= 2)
    return host, path, None, "block" if bad else "allow"


def test_against_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id bigint, url string").selectExpr("*", "1 as host", "'x' as rule")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter(df).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}


def test_empty_repeated_and_null_ids(spark):
    df = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter(df).count() == 0
    df = spark.createDataFrame([(None, "http://a.org/xxx")] * 3, "page_id bigint, url string")
    assert [r["verdict"] for r in url_filter(df).collect()] == ["block"] * 3


def test_weights_decide(spark):
    urls = ["free/deal", "free/bet", "free/deal/promo", "bet/bonus", "free/poker", "free/deal/promo/sale", "poker/poker"]
    df = spark.createDataFrame([(i, f"http://a.org/{u}") for i, u in enumerate(urls)], "page_id bigint, url string")
    verdicts = lambda **limits: [r["verdict"] for r in url_filter(df, vocabulary=UrlVocabulary(**limits)).orderBy("page_id").collect()]
    assert verdicts() == ["allow", "allow", "allow", "block", "block", "block", "allow"]
    assert verdicts(weight_limit=0.0) == ["block"] * 6 + ["allow"]
    assert verdicts(soft_limit=1, weight_limit=1.5) == ["allow", "block", "block", "block", "block", "block", "block"]


def test_clashing_columns(spark):
    names = ("page_id", "url", "host", "path", "rule", "verdict", "strict_terms", "soft_terms", "soft_weight", "URL2")
    df = spark.createDataFrame([tuple(["7", "http://a.org/xxx", *names[2:]])], ", ".join(f"{n} string" for n in names))
    row = url_filter(df).first()
    assert (row["page_id"], row["host"], row["path"], row["verdict"]) == (7, "a.org", "/xxx", "block")
