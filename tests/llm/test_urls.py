import random

import duckdb
import pandas as pd
import pytest

from retrolane.llm import urls

URLS = [
    None,
    "",
    "no scheme/xxx",
    "http://A.Example.ORG/en/1?x#y",
    "https://sub.example.org/es/a",
    "https://example.org",
    "http://org/",
    "http://xorg/",
    "https://shop.com/fr/free-casino",
    "https://shop.com/de/",
    "https://shop.com/en/free-casino-bonus",
    "https://shop.com/en/freecasino",
    "https://shop.net/xxx",
    "https://shop.net/axxx/xxxb",
    "https://shop.net/Free?free=free",
    "http://h.com?a://b/fr/",
    "://x.com/fr/",
    "http://ü.ORG/ß#?",
    "http://user@host.com:80/de/x",
]


def cases():
    rng = random.Random(1)
    parts = ["free", "XXX", "casino", "-", "/", "?", "#", ".", "org", "com", "example", "fr/", "de/", "://", "1", "ü", "en/1"]
    return URLS + ["http://" + "".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(800)]


def plain(url):
    url = url or ""
    host = path = ""
    if "://" in url:
        rest = url[url.index("://") + 3 :]
        while rest and rest[0] not in "/?#":
            host, rest = host + rest[0], rest[1:]
        while rest and rest[0] not in "?#":
            path, rest = path + rest[0], rest[1:]
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    host, text = low(host), low(url)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in urls.RULES if ("." + host).endswith("." + h) and path.startswith(p)]
    best = max(fits)[2:] if fits else None

    def has(term):
        at = text.find(term)
        edge = lambda c: not (c.isascii() and c.isalnum())
        while at >= 0:
            if edge(text[at - 1 : at] if at else "") and edge(text[at + len(term) : at + len(term) + 1]):
                return True
            at = text.find(term, at + 1)
        return False

    strict = sum(has(t) for t in urls.STRICT)
    soft = sum(w for t, w in urls.SOFT.items() if has(t))
    verdict = best[1] if best else "block" if strict or soft >= 2 else "allow"
    return host, path, best and best[0], verdict, strict, soft


def test_judgements_equal_the_plain_search_and_the_sql(spark):
    table = pd.DataFrame({"page_id": range(len(cases())), "url": cases()})
    pages = spark.createDataFrame(list(table.itertuples(index=False, name=None)), "page_id long, url string")
    got = sorted(tuple(r) for r in urls.judge(pages, rules=urls.RULES).drop("url").collect())
    assert got == [(i, *plain(url)) for i, url in enumerate(cases())]
    names = ["page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_weight"]
    with duckdb.connect() as db:
        db.register("pages", table)
        sql = db.sql(f"select {', '.join(names)} from ({urls.oracle_sql()}) order by 1").fetchall()
    assert sql == got


def test_clashing_names_repeats_and_empty_tables(spark):
    pages = spark.createDataFrame([("http://a.org/", "h"), ("http://a.org/", "h")], "url string, host string")
    out = urls.judge(pages, rules=urls.RULES)
    assert out.columns == ["url", "host", "path", "rule", "verdict", "strict_hits", "soft_weight"]
    assert [tuple(r)[1:5] for r in out.collect()] == [("a.org", "/", "org/", "allow")] * 2
    assert urls.judge(pages.limit(0)).count() == 0
    nothing = urls.Vocabulary(strict=(), soft={})
    assert {r["verdict"] for r in urls.judge(pages, nothing).collect()} == {"allow"}


@pytest.mark.parametrize("url", ["http://x.net/adult/nude", "http://x.net/adult-adult", "http://x.net/" + "a" * 90_000])
def test_distinct_soft_terms_count_once(url):
    judged = urls.Filter(urls.Vocabulary(), ()).judge(url)
    assert judged[3] == ("block" if "nude" in url else "allow")
