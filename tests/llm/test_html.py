import random
import re
from html import unescape

from pyspark.sql import functions as F

from retrolane.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{x:1}</style><script>var t="</p>";</script></head>
<body><header><p>Top</p></header><nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad <p>x</p> -->
<div class="cookie-notice">We use</div><article id="main"><h1>Head &amp; more &am &amp</h1><p class="lead"><b>One  two<br>three
<p>Four <i>fi</i>ve&nbsp;six<script>x</script> a < b</p><div class="comments"><p>Nice!</p></div><aside>Side</aside>
<form><p>Name</p><input></form><figure>Fig</figure><ul><li>x<li>y</ul></article><footer>&copy; me</footer></body></html>"""


def text(page):
    return html._main(html.blocks(page), None)


def test_an_article_keeps_its_blocks_only():
    assert text(PAGE) == "Head & more &am &\nOne two three\nFour five six a < b\nx\ny"


def test_broken_pages_do_not_fail():
    rng = random.Random(3)
    for _ in range(300):
        cut = PAGE[rng.randrange(len(PAGE)) : rng.randrange(len(PAGE))] + PAGE[rng.randrange(len(PAGE)) :]
        assert isinstance(text(cut), str)
    for page in ("<", "</", "<a", "<script>x", "<!--", "plain", "<p" + " a" * 20_000, "<div>" * 3000 + "x", ""):
        assert isinstance(text(page), str)


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.choice("xyz") for _ in range(rng.randrange(9))] for _ in range(2))
        found = sorted(html.difference(a, b))
        kept = [a[i] for i in found]
        rest = iter(b)
        assert all(x in rest for x in kept)
        best = max(
            sum(m >> i & 1 for i in range(len(a)))
            for m in range(1 << len(a))
            if (lambda s: all(x in s for x in [a[i] for i in range(len(a)) if m >> i & 1]))(iter(b))
        )
        assert len(found) == best


def test_pages_without_an_article_lose_what_neighbours_share(spark):
    make = lambda body: f"<body><div>Site</div><div>Menu of it</div><p>{body}</p><div>Imprint</div></body>"
    rows = [(1, "http://a.x/1", make("one")), (2, "http://a.x/2?q", make("two")), (3, "http://b.x/1", make("three"))]
    rows += [(4, None, None), (5, "http://c.x/", ""), (6, "http://d.x/1", make("same")), (7, "http://d.x/1", make("same"))]
    rows += [(None, "http://e.x/1", PAGE), (8, "nohost", make("four")), (8, "nohost", make("five"))]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        out = {(r["page_id"], r["text"]): r for r in html.extract(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert {k for k in out if k[0] in (1, 2, 4, 5)} == {(1, "one"), (2, "two"), (4, ""), (5, "")}
    whole = "Site\nMenu of it\n{}\nImprint".format
    assert {k[1] for k in out if k[0] in (3, 6, 7, 8)} == {whole(x) for x in ("three", "same", "four", "five")}
    assert all(r["n_chars"] == len(r["text"]) for r in out.values()) and len(out) == 10
    assert (None, text(PAGE)) in out
    assert html.extract(pages.limit(0)).count() == 0


def test_generated_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {}
    for row in pages.collect():
        body = re.search(r"<article>(.*)</article>", row["html"], re.S).group(1)
        parts = re.split(r"</?(?:p|h1)[^>]*>", body)
        lines = [" ".join(unescape(re.sub(r"<[^>]*>", " ", part)).split()) for part in parts]
        want[row["page_id"]] = "\n".join(line for line in lines if line)
    assert {r["page_id"]: r["text"] for r in html.extract(pages).collect()} == want


def test_long_rests_are_aligned_as_one_sequence(monkeypatch):
    rng = random.Random(5)
    cases = [([rng.choice("wxyz") for _ in range(rng.randrange(30))], [rng.choice("wxyz") for _ in range(rng.randrange(30))]) for _ in range(200)]
    want = [len(html.shared_lines(a, b)) for a, b in cases]
    monkeypatch.setattr(html, "MOST_CELLS", 4)
    for (a, b), size in zip(cases, want, strict=True):
        found = sorted(html.difference(a, b))
        rest = iter(b)
        assert len(found) == size and all(line in rest for line in [a[i] for i in found])


def test_copies_are_compared_with_the_nearest_different_page(spark):
    make = lambda body, more="": f"<body><div>Site</div>{more}<p>{body}</p><div>Imprint</div></body>"
    rows = [(1, "http://a.x/1", make("one")), (2, "http://a.x/2", make("two")), (3, "http://a.x/3", make("two", "<!-- 3 -->"))]
    rows += [(i, "http://b.x/1", make("copy")) for i in range(10, 2010)] + [(2010, "http://b.x/2", make("end"))]
    rows += [(i, f"http://c.x/{i}", make(str(i))) for i in range(3000, 3040)]
    rows += [(4000, "http://d.x/1", make("first")), (4001, "http://d.x/2", None), (4002, "http://d.x/3", make("last"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    out = {r["page_id"]: r["text"] for r in html.extract(pages).collect()}
    want = {1: "one", 2: "two", 3: "two", 2010: "end", 4000: "first", 4001: "", 4002: "last"}
    want |= {i: "copy" for i in range(10, 2010)} | {i: str(i) for i in range(3000, 3040)}
    assert out == want


def test_differencing_judges_pages_with_articles_too(spark):
    teaser = "<article><h2>Most read</h2><p>{}</p></article>".format
    make = lambda own, read="Today": f"<body><p>Site</p><article><h1>{own}</h1><p>Shared line of text</p></article>{teaser(read)}</body>"
    rows = [(1, "http://a.x/1", make("one")), (2, "http://a.x/2", make("two")), (3, "http://a.x/3", make("two", "Other"))]
    rows += [(4, "http://b.x/1", make("alone")), (5, "http://a.x/2b", make("two")), (6, "nohost", make("none"))]
    out = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    both = "{}\nShared line of text\nMost read\n{}".format
    want = {1: "one\nShared line of text", 2: "two\nShared line of text", 5: "two\nShared line of text", 3: both("two", "Other")}
    assert out == want | {4: both("alone", "Today"), 6: both("none", "Today")}


def test_neighbours_of_a_large_host_follow_the_order(spark):
    rng = random.Random(9)
    rows = [(f"h{rng.choice('aaaaab')}.x", bytes([i // 256, i % 256]), rng.choice("abc") * rng.randrange(3), i) for i in range(400)]
    rows += [("one.x", b"t", "p", 1)]
    frame = spark.createDataFrame(rows, "host string, tag binary, path string, page_id long")
    classes = frame.select("host", "tag", F.struct("path", "page_id").alias("first")).repartition(5)
    want = set()
    for host in {row[0] for row in rows}:
        tags = [tag for _, tag, path, i in sorted((r for r in rows if r[0] == host), key=lambda r: (r[2], r[3]))]
        want |= {(host, tag, tags[i - 1] if i else tags[1]) for i, tag in enumerate(tags) if len(tags) > 1}
    got = [(r["host"], bytes(r["tag"]), bytes(r["other"])) for r in html._neighbours(classes).collect()]
    assert len(got) == len(want) and set(got) == want
