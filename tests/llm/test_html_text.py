import random

from tracewright.llm import html_text
from tracewright.llm.html_text import Page, shared


def text(html):
    return "\n".join(Page(html).main() or [])


def test_article():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head><body>
    <header>Site</header><nav><ul><li><a href="/x">Menu</a></ul></nav><!-- <article>no</article> --><div class="ad">Buy</div><div id='cookie-notice'>We use</div>
    <article><header><h1>Head &amp; line</h1></header><p><b>One\n two<br>three<p>Four &lt;five&gt; &#233;&amp;amp; &copy 2020</p><aside>Side</aside>
    <form>Mail</form><ul><li>a<li>b</ul><div class="share">Tweet</div><section class="comments"><article><p>First!</p></article></section>
    <table><tr><td>c</td><td>d</td></tr></table><p></p></article><div class="related">More</div><footer>&copy; end</footer></body></html>"""
    assert text(html) == "Head & line\nOne two three\nFour <five> é&amp; © 2020\na\nb\nc\nd"


def test_odd_pages():
    assert text("<article>x") == "x"
    assert text("<article><p>a</article></body>tail") == "a"
    assert text("<article><p>1 < 2 &amp</p><p>&am</p></article>") == "1 < 2 &\n&am"
    assert text("<div class='entry-content'><p>a</p></div><div>b</div>") == "a"
    assert text("<article>short</article><article>the longer one</article>") == "the longer one"
    assert Page("").main() is None and Page("no markup").blocks == [("no markup", 0)]
    assert text("<article>a<script>if (1 < 2) x</article>") == "a"
    assert text("<main><p data-x='a>b'>c</p></main>") == "c"


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def subsequence(part, whole):
    rest = iter(whole)
    return all(x in rest for x in part)


def test_alignment(monkeypatch):
    rng = random.Random(4)
    for cells in (html_text.CELLS, 8):
        monkeypatch.setattr(html_text, "CELLS", cells)
        for _ in range(300):
            a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
            part = [x for x, s in zip(a, shared(a, b), strict=True) if s]
            assert len(part) == lcs(a, b) and subsequence(part, b)


def page(i, body, host="h.example"):
    return (i, f"http://{host}/a/{i}", f"<html><body>{body}</body></html>", 0)


def test_differencing(spark):
    frame = "<p>Welcome to the site</p>{}<p>All rights reserved</p>"
    bodies = [frame.format(f"<p>Story number {i} is about {i * 7919} things and goes on for a while, as stories of its kind do</p>") for i in range(6)]
    rows = [page(i, b) for i, b in enumerate(bodies)]
    rows += [page(10, bodies[0], "copy.example"), page(11, bodies[0], "copy.example"), (12, None, None, 0), page(13, "<article><p>Welcome to the site</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").coalesce(1)
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i].startswith(f"Story number {i} ") and "\n" not in got[i] for i in range(6))
    assert got[10] == got[11] and got[10].count("\n") == 2  # copies delete nothing
    assert got[12] == "" and got[13] == "Welcome to the site"
    assert html_text.extract(df.limit(0)).count() == 0


def test_copies_are_passed_over(spark):
    frame = "<p>Welcome to the site</p>{}<p>All rights reserved</p>"
    story = lambda i: f"<p>Story number {i} is about {i * 7919} things and goes on for a while, as stories of its kind do</p>"
    # Runs of equal and of nearly equal pages, between two others.
    rows = [page(100, frame.format(story(0)))] + [page(200 + i, frame.format(story(1))) for i in range(7)]
    rows += [page(300 + i, frame.format(story(2) + f"<p>Seen {i}</p>")) for i in range(30)] + [page(400, frame.format(story(3)))]
    # Short articles in a large frame.
    large = "<p>" + "Menu of the whole site " * 20 + "</p>{}<p>" + "Small print " * 30 + "</p>"
    rows += [page(500 + i, large.format(f"<p>Short one, {i * 31}</p>"), "short.example") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    want = {100: 0, 400: 3} | {200 + i: 1 for i in range(7)} | {300 + i: 2 for i in range(30)}
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for ranges in (1, 23):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            got = {r["page_id"]: r["text"].split("\n") for r in html_text.extract(df).collect()}
            assert len(got) == len(rows)
            for i, n in want.items():
                assert got[i][0].startswith(f"Story number {n} ") and got[i][1:] == ([f"Seen {i - 300}"] if n == 2 else []), (ranges, i)
            assert all(got[500 + i] == [f"Short one, {i * 31}"] for i in range(9))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


def test_query(spark, sf_dir):
    rows = html_text.op7_html(spark, sf_dir).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert sorted(r["page_id"] for r in rows) == sorted(pages)
    for r in rows:
        inner = pages[r["page_id"]].split("<article>", 1)[1].split("</article>")[0]
        import html
        import re

        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_site_lines_inside_articles_go_whatever_the_partitions(spark):
    """Lines that all pages of a large host repeat inside their article elements go; passages that some articles share stay."""
    passage = "<p>A passage that two of the articles share, long enough to be worth keeping in both of them</p>"
    body = lambda i: f"<article><p>Share this story with friends</p><h1>Story {i * 7919}</h1><p>It is told here at some length, with {i * 31} details of its own</p>{passage if i in (3, 4) else ''}<p>Read on at our site</p></article>"
    rows = [page(i, body(i)) for i in range(20)] + [page(50 + i, body(100 + i), "small.example") for i in range(5)] + [page(80 + i, body(7), "copies.example") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for ranges in (1, 8, 61):
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
            got = {r["page_id"]: r["text"].split("\n") for r in html_text.extract(df).collect()}
            for i in range(20):
                assert got[i][0] == f"Story {i * 7919}" and len(got[i]) == (3 if i in (3, 4) else 2), (ranges, i, got[i])
            # Too few pages, or copies of one page only: all stays.
            assert all(len(got[i]) == 4 for i in (*range(50, 55), *range(80, 89)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
