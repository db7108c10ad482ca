"""Main text of web pages: structure, and nearest-URL page differencing of every page.

Markup is read once, tag by tag. Elements that never hold an article (menus, footers, side
bars, forms, scripts, styles ...), and those whose class, id or role says so, are dropped.
If what remains has an article or main element, its blocks are the text, but for those that
differencing finds to be the site's: lines that the page shares with a neighbour and that
nearly all runs of pages of the host have, if these are ``SITE_RUNS`` or more.

Other pages don't say where their text lies, and differencing alone decides. Lines are
compared with those of the nearest pages that are not copies: of pages with the same lines on a host one is taken, and
these are ordered by host and URL path. Neighbours that share most of each other's text are
a run of copies; the nearest page beyond the run on either side, on the same host, is
aligned with the page by longest common subsequence, and shared lines are deleted. Should
it share most of the page's text all the same, the next run is tried, and so on through
``REACH`` runs. What is shared is counted without the lines that nearly all runs of the host
have, so short articles in a large frame are no copies. Where all pages of a host share most
of their text, lines that nearly all have are taken for a frame, if there are three pages;
an article that stands on all of them goes then as well. Inside an article element lines go
only with most of a host's runs behind them, since articles, and passages of them, are
copied between pages and whole articles are wanted.

Pages are ordered by a range exchange that carries line hashes, not pages, so a host may
hold any share of them. Each task gets the outermost runs of all ranges, so where a range
ends makes no difference.

Null html gives empty text, a null url a host of its own. Pages of one URL are neighbours.
Repeated rows give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256
from html import unescape
from urllib.parse import urlsplit
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewright.llm._shared import by_value, discard, frugal, mark, sliced, store, table

#: Names of HTML elements.
RAW = frozenset("script style textarea title xmp noscript template iframe noembed noframes".split())
DROPPED = frozenset("nav footer aside form button select menu dialog head svg canvas object audio video map label input".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark meter nobr output progress q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words in class, id or role that mark what stands beside an article.
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:nav(?:bar|igation)?|menus?|mega-?menu|breadcrumbs?|(?:site|page|top|main)?-?header|masthead|banner|footer|side-?bar|widgets?|complementary|contentinfo|search"
    r"|cookies?|consent|gdpr|notices?|alert|pop-?up|modal|overlay|toast|ads?|advert(?:s|isement|ising)?|sponsor(?:ed|s)?|promo(?:s|tion)?|teasers?|newsletter|subscribe|sign-?up|login"
    r"|shar(?:e|ing)|social|related|recommend(?:ed|ations)?|comments?|comment-?list|respond|disqus|reviews?|pagination|pager|tags|toolbar|skip-?link|print)(?:$|[\s_-])"
)
MAIN = re.compile(r"(?:^|[\s_-])(?:main|article|article-?body|post-?(?:body|content)|entry-?content|main-?content)(?:$|[\s_-])")
TAG = re.compile(r"<!--(?:.*?)(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.S)
MARKS = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
#: A neighbour that shares this part of a page's text, frame apart, is a copy.
COPY = 0.8
#: Lines in this part of a host's runs of copies are its frame; in a host of one run, of its pages, if these are several.
FRAME, SEVERAL = 0.9, 3
#: Runs that a host must have for lines inside an article to count as the site's.
SITE_RUNS = 8
#: Runs of copies that the search for a page that is not one goes through on each side.
REACH = 8
#: Cells of an alignment that are kept at once; larger ones are halved first.
CELLS = 1 << 26


class Page:
    """blocks: (text, number of the article that holds it or 0)."""

    def __init__(self, html: str) -> None:
        self.blocks: list[tuple[str, int]] = []
        self.articles = 0
        pending: list[str] = []
        # Open elements: (name, dropped, article before it).
        stack: list[tuple[str, bool, int]] = []
        article, dropping, at = 0, 0, 0

        def end_block() -> None:
            if pending:
                text = " ".join(unescape("".join(pending)).split())
                pending.clear()
                if text:
                    self.blocks.append((text, article))

        closing: dict[str, re.Pattern] = {}
        n = len(html)
        while at < n:
            m = TAG.search(html, at)
            if not dropping:
                pending.append(html[at : m.start() if m else n])
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if name in RAW and not m[1]:
                if name not in closing:
                    closing[name] = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I)
                end = closing[name].search(html, at)
                at = end.end() if end else n
                continue
            if name == "br":
                pending.append(" ")
                continue
            if name not in INLINE and not dropping:
                end_block()
            if m[1]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == name:
                        if not dropping:
                            end_block()
                        for _, dropped, before in stack[i:][::-1]:
                            dropping -= dropped
                            article = before
                        del stack[i:]
                        break
                continue
            if name in VOID or m[3].endswith("/"):
                continue
            marks = self.marks(m[3]) if m[3] else ""
            inside = article != 0
            drop = name in DROPPED or (name == "header" and not inside) or (bool(marks) and name not in ("html", "body") and not (name in ("article", "main") and not inside) and BESIDE.search(marks) is not None)
            if drop and not dropping:
                end_block()
            if name in ("p", "li", "option", "tr", "td", "th", "dt", "dd") and not drop:
                continue  # their ends are often left out; only their boundaries matter
            stack.append((name, drop, article))
            dropping += drop
            if not dropping and not inside and (name in ("article", "main") or (marks and MAIN.search(marks) and name in ("div", "section"))):
                end_block()
                self.articles += 1
                article = self.articles
        if not dropping:
            end_block()

    @staticmethod
    def marks(attributes: str) -> str:
        words = []
        for m in MARKS.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            key = m[1].lower()
            if key == "hidden" or (key == "aria-hidden" and value == "true"):
                words.append("popup")
            elif key != "aria-hidden":
                words.append(value)
        return " ".join(words)

    def main_places(self) -> list[int] | None:
        """Places of the blocks of the article with the most text; None if no element is one."""
        size: dict[int, int] = {}
        for text, number in self.blocks:
            size[number] = size.get(number, 0) + len(text)
        size.pop(0, None)
        if not size:
            return None
        best = max(size, key=lambda k: (size[k], -k))
        return [i for i, (_, number) in enumerate(self.blocks) if number == best]

    def main(self) -> list[str] | None:
        places = self.main_places()
        return None if places is None else [self.blocks[i][0] for i in places]


def lcs_lengths(a: list[int], b: list[int]) -> list[int]:
    """After each row of ``a``, a bit row over ``b``: a 0 bit where the length of the common subsequence grows."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full, v, rows = (1 << len(b)) - 1, (1 << len(b)) - 1, []
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    return rows


def shared(a: list[int], b: list[int]) -> list[bool]:
    """For each line of ``a``, whether a longest common subsequence with ``b`` holds it."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    if not x or not y:
        middle = [False] * len(x)
    elif len(x) > 1 and len(x) * len(y) > CELLS:
        half = len(x) // 2
        fore, back = lcs_lengths(x[:half], y)[-1], lcs_lengths(x[half:][::-1], y[::-1])[-1]
        # Where to cut y, so that both halves' lengths add up to the most.
        up, down = [0], [0]
        for j in range(len(y)):
            up.append(up[-1] + (not fore >> j & 1))
            down.append(down[-1] + (not back >> j & 1))
        cut = max(range(len(y) + 1), key=lambda j: up[j] + down[len(y) - j])
        middle = shared(x[:half], y[:cut]) + shared(x[half:], y[cut:])
    else:
        rows = lcs_lengths(x, y)
        middle, j = [False] * len(x), len(y) - 1
        for i in range(len(x) - 1, -1, -1):
            # Back through the columns that add nothing to the length that row i reaches.
            while j >= 0 and rows[i] >> j & 1:
                j -= 1
            if j < 0:
                break
            if i == 0 or rows[i - 1] >> j & 1:
                middle[i] = True
                j -= 1
    return [True] * head + middle + [True] * tail


def line_hash(text: str) -> int:
    data = text.encode("utf-8", "surrogatepass")
    return crc32(data) << 31 | (crc32(data, 0x5BD1E995) >> 1)


def address(url: str | None) -> tuple[str, str]:
    try:
        parts = urlsplit(url or "")
    except ValueError:
        return "", url or ""
    return parts.netloc.lower(), parts.path


READ = "page_id long, url string, host string, path string, settled boolean, lines array<string>, places array<int>, digest string, hashes array<long>, sizes array<int>"
EDGE = "part long, run long, host string, digest string, hashes array<long>, sizes array<int>, frame array<long>"
GONE = "host string, digest string, gone array<boolean>, site array<boolean>"


def read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string()), ("settled", pa.bool_()), ("lines", pa.list_(pa.string())), ("places", pa.list_(pa.int32()))]
    kinds += [("digest", pa.string()), ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))]
    for batch in sliced(batches, 2):
        out = []
        for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            page = Page(html or "")
            places = page.main_places()
            host, path = address(url)
            texts = [t for t, _ in page.blocks]
            hashes = np.array([line_hash(t) for t in texts], dtype=np.int64)
            row = {"page_id": page_id, "url": url, "host": host, "path": path, "settled": places is not None, "lines": texts if places is None else [texts[i] for i in places], "places": range(len(texts)) if places is None else places}
            out.append(row | {"digest": sha256(hashes.tobytes()).hexdigest()[:32], "hashes": hashes, "sizes": [len(t) for t in texts]})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kinds))


class Lines:
    """The lines of a page, and those of them that are not of its host's frame."""

    def __init__(self, row: dict) -> None:
        self.host, self.digest = row["host"], row["digest"]
        self.row = row
        self.hashes = np.array(row["hashes"], dtype=np.int64)
        sizes = np.array(row["sizes"], dtype=np.int64)
        own = ~np.isin(self.hashes, np.array(row.get("frame") or [], dtype=np.int64))
        self.framed = ~own
        self.rest, self.sizes = self.hashes[own], sizes[own]
        self.total = int(self.sizes.sum())

    def copied_by(self, other: Lines) -> bool:
        """Whether ``other`` shares most of this page's text, frame apart."""
        if not self.total:
            return False
        common = shared(self.rest.tolist(), other.rest.tolist())
        return int(self.sizes[np.array(common, dtype=bool)].sum()) >= COPY * self.total


def same_run(a: Lines, b: Lines) -> bool:
    return a.host == b.host and a.copied_by(b) and b.copied_by(a)


def runs_of(pages: list[Lines]) -> list[list[Lines]]:
    runs: list[list[Lines]] = []
    for page in pages:
        if runs and same_run(runs[-1][-1], page):
            runs[-1].append(page)
        else:
            runs.append([page])
    return runs


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[Lines]]]:
    """The pages of each range, in order."""
    part, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["part"] != part:
                yield part, held
                held = []
            part = row["part"]
            held.append(Lines(row))
    if held:
        yield part, held


def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last page of the outermost runs of each range."""
    kinds = [("part", pa.int64()), ("run", pa.int64()), ("host", pa.string()), ("digest", pa.string()), ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("frame", pa.list_(pa.int64()))]
    for _, pages in parts(batches):
        runs = runs_of(pages)
        near = [i for i in range(len(runs)) if i <= REACH or i >= len(runs) - 1 - REACH]
        out = [page.row | {"run": i} for i in near for page in (runs[i] if len(runs[i]) == 1 else (runs[i][0], runs[i][-1]))]
        yield pa.RecordBatch.from_pylist([{k: r[k] for k, _ in kinds} for r in out], schema=pa.schema(kinds))


def differ(around: dict[int, list[list[Lines]]]):
    """``around``: by range, its outermost runs."""

    def joined(runs: list[list[Lines]], more: list[list[Lines]]) -> list[list[Lines]]:
        if runs and more and same_run(runs[-1][-1], more[0][0]):
            return [*runs[:-1], runs[-1] + more[0], *more[1:]]
        return runs + more

    def beside(part: int, step: int, host: str) -> list[list[Lines]]:
        """Runs of ``host`` beyond the range's edge, as many as can be reached."""
        runs: list[list[Lines]] = []
        at = part + step
        while min(around) <= at <= max(around) and len(runs) <= REACH + 1:
            more = around.get(at, [])
            ours = [r for r in more if r[0].host == host]
            runs = joined(ours, runs) if step < 0 else joined(runs, ours)
            if len(ours) < len(more):
                break
            at += step
        return runs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("host", pa.string()), ("digest", pa.string()), ("gone", pa.list_(pa.bool_())), ("site", pa.list_(pa.bool_()))])
        for part, pages in parts(batches):
            own = {id(p) for p in pages}
            runs = joined(joined(beside(part, -1, pages[0].host), runs_of(pages)), beside(part, 1, pages[-1].host))
            out = []
            for i, members in enumerate(runs):
                before, after = [r[-1] for r in runs[max(i - REACH, 0) : i][::-1]], [r[0] for r in runs[i + 1 : i + 1 + REACH]]
                for page in members:
                    if id(page) not in own:
                        continue
                    gone = np.zeros(len(page.hashes), dtype=bool)
                    for side in (before, after):
                        other = next((x for x in side if x.host != page.host or not page.copied_by(x)), None)
                        if other and other.host == page.host:
                            gone |= np.array(shared(page.hashes.tolist(), other.hashes.tolist()), dtype=bool)
                    site = gone & page.framed if page.row["several"] else np.zeros(len(gone), dtype=bool)
                    out.append({"host": page.host, "digest": page.digest, "gone": gone.tolist(), "site": site.tolist()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


DEALT = "host string, path string, page_id long, digest string, hashes array<long>, sizes array<int>, part long"


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with the number of their run in their range, and whether they are the first or last of it."""
    for _, pages in parts(batches):
        out, last = [], len(pages) - 1
        for number, members in enumerate(runs_of(pages)):
            out += [{**{k: v for k, v in m.row.items() if k not in ("frame", "several")}, "run": number, "edge": False} for m in members]
        out[0]["edge"] = out[last]["edge"] = True
        kinds = [("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()), ("hashes", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([*kinds, ("part", pa.int64()), ("run", pa.int64()), ("edge", pa.bool_())]))


def framed(pages: DataFrame) -> DataFrame:
    """``pages`` (DEALT, in order) with the line hashes of their host's frame: those that nearly all its runs of copies have.

    Of a host whose pages are one run, those that nearly all pages have, if these are several.
    """
    placed = store(pages.mapInArrow(numbered, DEALT + ", run long, edge boolean"), "html-runs")
    ends: dict[int, list[dict]] = {}
    for row in placed.filter("edge").toArrow().to_pylist():
        ends.setdefault(row["part"], []).append(row | {"frame": None})
    # A run that goes on over the edge of a range has the number it has where it begins.
    names: dict[tuple[int, int], str] = {}
    before = None
    for part in sorted(ends):
        rows = sorted(ends[part], key=lambda r: (r["run"], r["host"], r["path"], r["page_id"] if r["page_id"] is not None else -(1 << 63), r["digest"]))
        if before and same_run(Lines(before), Lines(rows[0])):
            names[part, 0] = names.get((before["part"], before["run"]), f"{before['part']}:{before['run']}")
        before = rows[-1]
    renamed = placed.sparkSession.createDataFrame([(*k, v) for k, v in names.items()], "part long, run long, name string")
    placed = placed.join(F.broadcast(renamed), ["part", "run"], "left").withColumn("unit", F.coalesce("name", F.concat_ws(":", "part", "run")))
    counted = placed.groupBy("host", "unit").agg(F.count(F.lit(1)).alias("n")).groupBy("host").agg(F.count(F.lit(1)).alias("runs"), F.sum("n").alias("pages"))
    counted = counted.select("host", (F.col("runs") == 1).alias("alone"), F.when(F.col("runs") > 1, F.col("runs")).when(F.col("pages") >= SEVERAL, F.col("pages")).alias("all")).filter(F.col("all").isNotNull())
    units = placed.join(counted, "host").withColumn("unit", F.when(F.col("alone"), F.col("digest")).otherwise(F.col("unit")))
    lines = units.select("host", "all", "unit", F.explode("hashes").alias("hash")).distinct().groupBy("host", "all", "hash").agg(F.count(F.lit(1)).alias("n"))
    frames = lines.filter(F.col("n") >= F.lit(FRAME) * F.col("all")).groupBy("host").agg(F.collect_list("hash").alias("frame"))
    several = counted.select("host", (~F.col("alone") & (F.col("all") >= SITE_RUNS)).alias("several"))
    out = placed.drop("run", "edge", "name", "unit").join(frames, "host", "left").join(several, "host", "left")
    return out.withColumn("several", F.coalesce("several", F.lit(False)))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text of every row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    read = store(rows.mapInArrow(frugal(read_pages), READ), "html-pages")
    after = mark()  # of the tables from here on, each is deleted once the next is stored
    first = F.min(F.struct("path", "page_id")).alias("first")
    unlike = read.groupBy("host", "digest").agg(first, F.first("hashes").alias("hashes"), F.first("sizes").alias("sizes"))
    unlike = store(unlike, "html-unlike").select("host", "first.path", "first.page_id", "digest", "hashes", "sizes")
    order = ("host", "path", "page_id", "digest")
    dealt = store(unlike.repartitionByRange(*order).withColumn("part", F.spark_partition_id().cast("long")), "html-dealt")
    discard(after, 1)
    in_order = lambda df: df.repartition("part").sortWithinPartitions("part", *order)
    ordered = in_order(store(framed(in_order(dealt)), "html-framed"))
    discard(after, 1)
    around: dict[int, dict[int, list[Lines]]] = {}
    for row in sorted(ordered.mapInArrow(edges, EDGE).toArrow().to_pylist(), key=lambda r: (r["part"], r["run"])):
        around.setdefault(row["part"], {}).setdefault(row["run"], []).append(Lines(row))
    gone = store(ordered.mapInArrow(differ({k: list(v.values()) for k, v in around.items()}), GONE), "html-gone")
    discard(after, 1)
    # Few hosts repeat lines inside their articles, so what settled pages are joined with is small, and their texts stay where they are.
    site = store(gone.filter(F.exists("site", lambda x: x)).select("host", "digest", "site"), "html-site")
    ours = lambda i: F.coalesce(F.element_at("site", F.element_at("places", i + 1) + 1), F.lit(False))
    kept = lambda drop: F.array_join(F.filter("lines", lambda t, i: ~drop(i)), "\n").alias("text")
    settled = read.filter("settled").join(site, ["host", "digest"], "left").select("page_id", "url", kept(ours))
    silent = read.filter("NOT settled").join(gone.select("host", "digest", "gone"), ["host", "digest"])
    return settled.union(silent.select("page_id", "url", kept(lambda i: F.element_at("gone", i + 1))))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


by_value(__name__)
