"""What needs a page's structure: dated links, values in script payloads, job links.

Pages are parsed where they lie, in Arrow batches, in time linear in the page; what a rule
can decide on columns is left to columns.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions import subjects
from tidewater.functions.dates import is_recent
from tidewater.functions.text import has_substring

# Fixed values.
CHANGELOG_WORDS = (
    "api", "sdk", "developer", "changelog", "release", "released",
    "update", "updates", "new", "beta", "ga", "graphql", "webhook",
    "checkout", "payments", "merchant", "admin", "app", "apps",
    "support", "supports", "enabled", "enables", "default", "custom",
    "order", "discount", "import", "duty", "b2b",
)
SKIPPED_ADDRESSES = (
    "/reports/", "/review/", "funding-review", "women-founders", "greater-china", "southeast-asia", "private-equity", "lp-view", "startup-watch",
    "category=", "/about", "/products/", "/investor$", "/investors/$", "/quarterlyresults", "/annualreports", "/financial-information",
    "/corporategovernance", "/current-reports", "#results-center", "/sustainability/", "/financial-reports", "/presentations",
)
FUNCTION_WORDS = {
    "ai": (" ai ", "machine learning", "artificial intelligence", "data science"),
    "engineering": ("engineer", "developer", "platform", "infrastructure", "architect"),
    "payments": ("payment", "fintech", "financial services", "treasury"),
    "compliance": ("compliance", "risk", "privacy", "legal", "regulatory"),
    "partnerships": ("partner", "partnership", "ecosystem"),
    "sales": ("sales", "account executive", "business development", "growth"),
    "operations": ("operations", "ops ", "support", "people"),
}
_MONTH = "(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
#: What a date rule could read in a text.
_DATES = re.compile(rf"20\d\d-\d{{1,2}}-\d{{1,2}}|\b{_MONTH}\.? \d{{1,2}}(?:st|nd|rd|th)?(?:,? 20\d\d)?|\d{{1,2}} {_MONTH}\.?,? 20\d\d", re.I)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: An open element of these ends where another begins.
_SELF_CLOSED = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}


class Tree(HTMLParser):
    """Elements with their parents, and the place of their text in the text of the page."""

    def __init__(self, html: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.parent: list[int] = []
        self.span: list[list[int]] = []
        self.links: list[tuple[int, str]] = []
        self.pieces: list[str] = []
        self.size, self.open, self.names = 0, [], []
        self.feed(html or "")
        self.close()
        for node in self.open:
            self.span[node][1] = self.size
        self.text = " ".join(self.pieces)

    def handle_starttag(self, tag, attrs):
        if tag in _SELF_CLOSED and self.open and self.names[self.open[-1]] == tag:
            self._end(len(self.open) - 1)
        node = len(self.parent)
        self.parent.append(self.open[-1] if self.open else -1)
        self.span.append([self.size, self.size])
        self.names.append(tag)
        if tag == "a" and (href := dict(attrs).get("href")) is not None:
            self.links.append((node, href))
        if tag not in _VOID:
            self.open.append(node)

    def handle_data(self, data):
        words = " ".join(data.split())
        if words and not (self.open and self.names[self.open[-1]] in ("script", "style")):
            self.pieces.append(words)
            self.size += len(words) + 1

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.names[self.open[depth]] == tag:
                self._end(depth)
                break

    def _end(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.span[node][1] = self.size
        del self.open[depth:]

    def text_of(self, node: int) -> str:
        start, stop = self.span[node]
        return self.text[start : max(start, stop - 1)]

    def climb(self, node: int, most: int) -> Iterator[int]:
        """The node and up to ``most`` elements above it, from the inside out."""
        for _ in range(most + 1):
            if node < 0:
                return
            yield node
            node = self.parent[node]


def dated_anchors(html: str | None, base: str | None, climb: int = 6) -> list[tuple[int, str, str, list[str]]]:
    """(position, absolute link, text, dates) of the links of a page.

    ``dates`` has, for the link and each element above it, what looks like a
    date in it.  Dates are looked for once in the page, and an element takes those
    inside it: the first full one and the first without a year are enough.
    """
    tree = Tree(html)
    spots = [(m.start(), m.end(), m[0]) for m in _DATES.finditer(tree.text)]
    starts = [s for s, _, _ in spots]
    full = [bool(re.search(r"20\d\d", t)) for _, _, t in spots]
    following = {True: [len(spots)] * (len(spots) + 1), False: [len(spots)] * (len(spots) + 1)}
    for i in range(len(spots) - 1, -1, -1):
        for kind in (True, False):
            following[kind][i] = i if full[i] is kind else following[kind][i + 1]
    found = []
    for position, (node, href) in enumerate(tree.links):
        dates = []
        for above in tree.climb(node, climb):
            start, stop = tree.span[above]
            first = bisect_left(starts, start)
            inside = sorted(k for kind in (True, False) if (k := following[kind][first]) < len(spots) and spots[k][1] <= stop)
            dates.append(" | ".join(spots[k][2] for k in inside))
        try:
            link = urljoin(base or "", href)
        except ValueError:  # a malformed address stays as it stands
            link = href
        found.append((position, link, tree.text_of(node).lstrip("•·-–— ").strip(), dates))
    return found


def _parsed(pages: DataFrame, columns: list[str], row: Callable[..., Iterable[tuple]], schema: str, types: list[pa.DataType]) -> DataFrame:
    """Rows that ``row`` makes of the columns of each page."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for batch in batches:
            made = [r for values in zip(*(c.to_pylist() for c in batch.columns), strict=True) for r in row(*values)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in made], t) for k, t in enumerate(types)], names=names)

    return pages.select(*columns).mapInArrow(run, schema)


def same_host(link: Column, base: Column) -> Column:
    """Whether a link stays on the host of its page, with or without www."""
    host = lambda url: F.replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit("www."), F.lit(""))
    return F.coalesce(link.startswith("http") & (host(link) == host(base)), F.lit(False))


def changelog_items(pages: DataFrame, as_of: str, words: Iterable[str] = CHANGELOG_WORDS, shortest: int = 18, longest: int = 180, days: int = 2, scanned: int = 100, most: int = 4) -> DataFrame:
    """(page_id, position, title, link, published_at, scheduled_at, basis, confidence): the entries of changelog pages.

    Of the first ``scanned`` links of a page (page_id, url, html): those on its own host, not on a
    skipped path, with a title of fitting length that holds one of ``words``.
    The date is the first that the link's address or title, its own text or that of an
    element above it gives, from the inside out, up to six.  Entries older than
    ``days`` go, those without a date stay; repeated links count once, and the first
    ``most`` of a page are taken.  Null pages and pages without links give no rows.
    """
    anchors = _parsed(
        pages, ["page_id", "url", "html"], lambda i, url, html: ((i, url, *a) for a in dated_anchors(html, url)), "page_id long, url string, position int, link string, title string, dates array<string>",
        [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string())],
    )
    observed = F.lit(as_of).cast("date")
    lower = F.lower("title")
    allowed = (F.col("position") < scanned) & F.length("title").between(shortest, longest) & same_host(F.col("link"), F.col("url"))
    rows = anchors.filter(allowed & has_substring(lower, words) & ~has_substring(F.lower("link"), SKIPPED_ADDRESSES))
    # A row for each text that differs from those inside it, so that its date is read once.
    tried = rows.select("page_id", "position", "title", "link", F.posexplode(F.array_distinct("dates")).alias("above", "text"))
    tried = tried.withColumn("meta", subjects.article_date(F.col("link"), F.col("title"), F.col("text"), observed))
    known = F.min_by("meta", F.when(F.col("meta.published_at").isNotNull(), F.col("above")))
    rows = tried.groupBy("page_id", "position", "title", "link").agg(F.coalesce(known, F.max_by("meta", "above")).alias("meta"))
    rows = rows.filter(is_recent(F.col("meta.published_at"), observed, days))
    once = rows.withColumn("nth", F.row_number().over(Window.partitionBy("page_id", "link").orderBy("position"))).filter("nth = 1")
    ranked = once.withColumn("nth", F.row_number().over(Window.partitionBy("page_id").orderBy("position"))).filter(F.col("nth") <= most)
    return ranked.select("page_id", "position", "title", "link", "meta.published_at", "meta.scheduled_at", "meta.basis", "meta.confidence")


_STRING = re.compile(r'[^"\\]*(?:\\.[^"\\]*)*', re.S)
_SCRIPT_ESCAPE = re.compile(r"\\(?:u([0-9a-fA-F]{4})|(.))", re.S)
_TOKENS = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[\[\]{}]', re.S)
_PLAIN = {"n": "\n", "t": "\t"}


def script_strings(html: str | None, opening: str = 'self.__next_f.push([1,"') -> Iterator[str]:
    """The strings, unescaped, that scripts pass after ``opening``; one without an end is left out."""
    at, html = 0, html or ""
    while (at := html.find(opening, at)) >= 0:
        start = at + len(opening)
        stop = _STRING.match(html, start).end()
        at = start
        if html.startswith('"', stop):
            at = stop
            yield _SCRIPT_ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else _PLAIN.get(m[2], m[2]), html[start:stop])


def bracketed(text: str, name: str) -> str | None:
    """The array after ``"name"``, up to the bracket that closes it; brackets within strings do not count."""
    at = text.find(f'"{name}"')
    start = text.find("[", at) if at >= 0 else -1
    depth = 0
    for token in _TOKENS.finditer(text, start) if start >= 0 else ():
        depth += {"[": 1, "{": 1, "]": -1, "}": -1}.get(token[0], 0)
        if depth == 0:
            return text[start : token.end()]
    return None


def embedded_values(pages: DataFrame, name: str) -> DataFrame:
    """(page_id, position, value): the elements of the first array ``name`` in the script payloads of each page, as VARIANT.

    Payloads that are cut off, arrays that do not close and texts that do not
    parse give no rows; the next payload is tried.
    """
    found = lambda i, html: ((i, k, a) for k, s in enumerate(script_strings(html)) if (a := bracketed(s, name)))
    texts = _parsed(pages, ["page_id", "html"], found, "page_id long, nth int, text string", [pa.int64(), pa.int32(), pa.string()])
    parsed = texts.withColumn("value", F.try_parse_json("text")).filter("value is not null")
    first = parsed.groupBy("page_id").agg(F.min_by("text", "nth").alias("text"))
    values = F.try_variant_get(F.try_parse_json("text"), "$", "array<variant>")
    return first.select("page_id", F.posexplode(values).alias("position", "value"))


def job_id(url: str) -> str:
    """The UUID or the long number in an address, else the end of its path."""
    path = urlparse(url).path.rstrip("/")
    found = re.search(r"([0-9a-f]{8}-[0-9a-f-]{27}|\d{6,})", path, re.I)
    return (found[1] if found else path.rsplit("/", 1)[-1]).lower()


def page_jobs(html: str | None, base: str | None, pattern: str | None, most: int = 120) -> list[tuple[str, str, str]]:
    """(id, title, url) of the job links of a page: a link is taken unless one with its id or title was."""
    if not pattern or not html:
        return []
    tree, rule = Tree(html), re.compile(pattern, re.I)
    ids, titles, found = set(), set(), []
    for node, href in tree.links:
        try:
            url = urljoin(base or "", href)
            path = urlparse(url).path
        except ValueError:
            continue
        if not rule.search(path) or (number := job_id(url)) in ids:
            continue
        title = tree.text_of(node) or path.rstrip("/").rsplit("/", 1)[-1].replace("-", " ")
        mark = re.sub(r"[^a-z0-9]+", "", title.lower())
        if mark in titles:
            continue
        ids.add(number)
        titles.add(mark)
        found.append((number, title, url))
        if len(found) == most:
            break
    return found


def function_tags(title: Column) -> Column:
    """The functions that a job title speaks of."""
    text = F.concat(F.lit(" "), F.lower(F.coalesce(title, F.lit(""))), F.lit(" "))
    return F.array_compact(F.array(*(F.when(has_substring(text, words), F.lit(tag)) for tag, words in FUNCTION_WORDS.items())))


def job_links(pages: DataFrame, rules: DataFrame, most: int = 120) -> DataFrame:
    """(entity, job, title, url, tags): job links of boards (entity, url, html), each by the path pattern of its entity.

    ``rules`` has entity and pattern; a board without a rule, or without a page, gives no rows.
    """
    ruled = pages.join(rules.groupBy("entity").agg(F.min("pattern").alias("pattern")), "entity")
    rows = _parsed(ruled, ["entity", "url", "html", "pattern"], lambda e, url, html, p: ((e, *j) for j in page_jobs(html, url, p, most)), "entity string, job string, title string, url string", [pa.string()] * 4)
    return rows.withColumn("tags", function_tags(F.col("title")))


def carried_snapshot(previous: DataFrame, current: DataFrame, boards: DataFrame) -> DataFrame:
    """The next snapshot (entity, job, ...): jobs of every board that was read and gave some, else those of the one before.

    A board (entity, fetched) that failed, or from which nothing could be read, and an entity
    without a board keep what they had, so one failure neither removes nor adds jobs.
    """
    read = boards.filter("fetched").select("entity").distinct().join(current.select("entity").distinct(), "entity")
    return current.join(read, "entity", "left_semi").unionByName(previous.join(read, "entity", "left_anti"))


def snapshot_as_of(spark: SparkSession, path: str, keys: list[str], day: str, first: str | None = None) -> DataFrame:
    """Per key the row of the latest snapshot not after ``day``, from folders ``date_key=...``; only those are listed that can hold it."""
    rows = spark.read.parquet(path)
    kept = rows.filter((F.col("date_key") <= F.lit(day).cast("date")) & ((F.col("date_key") >= F.lit(first).cast("date")) if first else F.lit(True)))
    rest = [c for c in rows.columns if c not in keys]
    return kept.groupBy(*keys).agg(F.max_by(F.struct(*rest), "date_key").alias("row")).select(*keys, "row.*")
