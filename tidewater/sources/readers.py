"""Readers and writers at the edges: JSON stores, feeds, HTML, bronze fetches, Atom."""

from __future__ import annotations

import json
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidewater.functions import dates
from tidewater.functions.text import first_text, html_escaped, shortened, tokens, xml_decoded

EVENT_SCHEMA = """title string, url string, source string, source_tier string, source_id string, event_types array<string>, score int, region string,
 date string, company_name string, companies array<string>, summary_short string, reason string, impact string, scope_enforced boolean, scope_status string"""
_STORE = f"map<string, array<struct<{EVENT_SCHEMA.replace(' string', ': string').replace(' array', ': array').replace(' int', ': int').replace(' boolean', ': boolean')}>>>"
FEED_SCHEMA = "title string, link string, published string, updated string, description string, source string"


def flatten_store(raw: DataFrame, column: str = "value") -> DataFrame:
    """Events of a date-bucketed JSON store; an event without a date takes its bucket's.

    Also reads the older form, a plain list.  ``ord`` is (bucket, position): the
    input order.  Text that is neither gives no rows.
    """
    listed = F.when(F.trim(F.col(column)).startswith("["), F.concat(F.lit('{"":'), F.col(column), F.lit("}"))).otherwise(F.col(column))
    store = raw.select(F.from_json(listed, _STORE).alias("store"))
    buckets = store.select(F.explode("store").alias("bucket", "events"))
    rows = buckets.select("bucket", F.posexplode("events").alias("position", "event"))
    dated = F.coalesce(F.nullif("event.date", F.lit("")), F.nullif("bucket", F.lit("")))
    return rows.select("bucket", "position", *(f"event.{c.split()[0]}" for c in EVENT_SCHEMA.split(", ") if c.split()[0] != "date"), dated.alias("date"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return flatten_store(spark.read.text(path, wholetext=True))


def read_snapshots(spark: SparkSession, path: str, schema: str | StructType, first: str, last: str) -> DataFrame:
    """Daily JSON archives under ``date_key=...`` folders; the range prunes partitions."""
    rows = spark.read.schema(schema).json(path)
    return rows.filter(F.col("date_key").between(F.lit(first), F.lit(last)))


def first_titles(archive: DataFrame, limit: int = 10) -> DataFrame:
    """The earliest row of each title, re-ranked by date and rank, the first ``limit``."""
    once = archive.withColumn("nth", F.row_number().over(Window.partitionBy("title").orderBy("date_key", "rank"))).filter("nth = 1")
    return once.orderBy("date_key", "rank", "title").limit(limit).select("date_key", "rank", "title")


# Parts of addresses that say nothing about an article.
URL_STOPWORDS = ("www", "com", "org", "net", "html", "htm", "amp", "article", "news", "post", "posts", "the", "and", "for", "with", "from", "into", "after")


def best_link(title: Column, candidates: Column, least: int = 2) -> Column:
    """struct(link, original) from the addresses of a feed entry, in their order.

    The first http(s) address stands, unless another one shares at least ``least``
    words of its path with the title, and more than the first does; ``original`` is
    then the first.  Both are null without an address.
    """
    urls = F.array_distinct(F.filter(F.transform(F.array_compact(candidates), lambda u: F.trim(u)), lambda u: u.startswith("http://") | u.startswith("https://")))

    def ranked(url: Column, place: Column) -> Column:
        shared = F.array_intersect(tokens(title, URL_STOPWORDS), tokens(F.try_parse_url(url, F.lit("PATH")), URL_STOPWORDS))
        return F.struct(F.size(shared).alias("score"), (-place).alias("place"), url.alias("url"))

    def decided(scored: Column) -> Column:
        first, best = F.try_element_at(scored, F.lit(1)), F.array_max(scored)
        repaired = (best["score"] >= least) & (best["score"] > first["score"])
        return F.struct(F.when(repaired, best["url"]).otherwise(first["url"]).alias("link"), F.when(repaired, first["url"]).alias("original"))

    return F.element_at(F.transform(F.array(F.transform(urls, ranked)), decided), 1)


def parse_feed(feeds: DataFrame, column: str = "body") -> DataFrame:
    """Entries of RSS and Atom bodies (one row per feed: source, body), in feed order.

    Items lie in <item> or <entry> elements; a broken body gives no rows.  Outside
    CDATA the named XML entities are decoded.  ``link`` is the best of the entry's
    addresses (``best_link`` over its links, id and guid), ``link_original`` the
    one it replaced, if any.
    """
    items = F.regexp_extract_all(F.col(column), F.lit("(?s)<item[ >].*?</item>|<entry[ >].*?</entry>"), F.lit(0))
    rows = feeds.select("source", F.posexplode(items).alias("position", "item"))

    def tag(*names: str) -> Column:
        found = []
        for name in names:
            inner = F.regexp_extract("item", f"(?s)<{name}(?: [^>]*)?>(.*?)</{name}>", 1)
            cdata = "(?s)^\\s*<!\\[CDATA\\[(.*?)\\]\\]>\\s*$"
            found.append(F.when(inner.rlike(cdata), F.regexp_extract(inner, cdata, 1)).otherwise(xml_decoded(inner)))
        return first_text(*found)

    hrefs = F.transform(F.regexp_extract_all("item", F.lit('<link[^>]*href="([^"]+)"'), F.lit(1)), xml_decoded)
    rows = rows.withColumns({"title": tag("title"), "_links": F.concat(F.array(tag("link")), hrefs, F.array(tag("id"), tag("guid")))})
    rows = rows.withColumn("_best", best_link(F.col("title"), F.col("_links")))
    return rows.select("source", "position", "title", "_best.link", F.col("_best.original").alias("link_original"), tag("pubDate", "published", "dc:date").alias("published"), tag("updated").alias("updated"), tag("description", "summary", "content").alias("description"))


def feed_day(published: Column) -> Column:
    """The day of an RFC 822 or ISO time."""
    return F.coalesce(dates.strict_date(published), dates.date_in_text(published))


def scan_feed(entries: DataFrame, as_of: str, shortest_title: int = 15, max_scan: int = 30, per_source: int = 10, days: int = 2) -> DataFrame:
    """Scan cap, title length, recency and quota of each source, in feed order."""
    seen = entries.filter(F.col("position") < max_scan).withColumn("day", feed_day(F.col("published")))
    kept = seen.filter((F.length("title") >= shortest_title) & dates.is_recent(F.col("day"), F.lit(as_of).cast("date"), days))
    ranked = kept.withColumn("nth", F.row_number().over(Window.partitionBy("source").orderBy("position"))).filter(F.col("nth") <= per_source)
    return ranked.withColumn("excerpt", shortened(F.regexp_replace("description", "<[^>]+>", " "), 600, "")).drop("nth")


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.open: list | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.handle_endtag("a")
            self.open = [dict(attrs).get("href") or "", []]

    def handle_data(self, data):
        if self.open:
            self.open[1].append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            self.found.append((self.open[0], " ".join("".join(self.open[1]).split())))
            self.open = None


def anchors(html: str | None, base: str | None) -> list[tuple[int, str, str]]:
    """(position, absolute link, text) of the anchors of a page."""
    parser = _Anchors()
    parser.feed(html or "")
    parser.close()
    parser.handle_endtag("a")
    found = []
    for i, (href, text) in enumerate(parser.found):
        try:
            found.append((i, urljoin(base or "", href), text))
        except ValueError:  # a malformed address stays as it stands
            found.append((i, href, text))
    return found


def page_anchors(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per anchor of each page, parsed in Arrow batches by the standard parser."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows = [(i, *a) for i, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True) for a in anchors(html, url)]
            types = (pa.int64(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["page_id", "position", "link", "text"])

    return pages.select(F.col(id_col).cast("long"), url_col, html_col).mapInArrow(run, "page_id long, position int, link string, text string")


def json_ld(pages: DataFrame, schema: str, html_col: str = "html") -> DataFrame:
    """Parsed JSON-LD blocks of pages, one row a block that parses."""
    blocks = F.regexp_extract_all(F.col(html_col), F.lit('(?s)<script[^>]*type="application/ld\\+json"[^>]*>(.*?)</script>'), F.lit(1))
    return pages.withColumn("block", F.explode(blocks)).withColumn("data", F.from_json("block", schema)).filter("data is not null").drop("block")


class Fetch(InputPartition):
    def __init__(self, urls: list[str]) -> None:
        self.urls = urls


class HttpReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.urls = json.loads(options["urls"])
        self.ways = int(options.get("concurrency", "8"))
        self.timeout = float(options.get("timeout", "8"))
        self.retries = int(options.get("retries", "1"))

    def partitions(self):
        return [Fetch(self.urls[k :: self.ways]) for k in range(min(self.ways, len(self.urls)))]

    def read(self, partition):
        import hashlib
        from urllib.request import urlopen

        for url in partition.urls:
            body, error = None, None
            for _ in range(self.retries + 1):
                try:
                    with urlopen(url, timeout=self.timeout) as reply:  # noqa: S310
                        body, error = reply.read().decode("utf-8", "replace"), None
                    break
                except (OSError, ValueError) as x:
                    error = str(x)
            yield hashlib.md5(url.encode()).hexdigest(), url, body, error


class HttpSource(DataSource):
    """``spark.read.format('bronze_http')``: (key, url, body, error), a bounded number of fetches at a time.

    Options: urls (a JSON list), concurrency, timeout, retries.  A failed fetch is a
    row with its error, so it never erases what an earlier run stored.
    """

    @classmethod
    def name(cls) -> str:
        return "bronze_http"

    def schema(self) -> str:
        return "key string, url string, body string, error string"

    def reader(self, schema):
        return HttpReader(self.options)


def stale(urls: DataFrame, bronze: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """The urls whose last good fetch is older than ``hours``: an anti-join on the cache's key."""
    fresh = bronze.filter((F.col("fetched_at") >= as_of - F.expr(f"interval {hours} hours")) & F.col("body").isNotNull())
    return urls.withColumn("key", F.md5(F.col("url").cast("binary"))).join(fresh.select("key"), "key", "left_anti")


def atom_entries(events: DataFrame) -> DataFrame:
    """(ord, xml): one Atom entry per event."""
    title = first_text(F.col("display_title"), F.col("summary_short"), F.col("reason"), F.col("title"))
    body = F.concat_ws("", *(F.concat(F.lit(f"<p><b>{label}</b> "), html_escaped(F.col(c)), F.lit("</p>")) for label, c in (("Summary", "summary_short"), ("Why", "reason"), ("Impact", "impact"))))
    stamp = F.concat(F.col("date"), F.lit("T00:00:00Z"))
    xml = F.concat(
        F.lit("<entry><title>"), html_escaped(title), F.lit('</title><link href="'), html_escaped(F.col("url")), F.lit('"/><id>urn:sha1:'), F.sha1(F.coalesce("url", F.lit("")).cast("binary")),
        F.lit("</id><published>"), stamp, F.lit("</published><updated>"), stamp, F.lit('</updated><summary type="html">'), html_escaped(body), F.lit("</summary></entry>"),
    )
    return events.select("ord", xml.alias("xml"))


def write_atom(events: DataFrame, path: str, title: str, updated: str, limit: int = 50) -> None:
    """An Atom feed of the newest events; a feed is short, so its text is put together by the driver."""
    rows = atom_entries(events.orderBy(F.col("date").desc(), "ord").limit(limit)).orderBy("ord").collect()
    head = f'<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>{title}</title><updated>{updated}</updated>'
    spark = events.sparkSession
    text = head + "".join(r["xml"] for r in rows) + "</feed>"
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
