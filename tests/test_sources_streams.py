import datetime as dt
import json
import re
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tidewater.sources import readers
from tidewater.streaming import streams


def test_store_forms(spark, tmp_path):
    store = {"2024-01-02": [{"title": "a", "event_types": ["ma"]}, {"title": "b", "date": "2024-01-05", "score": 7}], "2024-01-03": []}
    (tmp_path / "store.json").write_text(json.dumps(store))
    got = readers.read_store(spark, str(tmp_path / "store.json")).orderBy("position").collect()
    assert [(r["title"], r["date"], r["score"]) for r in got] == [("a", "2024-01-02", None), ("b", "2024-01-05", 7)]
    for text, n in (('[{"title": "x"}]', 1), ("{}", 0), ("broken", 0), (None, 0)):
        assert readers.flatten_store(spark.createDataFrame([(text,)], "value string")).count() == n


FEED = """<rss><channel><title>T</title>
<item><title><![CDATA[A long enough title & more]]></title><link>https://x/1</link><pubDate>Mon, 05 Feb 2024 10:00:00 GMT</pubDate><description>&lt;p&gt;<b>Body</b> one</description></item>
<item><title>Short</title><link>https://x/2</link></item>
<item><title>An old but long title</title><link>https://x/3</link><pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate></item>
<item><title>No date at all, still long</title><link>https://x/4</link></item></channel></rss>"""
ATOM = '<feed><entry><title>An Atom title, long too</title><link href="https://y/1"/><published>2024-02-05T01:00:00Z</published><summary>s</summary></entry></feed>'


def test_feeds(spark):
    feeds = spark.createDataFrame([("rss", FEED), ("atom", ATOM), ("none", None), ("bad", "<rss")], "source string, body string")
    entries = readers.parse_feed(feeds)
    assert entries.count() == 5
    got = readers.scan_feed(entries, "2024-02-06").orderBy("source", "position").collect()
    assert [(r["source"], r["link"], r["day"]) for r in got] == [("atom", "https://y/1", dt.date(2024, 2, 5)), ("rss", "https://x/1", dt.date(2024, 2, 5)), ("rss", "https://x/4", None)]
    assert got[1]["title"] == "A long enough title & more" and "Body" in got[1]["excerpt"] and "<b>" not in got[1]["excerpt"]
    assert readers.scan_feed(entries, "2024-02-06", per_source=1).count() == 2


def test_anchors(spark, sf_dir):
    html = '<a href="/x">One <b>two</b></a><a>none</a><a href="http://[bad">z</a><a href="?q">open'
    assert readers.anchors(html, "https://h/p/") == [(0, "https://h/x", "One two"), (1, "https://h/p/", "none"), (2, "http://[bad", "z"), (3, "https://h/p/?q", "open")]
    assert readers.anchors(None, None) == []
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    counts = {r["page_id"]: r["count"] for r in readers.page_anchors(pages).groupBy("page_id").count().collect()}
    want = {r["page_id"]: len(re.findall(r"<a[\s>]", r["html"])) for r in pages.collect()}
    assert counts == {k: v for k, v in want.items() if v}


def test_json_ld(spark):
    html = '<script type="application/ld+json">{"@type": "ItemList", "name": "n"}</script><script type="application/ld+json">{broken</script>'
    got = readers.json_ld(spark.createDataFrame([(1, html), (2, None)], "page_id int, html string"), "name string").collect()
    assert [r["data"]["name"] for r in got if r["data"]["name"]] == ["n"]


def test_archive_is_pruned_and_ranked(spark, tmp_path):
    rows = [("2024-01-01", 1, "a"), ("2024-01-01", 2, "b"), ("2024-01-02", 1, "b"), ("2024-01-02", 2, "c"), ("2024-01-09", 1, "z")]
    spark.createDataFrame(rows, "date_key string, rank int, title string").write.partitionBy("date_key").json(str(tmp_path / "hot"))
    read = readers.read_snapshots(spark, str(tmp_path / "hot"), "rank int, title string, date_key string", "2024-01-01", "2024-01-03")
    assert "PartitionFilters: [isnotnull(date_key" in read._jdf.queryExecution().toString()
    assert [(r["date_key"], r["title"]) for r in readers.first_titles(read).collect()] == [("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "c")]


def test_http_source(spark):
    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200 if self.path != "/missing" else 404)
            self.end_headers()
            self.wfile.write(self.path.encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    host = f"http://127.0.0.1:{server.server_port}"
    spark.dataSource.register(readers.HttpSource)
    read = spark.read.format("bronze_http").options(urls=json.dumps([f"{host}/{k}" for k in ("a", "b", "missing")]), concurrency="2", retries="0").load()
    got = {r["url"].rsplit("/", 1)[1]: r for r in read.collect()}
    server.shutdown()
    assert got["a"]["body"] == "/a" and got["missing"]["body"] is None and "404" in got["missing"]["error"]
    urls = spark.createDataFrame([(f"{host}/a",), (f"{host}/new",)], "url string")
    bronze = spark.createDataFrame([(got["a"]["key"], dt.datetime(2024, 1, 2), "x")], "key string, fetched_at timestamp, body string")
    assert [r["url"] for r in readers.stale(urls, bronze, F.lit("2024-01-02 20:00:00").cast("timestamp")).collect()] == [f"{host}/new"]


def test_atom(spark, tmp_path):
    schema = "ord long, date string, url string, title string, display_title string, summary_short string, reason string, impact string"
    rows = [(1, "2024-01-01", "https://x/?a=1&b=2", "T <1>", None, None, None, "big"), (2, "2024-01-02", None, None, "D", "s", "r", None)]
    readers.write_atom(spark.createDataFrame(rows, schema), str(tmp_path / "feed"), "Title", "2024-01-02T00:00:00Z")
    text = spark.read.text(str(tmp_path / "feed"), wholetext=True).first()[0]
    from xml.etree import ElementTree

    entries = ElementTree.fromstring(text.strip()).findall("{http://www.w3.org/2005/Atom}entry")
    titles = [e.find("{http://www.w3.org/2005/Atom}title").text for e in entries]
    assert titles == ["T <1>", "D"]


@pytest.fixture
def batches(spark, tmp_path):
    """Three files in order, with a repeat across files."""
    at = lambda d, h=0: dt.datetime(2024, 1, d, h)
    parts = [
        [(1, at(1), 7, "purchase", 1.0), (2, at(1, 5), 7, "view", 2.0), (3, at(2), 8, "purchase", 1.5)],
        [(2, at(1, 5), 7, "view", 2.0), (4, at(3), 7, "purchase", 4.0), (5, at(3), 7, "purchase", 4.0), (6, at(3, 1), 7, "purchase", 4.0)],
        [(7, at(9), 7, "purchase", 1.0), (8, at(9), 7, "purchase", 1.0), (9, at(10), 8, "view", 1.0)],
    ]
    folder = tmp_path / "events"
    import os
    import time

    def put(k):
        frame = spark.createDataFrame([(*r, "{}") for r in parts[k]], streams.EVENTS).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        frame.coalesce(1).write.mode("append").parquet(str(folder))
        newest = max(folder.glob("*.parquet"), key=os.path.getmtime)
        os.utime(newest, (time.time() + k, time.time() + k))

    return folder, put


def test_streams_go_on_after_a_restart(spark, tmp_path, batches):
    folder, put = batches
    for k in range(3):  # each run is a restart from the checkpoint
        put(k)
        stream = streams.event_stream(spark, str(folder))
        streams.run_to_table(streams.deduplicated(stream), str(tmp_path / "d"), str(tmp_path / "d-check"))
        streams.run_to_table(streams.tumbling(stream), str(tmp_path / "w"), str(tmp_path / "w-check"), "complete")
        streams.run_to_table(streams.candidates(stream), str(tmp_path / "c"), str(tmp_path / "c-check"), "update")
    assert sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "d")).collect()) == list(range(1, 10))
    windows = spark.read.parquet(str(tmp_path / "w"))
    last = windows.agg(F.max("batch")).first()[0]
    assert windows.filter(F.col("batch") == last).agg(F.sum("events")).first()[0] == 10
    states = spark.read.parquet(str(tmp_path / "c")).orderBy("user_id", "batch").collect()
    mine = [r for r in states if r["user_id"] == 7]
    assert mine[-1]["status"] == "promoted" and mine[-1]["refs"] == 7 and mine[-1]["last_seen"] == dt.datetime(2024, 1, 9)
    assert [r["status"] for r in states if r["user_id"] == 8][-1] == "accumulating"
    rolled = tmp_path / "r"
    streams.run_to_table(streams.rolling(streams.event_stream(spark, str(folder))), str(rolled), str(tmp_path / "r-check"), "complete")
    assert spark.read.parquet(str(rolled)).filter("event_type = 'purchase'").count() > 7


def test_best_link(spark):
    """A guid that repeats the title's words replaces a link that does not; ties and single words do not."""
    rows = [
        ("Acme opens data hub", ["https://x/p/100", "https://x/acme-opens-data-hub"]),
        ("Acme opens data hub", ["https://x/acme-opens", " https://x/data-hub "]),
        ("Acme", ["https://x/p", "https://x/acme"]),
        ("Acme opens", ["urn:1", None, "ftp://x/acme-opens", "http://x/0"]),
        (None, ["https://x/a"]),
        ("t", []),
        ("t", None),
    ]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, title string, links array<string>")
    got = [tuple(r["x"]) if r["x"] else (None, None) for r in frame.select("i", readers.best_link(F.col("title"), F.col("links")).alias("x")).orderBy("i").collect()]
    assert got == [("https://x/acme-opens-data-hub", "https://x/p/100"), ("https://x/acme-opens", None), ("https://x/p", None), ("http://x/0", None), ("https://x/a", None), (None, None), (None, None)]


def test_feed_entities_and_cdata(spark):
    body = "<rss><item><title>A &amp;amp; B &lt;c&gt;</title><link>https://x/1?a=1&amp;b=2</link></item><item><title><![CDATA[D &amp; E]]></title></item></rss>"
    got = readers.parse_feed(spark.createDataFrame([("s", body)], "source string, body string")).orderBy("position").collect()
    assert [(r["title"], r["link"]) for r in got] == [("A &amp; B <c>", "https://x/1?a=1&b=2"), ("D &amp; E", None)]
