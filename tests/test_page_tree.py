"""Structure of pages: dated links, script payloads, job links, snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from tidewater.sources import page_tree
from tidewater.sources.page_tree import Tree, bracketed, dated_anchors, page_jobs, script_strings

CHANGELOG = """
<html><body>
  <nav><a href="/pricing">Pricing</a></nav>
  <article>
    <time>June 28, 2026</time>
    <a href="/posts/custom-draft-order-discounts">
      Custom draft order line item discounts now use presentment currency
    </a>
  </article>
  <article><time>June 10, 2025</time><a href="/posts/old-api-update">Old API update of the year</a></article>
  <section><p>Posted June 27<p><div><span><a href="/posts/new-beta">A new beta for merchants</a></span></div></section>
  <a href="/posts/undated-sdk-release">Undated SDK release for all</a>
  <a href="https://other.example/posts/new-api">New API on another host</a>
  <a href="/reports/new-api-report">New API report is out today</a>
  <a href="/2026/06/29/new-default">• New default by its address</a>
  <a href="/posts/new-beta">A new beta for merchants, again</a>
</body></html>
"""


def test_changelog_items_take_the_nearest_date(spark):
    pages = spark.createDataFrame([(1, "https://www.changelog.example/", CHANGELOG, "x"), (2, "https://a.example", None, "x"), (3, None, "<a href='/x'>New API without a base</a>", "x")], "page_id long, url string, html string, link string")
    rows = {r["position"]: r for r in page_tree.changelog_items(pages, "2026-06-29", most=9).collect()}
    got = {k: (str(r["published_at"] or ""), r["basis"]) for k, r in rows.items()}
    # The undated one takes the first date of the body that is above it.
    assert got == {1: ("2026-06-28", "body_text"), 3: ("2026-06-27", "body_month_day"), 4: ("2026-06-28", "body_text"), 7: ("2026-06-29", "url_path")}
    assert rows[1]["title"] == "Custom draft order line item discounts now use presentment currency" and rows[7]["title"] == "New default by its address"
    assert [r["position"] for r in page_tree.changelog_items(pages, "2026-06-29", most=2).orderBy("position").collect()] == [1, 3]
    assert page_tree.changelog_items(pages.limit(0), "2026-06-29").count() == 0
    bare = spark.createDataFrame([(1, "https://a.example", "<a href='/b'>New API without any date</a>")], "page_id long, url string, html string")
    assert [(r["published_at"], r["basis"]) for r in page_tree.changelog_items(bare, "2026-06-29").collect()] == [(None, "observed_at")]


def test_trees_of_broken_pages():
    tree = Tree("<ul><li>one<li><b>two <a href='x'>three</ul> four</b> <script>no</script><br><a href=y>")
    assert tree.text == "one two three four"
    assert [(tree.text_of(n), h) for n, h in tree.links] == [("three", "x"), ("", "y")]
    node = tree.links[0][0]
    assert [tree.names[k] for k in tree.climb(node, 6)] == ["a", "b", "li", "ul"]
    assert Tree(None).text == "" and dated_anchors("", None) == []
    # Dates that begin in an element but end beyond it are not in it.
    assert [d for *_, d in dated_anchors("<p><b><a href='x'>June</a></b> 28, 2026</p>", "https://a.example")] == [["", "", "June 28, 2026"]]


def test_large_pages_are_parsed_in_linear_time():
    html = "<body>" + "".join(f"<div><time>June {k % 28 + 1}, 2026</time><a href='/p/{k}'>link {k}</a></div>" for k in range(20_000)) + "</body>"
    found = dated_anchors(html, "https://a.example")
    assert len(found) == 20_000 and found[12_345][3][:2] == ["", f"June {12_345 % 28 + 1}, 2026"]


def payload(text):
    return f'<script>self.__next_f.push([1,{json.dumps(text)}])</script>'


NESTED = '1:{"x":[0],"sources":[{"name":"a ] [ \\" b","tags":[["deep"],{}]},{"name":"c}"}],"rest":[1]}'


@pytest.mark.parametrize(
    ("text", "want"),
    [(NESTED, NESTED[NESTED.index("[{") : NESTED.index("]," + '"rest')] + "]"), ('{"sources":[1,[2]', None), ('{"sources":{}}', None), ('{"other":[1]}', None), ('{"sources": [ ]}', "[ ]"), ("", None), ('"sources"', None)],
)
def test_bracketed(text, want):
    assert bracketed(text, "sources") == want


def test_embedded_values(spark):
    odd = 'self.__next_f.push([1,"\\u0041\\/\\n\\t\\"\\\\n"]) self.__next_f.push([1,"cut'
    assert list(script_strings(odd)) == ['A/\n\t"\\n'] and list(script_strings(None)) == []
    huge = json.dumps({"sources": [{"name": f"s{k}", "note": "[" * (k % 7)} for k in range(30_000)]})
    pages = [(1, payload("no") + payload(NESTED)), (2, payload('{"sources":[1,')), (3, payload('{"sources":[nonsense]}') + payload('{"sources":[{"name":"later"}]}')), (4, None), (5, "plain"), (6, payload(huge)), (7, payload('{"sources":[]}'))]
    found = page_tree.embedded_values(spark.createDataFrame(pages, "page_id long, html string"), "sources")
    names = found.select("page_id", "position", F.try_variant_get("value", "$.name", "string").alias("name"))
    assert sorted(map(tuple, names.filter("page_id <> 6").collect())) == [(1, 0, 'a ] [ " b'), (1, 1, "c}"), (3, 0, "later")]
    assert names.filter("page_id = 6 and name = concat('s', position)").count() == 30_000


RULES = [("Grab", r"/en/jobs/\d+/[^/?#]+/?$"), ("Stripe", r"/careers/listing/[^/?#]+/\d+/?$"), ("Shopify", r"/careers/[^/?#]+_[0-9a-f-]{36}/?$")]
BOARDS = [
    ("Grab", "https://www.grab.careers/en/jobs/", '<a href="/en/jobs/7440001/senior-software-engineer-backend-ai/">Senior Software Engineer, Backend AI</a><a href="/en/about">About</a>'),
    ("Stripe", "https://stripe.com/careers/search", '<a href="/careers/listing/account-executive-ai-sales/7954688"></a>'),
    ("Shopify", "https://www.shopify.com/careers", '<a href="/careers/product-partner-manager-shopify-payments_12345678-1234-1234-1234-123456789abc">Product Partner Manager, <b>Shopify Payments</b></a>'),
    ("Nobody", "https://n.example", '<a href="/en/jobs/7440001/x/">x</a>'),
    ("Grab", "https://www.grab.careers/en/jobs/", None),
]


def test_job_links(spark):
    pages = spark.createDataFrame([(*b, "x") for b in BOARDS], "entity string, url string, html string, tags string")
    rows = {r["entity"]: r for r in page_tree.job_links(pages, spark.createDataFrame(RULES, "entity string, pattern string")).collect()}
    assert {e: (r["job"], r["title"], r["tags"]) for e, r in rows.items()} == {
        "Grab": ("7440001", "Senior Software Engineer, Backend AI", ["ai", "engineering"]),
        "Stripe": ("7954688", "7954688", []),
        "Shopify": ("12345678-1234-1234-1234-123456789abc", "Product Partner Manager, Shopify Payments", ["payments", "partnerships"]),
    }
    assert rows["Grab"]["url"] == "https://www.grab.careers/en/jobs/7440001/senior-software-engineer-backend-ai/"


def test_job_links_are_first_by_id_and_by_title_of_those_taken():
    link = lambda number, title: f"<a href='/en/jobs/{number}/x/'>{title}</a>"
    html = link(744000141167699, "Head, Product") + link(744000141167689, "Head - product") + link(744000141167689, "Other") + link(744000141167699, "Third")
    # The second is left out for its title, so its id is still free for the third.
    assert [(j, t) for j, t, _ in page_jobs(html, "https://a.example", RULES[0][1])] == [("744000141167699", "Head, Product"), ("744000141167689", "Other")]
    assert len(page_jobs("".join(link(100_000 + k, f"t{k}") for k in range(300)), "https://a.example", RULES[0][1])) == 120


def test_a_failed_board_keeps_the_earlier_snapshot(spark):
    job = "entity string, job string"
    before = spark.createDataFrame([("read", "1"), ("read", "2"), ("failed", "3"), ("unreadable", "4"), ("gone", "5")], job)
    now = spark.createDataFrame([("read", "2"), ("read", "6"), ("new", "7")], job)
    boards = spark.createDataFrame([("read", True), ("failed", False), ("unreadable", True), ("new", True), ("read", True)], "entity string, fetched boolean")
    found = sorted(map(tuple, page_tree.carried_snapshot(before, now, boards).collect()))
    assert found == [("failed", "3"), ("gone", "5"), ("new", "7"), ("read", "2"), ("read", "6"), ("unreadable", "4")]


def test_snapshots_as_of_a_day_read_only_folders_that_count(spark, tmp_path):
    rows = [("a", 1, "2024-01-01"), ("a", 2, "2024-01-03"), ("b", 3, "2024-01-02"), ("a", 4, "2024-01-09"), ("c", 5, "2024-01-09")]
    spark.createDataFrame(rows, "k string, v int, date_key string").withColumn("date_key", F.col("date_key").cast("date")).write.partitionBy("date_key").parquet(str(tmp_path / "s"))
    found = page_tree.snapshot_as_of(spark, str(tmp_path / "s"), ["k"], "2024-01-04")
    assert sorted((r["k"], r["v"], str(r["date_key"])) for r in found.collect()) == [("a", 2, "2024-01-03"), ("b", 3, "2024-01-02")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan and "2024-01-04" in plan
    assert page_tree.snapshot_as_of(spark, str(tmp_path / "s"), ["k"], "2023-01-01").count() == 0
    assert page_tree.snapshot_as_of(spark, str(tmp_path / "s"), ["k"], "2024-01-09", "2024-01-05").count() == 2


def test_made_pages_read_orders_once(spark, sf_dir):
    """Before, headlines were joined with a second scan of their own orders."""
    from tidewater.plans.pages import _pages

    plan = _pages(spark, sf_dir, F.col("title"))._jdf.queryExecution().optimizedPlan().toString()
    assert sum("Relation" in line and "o_orderkey" in line for line in plan.splitlines()) == 1
