"""Queries over pages and snapshots made of the tables, each with its SQL oracle over the tables themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import html_escaped
from tidewater.plans.headlines import HEADLINES_SQL, headlines
from tidewater.sources import page_tree
from tidewater.sources.fixtures import table
from tidewater.sources.scratch import new_folder

_AS_OF, _DAYS = "2026-06-30", 700


def _pages(spark: SparkSession, sf_dir: str, piece: Column) -> DataFrame:
    """One page per customer that has orders: the pieces of its headlines in order."""
    pieces = headlines(spark, sf_dir).withColumnRenamed("customer", "page_id").groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("ord", piece.alias("piece")))).alias("pieces"))
    url = F.concat(F.lit("https://www.firm"), F.col("page_id").cast("string"), F.lit(".example/changelog"))
    return pieces.select("page_id", url.alias("url"), F.array_join("pieces.piece", "\n").alias("html"))


def changelog_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of one changelog a customer, dated in five ways."""
    k, day, title = F.col("ord").cast("string"), F.col("day"), html_escaped(F.col("title"))
    full, short, path = (F.date_format(day, f) for f in ("MMMM d, yyyy", "MMMM d", "yyyy/MM/dd"))
    kinds = [
        F.concat(F.lit("<article><time>"), full, F.lit('</time><div><a href="/posts/'), k, F.lit('">New API: '), title, F.lit("</a></div></article>")),
        F.concat(F.lit('<li><a href="/'), path, F.lit("/"), k, F.lit('">'), title, F.lit(" update</a></li>")),
        F.concat(F.lit("<p><b>"), full, F.lit('</b> <span><a href="https://other.example/p/'), k, F.lit('">New '), title, F.lit("</a></span></p>")),
        F.concat(F.lit("<section><h2>Posted "), short, F.lit('</h2><p><a href="/posts/'), k, F.lit('">New default '), title, F.lit("</a></section>")),
        F.concat(F.lit('<div><a href="/reports/'), k, F.lit('">New report '), title, F.lit("</a></div>")),
    ]
    pages = _pages(spark, sf_dir, F.element_at(F.array(*kinds), (F.col("ord") % 5 + 1).cast("int")))
    found = page_tree.changelog_items(pages, _AS_OF, days=_DAYS)
    return found.select("page_id", "position", "title", "link", F.col("published_at").cast("string").alias("published_at"), F.col("scheduled_at").cast("string").alias("scheduled_at"), "basis", "confidence")


def embedded_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists within script payloads, one a customer; names hold quotes and brackets, some payloads are cut off."""
    note = F.concat(F.lit('see ] "'), F.col("nation"), F.lit('" [ \\'), F.when(F.col("ord") % 3 == 0, "{").otherwise("}"))
    row = F.to_json(F.struct(F.col("title").alias("name"), note.alias("note"), F.col("ord").alias("rank"), F.array(F.array(F.col("ord") % 7)).alias("deep")))
    pages = _pages(spark, sf_dir, row)
    listed = F.concat(F.lit('2:{"list":[0],"sources":['), F.replace("html", F.lit("\n"), F.lit(",")), F.lit('],"more":[]}'))
    escaped = F.replace(F.replace(listed, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    cut = F.when(F.col("page_id") % 10 == 3, F.substring(escaped, 1, 60)).otherwise(escaped)
    script = F.concat(F.lit('<p>"sources"</p><script>self.__next_f.push([1,"no list"])</script><script>self.__next_f.push([1,"'), cut, F.lit('"])</script>'))
    found = page_tree.embedded_values(pages.select("page_id", script.alias("html")), "sources")
    read = lambda path, kind: F.try_variant_get("value", path, kind)
    return found.select("page_id", "position", read("$.name", "string").alias("name"), read("$.note", "string").alias("note"), read("$.rank", "long").alias("rank"), read("$.deep[0][0]", "long").alias("deep"))


def job_board_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs of one board a brand and size, named after parts: reposted titles count once, brands have paths of their own."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    number = F.lpad(F.col("p_partkey").cast("string"), 7, "0")
    tail = F.substring("p_brand", -1, 1)
    path = F.when(tail == "1", F.concat(F.lit("/careers/listing/part/"), number)).otherwise(F.concat(F.lit("/en/jobs/"), number, F.lit("/part/")))
    title = F.concat(F.when(F.col("p_partkey") % 4 == 0, "Engineer: ").when(F.col("p_partkey") % 4 == 1, "Sales and Risk, ").otherwise(""), F.substring_index("p_name", " ", 1))
    link = F.concat(F.lit('<li><a href="'), path, F.lit('"> '), title, F.lit(" </a> </li>"), F.when(F.col("p_partkey") % 9 == 0, '<a href="/about">About</a>').otherwise(""))
    entity = F.concat_ws("/", "p_brand", F.col("p_size").cast("string"))
    boards = part.select(entity.alias("entity"), "p_partkey", link.alias("link")).groupBy("entity").agg(F.sort_array(F.collect_list(F.struct("p_partkey", "link"))).alias("links"))
    pages = boards.select("entity", F.lit("https://jobs.example/en/").alias("url"), F.array_join("links.link", "").alias("html"))
    rules = boards.select("entity", F.when(F.col("entity").rlike("1/"), r"/careers/listing/[^/?#]+/\d+/?$").when(~F.col("entity").rlike("5/"), r"/en/jobs/\d+/[^/?#]+/?$").alias("pattern"))
    found = page_tree.job_links(pages, rules)
    return found.select("entity", "job", "title", F.array_join("tags", "|").alias("tags"))


def snapshot_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each customer had ordered by the last quarterly snapshot not after a day."""
    orders = table(spark, sf_dir, "orders")
    quarter = F.last_day(F.add_months(F.trunc("o_orderdate", "quarter"), 2)).alias("date_key")
    path = new_folder(spark, "snapshots")
    sums = orders.groupBy("o_custkey", quarter).agg(F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    sums.repartition("date_key").write.partitionBy("date_key").parquet(path)
    found = page_tree.snapshot_as_of(spark, path, ["o_custkey"], "1996-05-15")
    return found.select("o_custkey", "orders", "total", F.col("date_key").cast("string").alias("snapshot"))


SQL = {
    "changelog_entries": f"""
with {HEADLINES_SQL},
entries as (
  select c as page_id, ord, day, ord % 5 as kind, row_number() over (partition by c order by ord) - 1 as position,
    case ord % 5 when 0 then 'New API: ' || title when 1 then title || ' update' when 3 then 'New default ' || title end as title,
    'https://www.firm' || c || '.example/' || case when ord % 5 = 1 then strftime(day, '%Y/%m/%d/') else 'posts/' end || ord as link from heads),
dated as (
  select *, case when kind = 3 then coalesce(
      case when try_strptime('2026' || strftime(day, '-%m-%d'), '%Y-%m-%d') <= date '{_AS_OF}' then try_strptime('2026' || strftime(day, '-%m-%d'), '%Y-%m-%d') end,
      try_strptime('2025' || strftime(day, '-%m-%d'), '%Y-%m-%d')) else day end::date as d
  from entries where kind in (0, 1, 3)),
kept as (select * from dated where not coalesce(d < date '{_AS_OF}' - {_DAYS}, false) qualify row_number() over (partition by page_id order by position) <= 4)
select page_id, cast(position as integer) as position, title, link,
  case when d <= date '{_AS_OF}' + 1 then strftime(d, '%Y-%m-%d') end as published_at, case when d > date '{_AS_OF}' + 1 then strftime(d, '%Y-%m-%d') end as scheduled_at,
  case when d is null then 'observed_at' else ['body_text', 'url_path', null, 'body_month_day'][kind + 1] end as basis,
  case when d is null then 'observed' when kind = 1 then 'high' else 'low' end as confidence
from kept""",
    "embedded_sources": f"""
with {HEADLINES_SQL}
select c as page_id, cast(row_number() over (partition by c order by ord) - 1 as integer) as position, title as name,
  'see ] "' || nation || '" [ ' || chr(92) || case when ord % 3 = 0 then '{{' else '}}' end as note, ord as rank, ord % 7 as deep
from heads where c % 10 <> 3""",
    "job_board_links": """
with links as (
  select p_brand || '/' || p_size as entity, p_partkey, lpad(cast(p_partkey as varchar), 7, '0') as job,
    case p_partkey % 4 when 0 then 'Engineer: ' when 1 then 'Sales and Risk, ' else '' end || split_part(p_name, ' ', 1) as title
  from part where right(p_brand, 1) <> '5'),
firsts as (select * from links qualify row_number() over (partition by entity, regexp_replace(lower(title), '[^a-z0-9]+', '', 'g') order by p_partkey) = 1),
taken as (select * from firsts qualify row_number() over (partition by entity order by p_partkey) <= 120)
select entity, job, title, case p_partkey % 4 when 0 then 'engineering' when 1 then 'compliance|sales' else '' end as tags from taken""",
    "snapshot_as_of": """
with sums as (
  select o_custkey, last_day(cast(date_trunc('quarter', o_orderdate) + interval 2 month as date)) as date_key, count(*) as orders, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total
  from orders group by all)
select o_custkey, orders, total, strftime(date_key, '%Y-%m-%d') as snapshot from sums where date_key <= date '1996-05-15'
qualify row_number() over (partition by o_custkey order by date_key desc) = 1""",
}
QUERIES = {name: globals()[name] for name in SQL}
