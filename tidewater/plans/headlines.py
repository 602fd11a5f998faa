"""Queries over headlines made of orders, each with its SQL oracle.

A headline names a company, says what it did and where, and carries what a feed
carries: tier, role, declared types, a URL and a body with or without dates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import subjects
from tidewater.functions.lexicon import Lexicon
from tidewater.functions.text import html_escaped
from tidewater.operators import profiles
from tidewater.sources import readers
from tidewater.sources.fixtures import table

NAMES = ("Nova", "Blue Grid", "Delta-Cart", "Kite Cloud", "Orbit AI", "P.L. Lane", "Quill & Sons")
ENDINGS = (" Inc", " Holdings Ltd", "", " Technologies")
DEEDS = (
    "raises $20 million for growth",
    "acquires a rival",
    "reports revenue decline",
    "launches a language model",
    "released the best language model",
    "expands into a new market",
    "hires engineers",
    "market share report",
    "fined by the regulator",
    "is valued at $2 billion",
    "posted profit up 20%",
    "newsletter",
)
KINDS = ("funding", "ma", "earnings", "model", "model", "strategy", "other", "report", "regional_policy", "funding", "earnings", "other")


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One headline per order; nations are joined as a small table, customers by key.

    Orders are dealt by customer first: so the join needs them, and a small file, which one
    task reads, is worked on by all.
    """
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nk"), "n_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_custkey")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("nk"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def pick(values: tuple[str, ...], key) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))

    name = F.concat(pick(NAMES, c), F.lit(" "), F.initcap("c_mktsegment"), pick(ENDINGS, c))
    day = F.add_months(F.to_date("o_orderdate"), 360)
    title = F.concat(F.when(k % 9 == 0, "Update: ").otherwise(""), name, F.lit(" "), pick(DEEDS, k), F.lit(" in "), F.col("n_name"), F.when(k % 5 == 0, " - The Wire").otherwise(""))
    dated = F.when(k % 4 == 0, day).when(k % 4 == 3, F.date_add(day, 100))
    url = F.concat(F.lit("https://site.example/"), F.when(dated.isNotNull(), F.concat(F.date_format(dated, "yyyy/MM/dd"), F.lit("/"))).otherwise("a/"), (k % 5000).cast("string"))
    body = F.when(k % 4 == 1, F.concat(F.lit("Posted on "), F.date_format(day, "MMMM d"), F.lit(" by staff"))).when((k % 4 == 2) | (k % 8 == 3), F.concat(F.lit("Posted "), F.date_format(day, "yyyy-MM-dd")))
    return rows.select(
        k.alias("ord"), c.alias("customer"), title.alias("title"), name.alias("name"), F.when(k % 3 != 0, name).alias("company"), F.col("n_name").alias("nation"), day.alias("day"), F.date_add(day, 40).alias("observed"),
        url.alias("url"), body.alias("body"), pick(KINDS, k).alias("event_type"), F.concat(F.lit("feed "), (k % 40).cast("string"), F.when(k % 2 == 0, " Newsroom").otherwise(" IR News")).alias("source"),
        F.when(k % 4 != 0, F.concat(F.lit("L"), (k % 5 + 1).cast("string"))).alias("tier"), F.when(k % 8 != 0, "media").alias("role"), (c % 2 == 0).alias("tracked"),
        F.when(k % 24 == 7, "research_report").alias("source_type"), F.when(k % 36 == 19, F.array(F.lit("industry_analysis"))).alias("source_signals"), F.when(k % 12 == 8, "regional_policy").alias("scope_layer"),
        F.when(k % 50 == 1, "company_action").alias("declared_content"), F.when(k % 70 == 2, "fund").alias("declared_subject"), F.when(k % 90 == 3, "rumour").alias("declared_claim"), F.when(k % 60 == 4, "hiring").alias("declared_action"),
        F.when(k % 6 == 0, F.concat(F.lit("topic "), (k % 7).cast("string"), F.when(k % 12 == 0, " — 亚太观察").otherwise(""))).alias("topic"), F.when(k % 5 == 0, "支付/持续").when(k % 5 == 1, "持续观察").alias("direction"),
    )


def title_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many headlines each subject, company key and source has, by both orders of the subject."""
    rows = headlines(spark, sf_dir).select("title", "name", "company", "source").withColumn("subject", subjects.title_subject(F.col("title")))
    none = F.lit(None).cast("array<string>")
    keyed = rows.select(
        "subject",
        subjects.event_subject(F.col("company"), none, F.col("subject")).alias("event_subject"),
        subjects.display_subject(F.col("company"), none, F.col("subject")).alias("display_subject"),
        subjects.company_key(F.col("name")).alias("company_key"),
        subjects.source_entity(F.col("source")).alias("entity"),
        subjects.reports_loss(F.col("title")).alias("loss"),
    )
    return keyed.groupBy("subject", "event_subject", "display_subject", "company_key", "entity", "loss").agg(F.count("*").alias("headlines"))


def signal_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profiles.profiled(headlines(spark, sf_dir), F.col("title"))
    return rows.select("ord", "content_type", "subject_type", "claim_type", "action_type")


def country_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries by company market (of tracked customers) or by the nation that a headline names."""
    rows = headlines(spark, sf_dir)
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("class"), F.col("n_nationkey").cast("int").alias("ord"), F.lower("n_name").alias("term"))
    markets = rows.filter("tracked").select(F.col("name").alias("company"), F.col("nation").alias("country"), (F.col("ord") % 10 == 0).alias("is_home"))
    tagged = profiles.tagged_countries(rows, markets, Lexicon.of(nations))
    return tagged.select("ord", F.array_join("countries", "|").alias("countries"), "primary_country", "tag_method")


def article_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = headlines(spark, sf_dir).select("ord", subjects.article_date(F.col("url"), F.col("title"), F.col("body"), F.col("observed")).alias("x"))
    return found.select("ord", F.col("x.published_at").cast("string").alias("published_at"), F.col("x.scheduled_at").cast("string").alias("scheduled_at"), "x.basis", "x.confidence")


def event_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = headlines(spark, sf_dir).select(
        profiles.source_family(F.col("tier"), F.col("role"), F.col("source")).alias("family"),
        profiles.event_topic(F.col("topic"), F.lit(None).cast("string"), F.col("title")).alias("topic"),
        profiles.cluster_topic(F.col("topic"), F.col("company"), F.col("direction"), F.col("title")).alias("cluster_topic"),
        profiles.source_label(F.col("tier"), F.col("ord") % 13 == 0).alias("label"),
    )
    return rows.groupBy("family", "topic", "cluster_topic", "label").agg(F.count("*").alias("headlines"))


def daily_navigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("ord")
    rows = headlines(spark, sf_dir).withColumns({"view_priority": F.when(k % 7 == 0, "important").when(k % 7 == 1, "unknown"), "bd_priority": F.when(k % 3 == 0, "高").when(k % 3 == 1, "中")})
    return profiles.day_groups(rows).withColumn("day", F.col("day").cast("string"))


def daily_briefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = headlines(spark, sf_dir).filter("event_type <> 'other'").select("ord", "day", F.coalesce("company", "nation").alias("label"), F.col("nation").alias("region"), "event_type")
    return profiles.day_briefs(rows).withColumn("day", F.col("day").cast("string"))


def narrative_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight different pieces of evidence of each nation."""
    k = F.col("ord")
    rows = headlines(spark, sf_dir).select(F.col("nation").alias("narrative"), k.alias("place"), F.when(k % 3 != 0, F.col("url")).alias("url"), F.when(k % 11 != 0, F.col("day")).alias("day"), F.when(k % 33 != 0, F.col("title")).alias("title"))
    return profiles.unique_evidence(rows)


def feed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each headline as a feed of one entry, read back: its title, day and best address."""
    k = F.col("ord")
    slug = F.regexp_replace(F.lower("title"), "[^a-z0-9]+", "-")
    guid = F.when(k % 3 == 0, F.concat(F.lit("https://site.example/news/"), slug)).when(k % 3 == 1, F.concat(F.lit("urn:"), k.cast("string")))
    guid = F.coalesce(F.concat(F.lit("<guid>"), guid, F.lit("</guid>")), F.lit(""))
    entry = F.concat(F.lit("<item><title>"), html_escaped(F.col("title")), F.lit("</title><link>https://site.example/p/"), k.cast("string"), F.lit("</link>"), guid, F.lit("<pubDate>"), F.date_format("day", "dd MMM yyyy"), F.lit("</pubDate></item>"))
    feeds = headlines(spark, sf_dir).select(k.cast("string").alias("source"), F.concat(F.lit("<rss><channel>"), entry, F.lit("</channel></rss>")).alias("body"))
    found = readers.parse_feed(feeds)
    return found.select(F.col("source").cast("long").alias("ord"), "title", "link", "link_original", readers.feed_day(F.col("published")).cast("string").alias("day"))


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


HEADLINES_SQL = f"""
placed as (
  select o_orderkey as k, o_custkey as c, cast(o_orderdate + interval 360 month as date) as d, n_name as nation,
    ({_list(NAMES)})[o_custkey % {len(NAMES)} + 1] || ' ' || upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ({_list(ENDINGS)})[o_custkey % {len(ENDINGS)} + 1] as name
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
heads as (
  select k as ord, c, d as day, nation, name, case when k % 3 <> 0 then name end as company, cast(d + interval 40 day as date) as observed,
    case when k % 9 = 0 then 'Update: ' else '' end || name || ' ' || ({_list(DEEDS)})[k % {len(DEEDS)} + 1] || ' in ' || nation || case when k % 5 = 0 then ' - The Wire' else '' end as title,
    'https://site.example/' || case k % 4 when 0 then strftime(d, '%Y/%m/%d/') when 3 then strftime(d + interval 100 day, '%Y/%m/%d/') else 'a/' end || cast(k % 5000 as varchar) as url,
    case when k % 4 = 1 then 'Posted on ' || strftime(d, '%B %-d') || ' by staff' when k % 4 = 2 or k % 8 = 3 then 'Posted ' || strftime(d, '%Y-%m-%d') end as body,
    ({_list(KINDS)})[k % {len(KINDS)} + 1] as event_type, 'feed ' || cast(k % 40 as varchar) || case when k % 2 = 0 then ' Newsroom' else ' IR News' end as source,
    case when k % 4 <> 0 then 'L' || cast(k % 5 + 1 as varchar) end as tier, case when k % 8 <> 0 then 'media' end as role, c % 2 = 0 as tracked,
    case when k % 6 = 0 then 'topic ' || cast(k % 7 as varchar) || case when k % 12 = 0 then ' — 亚太观察' else '' end end as topic,
    case k % 5 when 0 then '支付/持续' when 1 then '持续观察' end as direction
  from placed)
"""


def _key_sql(text: str) -> str:
    """The subject key of an expression: normalised, without stop words and single letters, four words."""
    plain = f"regexp_replace(regexp_replace(replace(lower({text}), '&', ' and '), '[''\"’“”]', '', 'g'), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', ' ', 'g')"
    return f"array_to_string(list_filter(string_split(trim({plain}), ' '), lambda w: len(w) > 1 and not list_contains({_list(subjects.ENTITY_STOPWORDS)}, w))[1:4], ' ')"


def _subject_sql() -> str:
    tries = []
    for pattern in subjects.SUBJECT_PATTERNS:
        subject = f"regexp_replace(trim(regexp_extract(clean, '{pattern.replace(chr(39), chr(39) * 2)}', 1)), '^[,;:\\-]+|[,;:\\-]+$', '', 'g')"
        tries.append(f"nullif({_key_sql(f'regexp_replace({subject}, {chr(39)}{subjects.QUESTION_PREFIX}{chr(39)}, {chr(39)}{chr(39)})')}, '')")
    return f"coalesce({', '.join(tries)}, '')"


def _hit_sql(name: str) -> str:
    ascii_terms = [t for t in profiles.PROFILE.terms(name) if t.isascii()]
    return f"regexp_matches(lower(title), '(^|[^a-z0-9])({'|'.join(ascii_terms)})([^a-z0-9]|$)')"


def _first_sql(value: str) -> str:
    return f"(select day, list({value} order by met) as {value}s from (select day, {value}, min(ord) as met from told group by 1, 2 qualify row_number() over (partition by day order by met) <= 3) group by day)"


SQL = {
    "title_subjects": f"""
with {HEADLINES_SQL}, cleaned as (select *, regexp_replace(trim(regexp_replace(title, ' - The Wire$', '')), '^[^A-Za-z0-9]{{0,3}}[^:]{{2,36}}:\\s*', '') as clean from heads),
keyed as (select {_subject_sql()} as subject, nullif({_key_sql("coalesce(company, '')")}, '') as named,
  array_to_string(string_split(coalesce(nullif(trim(regexp_replace(trim(regexp_replace(regexp_replace(replace(lower(name), '&', ' and '), '['']', '', 'g'), '[^a-z0-9]+', ' ', 'g')), '( ({'|'.join(subjects.COMPANY_SUFFIXES)}))+$', '')), ''), ''), ' ')[1:4], ' ') as company_key,
  regexp_replace(source, ' (Newsroom|IR News)$', '') as entity, regexp_matches(lower(title), '{'|'.join(subjects.FINANCIAL_NEGATIVES)}') as loss from cleaned)
select subject, coalesce(named, subject) as event_subject, coalesce(nullif(subject, ''), named, '') as display_subject, company_key, entity, loss, count(*) as headlines from keyed group by all""",
    "signal_profiles": f"""
with {HEADLINES_SQL}, hits as (select *, ord % 24 = 7 as research, ord % 36 = 19 as analysis, {", ".join(f"{_hit_sql(n)} as {n}" for n, _ in profiles.PROFILE.classes)} from heads),
typed as (select *, case when ord % 50 = 1 then 'company_action' when research then 'industry_report' when analysis and report then 'industry_report' when model and model_action then 'model_release'
    when ord % 12 = 8 then 'regional_policy' when event_type in ('funding', 'ma', 'earnings') then 'capital_event' when company is not null then 'company_action' else 'generic_industry_change' end as content_type from hits)
select ord, content_type,
  case when ord % 70 = 2 then 'fund' else case content_type when 'industry_report' then 'report' when 'model_release' then 'ai_model' when 'regional_policy' then 'region_policy' else case when company is not null then 'company' else 'industry' end end end as subject_type,
  case when ord % 90 = 3 then 'rumour' else case content_type when 'industry_report' then 'institutional_assessment' when 'model_release' then case when performance then 'performance_claim' else 'release_fact' end
    when 'regional_policy' then 'policy_change' when 'company_action' then 'company_action' else 'industry_change' end end as claim_type,
  case when ord % 60 = 4 then 'hiring' when content_type = 'regional_policy' or policy then 'policy_change' when event_type = 'earnings' then 'earnings' when event_type in ('funding', 'ma') or content_type = 'capital_event' then 'funding'
    when content_type = 'model_release' or release then 'product_release' when hiring then 'hiring' when event_type in ('strategy', 'partnership') or expansion then 'expansion' else 'other' end as action_type
from typed""",
    "country_tags": f"""
with {HEADLINES_SQL}, markets as (select name as company, list_sort(list(distinct nation)) as countries, min(case when ord % 10 = 0 then nation end) as home from heads where tracked group by name),
titled as (select ord, list_sort(list(n_name)) as countries from heads join nation on regexp_matches(lower(title), '(^|[^a-z0-9])' || lower(n_name) || '([^a-z0-9]|$)') group by ord)
select h.ord, array_to_string(coalesce(m.countries, t.countries, []), '|') as countries, coalesce(m.home, coalesce(m.countries, t.countries)[1]) as primary_country,
  case when m.company is not null then 'company_market' when t.ord is not null then 'title_keyword' else '' end as tag_method
from heads h left join markets m on h.company = m.company left join titled t on h.ord = t.ord""",
    "article_dates": f"""
with {HEADLINES_SQL}, found as (select ord, observed, try_strptime(regexp_extract(url, '/(20[0-9]{{2}}/[0-9]{{2}}/[0-9]{{2}})/', 1), '%Y/%m/%d') as u, try_strptime(regexp_extract(body, '20[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}'), '%Y-%m-%d') as b,
  try_strptime(regexp_extract(body, 'on ([A-Z][a-z]+ [0-9]+)', 1) || ' ' || year(observed), '%B %d %Y') as this, try_strptime(regexp_extract(body, 'on ([A-Z][a-z]+ [0-9]+)', 1) || ' ' || (year(observed) - 1), '%B %d %Y') as last from heads),
dated as (select ord, observed + interval 1 day as latest, u, b, case when b is null then case when this <= observed then this else case when last <= observed then last end end end as m from found),
chosen as (select *, case when u <= latest then u when b <= latest then b when m <= latest then m end as good, coalesce(u, b, m) as any_day from dated)
select ord, strftime(good, '%Y-%m-%d') as published_at, case when good is null then strftime(any_day, '%Y-%m-%d') end as scheduled_at,
  case when good is null and any_day is null then 'observed_at' when good is null or u <= latest then 'url_path' when b <= latest then 'body_text' else 'body_month_day' end as basis,
  case when good is null and any_day is null then 'observed' when good is null or u <= latest then 'high' else 'low' end as confidence from chosen""",
    "event_topics": f"""
with {HEADLINES_SQL}, named as (select coalesce(tier, role, source, '') as family, coalesce(topic, array_to_string(string_split(title, ' ')[1:4], ' ')) as topic,
  coalesce(nullif(trim(regexp_replace(topic, ' — 亚太.*$', '')), ''), company, case when direction like '支付%' then '支付' end, array_to_string(string_split(trim(regexp_replace(title, '[^A-Za-z0-9_]+', ' ', 'g')), ' ')[1:4], ' ')) as cluster_topic,
  case tier when 'L1' then '官方动作' when 'L2' then '行业交易' when 'L3' then '区域生态' when 'L4' then '垂类信号' else case when ord % 13 = 0 then '补漏来源' else '公开信号' end end as label from heads)
select family, topic, cluster_topic, label, count(*) as headlines from named group by all""",
    "daily_navigation": f"""
with {HEADLINES_SQL}, keyed as (select day, case when ord % 7 = 0 then 'important' when ord % 3 = 0 then 'selected' when ord % 3 = 1 then 'important' else 'watch' end as key from heads),
counts as (select day, count(*) filter (key = 'selected') as selected, count(*) filter (key = 'important') as important, count(*) filter (key = 'watch') as watch from keyed group by day)
select cast(day as varchar) as day, selected, important, watch, '今日事件导航：' || (selected + important + watch) || ' 条合格事件。' ||
  concat_ws('，', case when selected > 0 then '精选 ' || selected || ' 条' end, case when important > 0 then '重点 ' || important || ' 条' end, case when watch > 0 then '观察 ' || watch || ' 条' end) as navigation from counts""",
    "daily_briefs": f"""
with {HEADLINES_SQL}, told as (select ord, day, coalesce(company, nation) as label, nation as region, event_type from heads where event_type <> 'other'),
counts as (select day, count(*) as events from told group by day),
listed as (select * from counts join {_first_sql("label")} using (day) join {_first_sql("region")} using (day) join {_first_sql("event_type")} using (day))
select cast(day as varchar) as day, events, case len(labels) when 3 then '今日优先看' || array_to_string(labels, '、') || '等对象' when 2 then '今日优先看' || array_to_string(labels, '、') else '今日优先看' || labels[1] || '的新动作' end as title,
  '今日新增' || events || '条可读事件，覆盖' || array_to_string(regions, '、') || '，重点类型为' ||
  array_to_string(list_transform(event_types, lambda t: case t when 'funding' then '融资' when 'ma' then '并购' when 'earnings' then '财报' when 'strategy' then '战略' else t end), '、') || '；日报先看对象和证据，周报再收敛窗口和方向。' as judgement from listed""",
    "narrative_evidence": f"""
with {HEADLINES_SQL}, pieces as (select nation as narrative, ord, case when ord % 3 <> 0 then url end as url, case when ord % 11 <> 0 then day end as day, case when ord % 33 <> 0 then title end as title from heads),
keyed as (select *, coalesce(url, nullif(coalesce(cast(day as varchar), '') || '|' || coalesce(title, ''), '|')) as key from pieces),
firsts as (select * from keyed where key is not null qualify row_number() over (partition by narrative, key order by ord) = 1)
select narrative, row_number() over (partition by narrative order by ord) as nth, url, title from firsts qualify nth <= 8""",
}
SQL["feed_links"] = f"""
with {HEADLINES_SQL}, sent as (select *, 'https://site.example/p/' || cast(ord as varchar) as first, case when ord % 3 = 0 then 'https://site.example/news/' || regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g') end as other from heads),
words as (select *, list_filter(list_distinct(regexp_extract_all(lower(title), '[a-z0-9]{{3,}}')), lambda w: not list_contains({_list(readers.URL_STOPWORDS)}, w)) as w from sent),
scored as (select *, len(list_intersect(w, regexp_extract_all(first[21:], '[a-z0-9]{{3,}}'))) as a, len(list_intersect(w, regexp_extract_all(coalesce(other[21:], ''), '[a-z0-9]{{3,}}'))) as b from words)
select ord, title, case when b >= 2 and b > a then other else first end as link, case when b >= 2 and b > a then first end as link_original, strftime(day, '%Y-%m-%d') as day from scored"""
QUERIES = {name: globals()[name] for name in SQL}
