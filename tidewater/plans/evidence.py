"""Queries over repeated reports: dedupe, evidence atoms, themes and changes, each with its SQL oracle.

The rules depend on order, so the oracles walk the rows of a block one by one in a
recursive query.  They state patterns and word lists on their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import changes, cluster, dedupe, reports
from tidewater.plans.headlines import HEADLINES_SQL, _key_sql, _subject_sql, headlines
from tidewater.sources.fixtures import NEWS_SQL, news


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines as reports of tracked and other companies; some are wrongly filed, some are about prices."""
    k, rows = F.col("ord"), headlines(spark, sf_dir)
    company = F.when(k % 11 == 0, "Other Firm").otherwise(F.col("company"))
    title = F.when(k % 13 == 0, F.concat("title", F.lit(" price target"))).otherwise(F.col("title"))
    return rows.select(
        "ord", title.alias("title"), F.concat(F.lit("https://site.example/"), (k % 5000).cast("string")).alias("url"), F.array("event_type").alias("event_types"), company.alias("company"),
        F.lit(None).cast("array<string>").alias("companies"), (F.col("tracked") & company.isNotNull()).alias("is_company"), F.when(k % 22 == 0, F.array(F.lit("nova"), F.lit("kite-cloud"))).alias("aliases"), "day",
    )


def daily_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe_daily(_told(spark, sf_dir), [], ["quill & sons", "delta-cart"])


def display_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe_display(_told(spark, sf_dir))


def _news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news(spark, sf_dir).withColumn("companies", F.when(F.col("company").isNotNull(), F.array("company")))


def evidence_atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster.evidence_atoms(_news(spark, sf_dir))


def weekly_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per week and region: facts, sources and companies of what may be promoted, scored."""
    rows = _news(spark, sf_dir).withColumns({"week": F.weekofyear("day"), "topic": F.lit(""), "source_family": F.col("tier")})
    facts = rows.join(cluster.evidence_atoms(rows, [F.col("week"), F.col("region")]), "ord")
    stats = cluster.independence(facts, ["week", "region"]).filter("promotable")
    points = 4 * F.col("atoms") + 2 * F.col("sources") + F.col("companies")
    return stats.select("week", "region", "atoms", "sources", "companies", points.alias("theme_score"), F.when((F.col("atoms") >= 4) & (F.col("sources") >= 2), "high").otherwise("mid").alias("confidence"))


def _changing(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.when(F.col("company").isNotNull(), F.array("company")).otherwise(F.array().cast("array<string>"))
    return headlines(spark, sf_dir).filter("event_type <> 'other'").withColumns({"companies": named, "source_family": F.coalesce("tier", "role", "source"), "topic": F.coalesce("topic", F.lit(""))})


def company_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every quarter of every company against the three before."""
    return changes.atom_changes(_changing(spark, sf_dir), "company", 91, "2022-01-01")


def market_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every four weeks of every nation against the twelve before."""
    return changes.atom_changes(_changing(spark, sf_dir), "nation", 28, "2022-01-01")


def weekly_focus_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best windows of every week of headlines."""
    k, rows = F.col("ord"), headlines(spark, sf_dir)
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), "day").cast("string"), F.lit("-W"), F.lpad(F.weekofyear("day").cast("string"), 2, "0"))
    triggers = F.when(k % 10 == 1, F.array(F.lit("生态窗口"))).when(k % 10 == 2, F.array(F.lit("别的"), F.lit("合规窗口")))
    direction = F.when(k % 6 == 0, "支付/持续").when(k % 6 == 1, "AI 算力 / 云").when(k % 6 == 2, "其他/支付")
    rows = rows.withColumns({"period": week, "region": F.substring("nation", 1, 8), "triggers": triggers, "direction": direction, "object": F.coalesce("company", F.substring("title", 1, 18)), "source": F.coalesce("tier", "source")})
    rows = rows.withColumns({"priority": F.when(k % 8 == 0, "高").when(k % 8 < 3, "中").otherwise("观察"), "high_value": k % 9 == 0, "is_google": k % 13 == 0, "mainline": k % 17 != 0, "score": (k % 11).cast("int")})
    return reports.focus_windows(rows)


_FACT_STOP = "['the', 'a', 'an', 'to', 'for', 'of', 'in', 'on', 'and', 'with', 'from', 'raises', 'raised', 'funding', 'acquires', 'acquire', 'acquisition', 'launches', 'launch', 'announces', 'new', 'company', 'startup', 'report']"
_FACT_TOKENS = f"list_distinct([t for t in regexp_extract_all(lower(title), '[a-z0-9][a-z0-9.+-]*|[\\x{{4e00}}-\\x{{9fff}}]{{2,}}') if len(t) > 1 and not list_contains({_FACT_STOP}, t)])"
_TITLE_STOP = "['the', 'and', 'for', 'with', 'from', 'into', 'over', 'under', 'amid', 'after', 'before', 'across', 'through', 'about', 'says', 'report', 'reports', 'reported', 'launch', 'launches', 'launched', 'announces', 'announced', 'latest', 'today', 'week', 'news', 'update', 'live', 'analysis', 'opinion']"
_PLAIN = "trim(regexp_replace(replace(lower({}), '&', ' and '), '[^a-z0-9\\x{{4e00}}-\\x{{9fff}}]+', ' ', 'g'))"


def _atoms_sql(rows: str, block: str) -> str:
    """CTEs that end in ``atoms`` (ord, atom) for rows (ord, title, companies, day) of one block each."""
    return f"""
facts as materialized (select ord, {block} as block, day, [lower(c) for c in companies] as named, {_FACT_TOKENS} as words from {rows}),
twins as materialized (
  select a.ord as early, b.ord as late from facts a join facts b on a.block = b.block and a.ord < b.ord and abs(date_diff('day', a.day, b.day)) <= 2
  where case when len(a.named) > 0 and len(b.named) > 0 then len(list_intersect(a.named, b.named)) > 0
    else len(list_intersect(a.words, b.words)) >= 3 and len(list_intersect(a.words, b.words)) / len(list_distinct(a.words || b.words)) >= 0.35 end),
numbered as materialized (
  select block, ord, row_number() over (partition by block order by ord) as i, coalesce(early, []) as early
  from facts left join (select late, list(early) as early from twins group by late) on late = ord),
walk as (
  select distinct block, 0::bigint as i, null::bigint as ord, null::bigint as atom, []::bigint[] as leaders from numbered
  union all
  select n.block, n.i, n.ord, coalesce(list_min(list_intersect(w.leaders, n.early)), n.ord),
    case when list_min(list_intersect(w.leaders, n.early)) is null then list_append(w.leaders, n.ord) else w.leaders end
  from walk w join numbered n on n.block = w.block and n.i = w.i + 1),
atoms as materialized (select ord, atom from walk where i > 0)"""


def _changes_sql(key: str, span: int) -> str:
    return f"""
with recursive {HEADLINES_SQL},
rows as materialized (select *, {key} as key, cast(floor(date_diff('day', date '2022-01-01', day) / {span}) as integer) as win, coalesce(tier, role, source) as family,
  case when company is null then []::varchar[] else [company] end as companies from heads where event_type <> 'other'),
keyed as materialized (select * from rows where key <> ''), {_atoms_sql("keyed", "event_type || '|' || win || '|' || key")},
joined as materialized (select keyed.*, atom from keyed join atoms using (ord)),
largest as (select win, key, max(n) as largest from (select win, key, source, count(*) as n from joined group by all) group by all),
stats as materialized (
  select win, key, count(distinct atom) as atoms, count(distinct yearweek(day)) as weeks, count(distinct source) as sources, count(distinct company) as companies, count(*) as reports,
    count(distinct family) as families, count(distinct event_type) as types, count(distinct day) as days, count(distinct case when ord = atom and topic <> '' then topic end) as topics
  from joined group by all),
totals as (select win, count(*) as total from rows group by win),
cover as (select b.win, count(*) as windows, avg(a.total) as mean_total from totals a join totals b on a.win between b.win - 3 and b.win - 1 group by b.win),
before as (select b.win, b.key, sum(a.atoms) as before from stats a join stats b on a.key = b.key and a.win between b.win - 3 and b.win - 1 group by all),
rated as (
  select s.*, t.total, c.windows, case when c.windows > 0 then coalesce(b.before, 0) / c.windows else 0 end as baseline, case when c.windows > 0 then t.total / c.mean_total else 1 end as ratio, c.mean_total
  from stats s join largest l using (win, key) join totals t using (win) left join cover c using (win) left join before b using (win, key)
  where atoms >= 3 and weeks >= 2 and not (largest / reports > 0.75 and sources < 2 and s.companies < 2 and days < 2) and greatest(s.companies, families, types, topics, days) >= 2),
adj as (select *, atoms * case when ratio < 0.8 or ratio > 1.25 then least(greatest(mean_total / total, 0.75), 1.30) else 1 end as adjusted from rated)
select win as "window", key, atoms, weeks, sources, companies, baseline::double as baseline, ratio::double as coverage_ratio, adjusted::double as adjusted,
  case when windows is null then 'new' when adjusted >= baseline + 2 and case when baseline > 0 then adjusted / baseline else 2 end >= 1.25 then 'rising'
    when adjusted <= baseline - 2 and case when baseline > 0 then adjusted / baseline else 0 end <= 0.75 then 'falling' else 'steady' end as change,
  4 * atoms + 3 * weeks + greatest(round_even(adjusted - baseline, 0), 0) as change_score
from adj"""


_TOLD_SQL = f"""{HEADLINES_SQL},
reports as materialized (
  select ord, day, event_type as type, case when ord % 11 = 0 then 'Other Firm' else company end as named, tracked, name, c, ord % 22 = 0 as aliased,
    'https://site.example/' || cast(ord % 5000 as varchar) as url, title || case when ord % 13 = 0 then ' price target' else '' end as title from heads),
spoken as materialized (select *, regexp_replace(title, ' - The Wire$', '') as said, lower(title) as low from reports),
worded as materialized (
  select *, list_distinct([t for t in string_split({_PLAIN.format("case when title like '% - The Wire price target' then title[1:strpos(title, ' - The Wire') - 1] else said end")}, ' ')
    if not list_contains({_TITLE_STOP}, t) and (len(t) > 2 or list_contains(['q1', 'q2', 'q3', 'q4', 'ai', 'ipo'], t)) and not regexp_full_match(t, '[0-9]+')]) as words,
    regexp_replace(low, '[^a-z0-9]+', '', 'g') as key,
    regexp_matches(low, 'down|drop|falls|fall|fell|loss|losses|miss|misses|decline|plunge|slump') as loss,
    case type when 'earnings' then regexp_matches(low, '\\bq[1-4]\\b|revenue|earnings|profit|quarter|result|financial|fiscal|income|operating')
      when 'funding' then regexp_matches(low, '\\bseries\\s|raise|funding|seed|valuation|valued|investment|secure|close|bags|landed|[$€£]|unicorn|ipo|listing|filing|registration')
      when 'ma' then regexp_matches(low, 'acquires|acquired|acquisition|merge|merging|buys|buying|purchase|takeover') else true end as anchored
  from spoken)"""


_NAMED_SQL = f"""{_TOLD_SQL},
cleaned as (select *, regexp_replace(said, '^[^A-Za-z0-9]{{0,3}}[^:]{{2,36}}:\\s*', '') as clean from worded),
subjected as materialized (select *, {_subject_sql()} as subject from cleaned),
keyed as materialized (
  select *, array_to_string(string_split(trim(regexp_replace({_PLAIN.format("named")}, '( (inc|incorporated|limited|ltd|corporation|corp|holdings|technologies|technology|plc|ag))+$', '')), ' ')[1:4], ' ') as firm,
    case when contains(low, 'quill & sons') then 'quill and sons' when contains(low, 'delta-cart') then 'delta cart' end as alias
  from subjected)"""
_ALIKE = "case when len(a.words) = 0 or len(b.words) = 0 then 0 else len(list_intersect(a.words, b.words)) / len(list_distinct(a.words || b.words)) end"


SQL = {
    "evidence_atoms": f"""
with recursive {NEWS_SQL}, rows as (select *, case when company is null then []::varchar[] else [company] end as companies from news), {_atoms_sql("rows", "event_type")}
select * from atoms""",
    "weekly_themes": f"""
with recursive {NEWS_SQL}, rows as materialized (select *, week(day) as week, case when company is null then []::varchar[] else [company] end as companies from news),
{_atoms_sql("rows", "event_type || '|' || week(day) || '|' || region")},
joined as materialized (select rows.*, atom from rows join atoms using (ord)),
largest as (select week, region, max(n) as largest from (select week, region, source, count(*) as n from joined where source <> '' group by all) group by all),
stats as (select week, region, count(*) as reports, count(distinct atom) as atoms, count(distinct nullif(source, '')) as sources, count(distinct company) as companies, count(distinct tier) as families, count(distinct event_type) as types, count(distinct day) as days from joined group by all)
select cast(week as integer) as week, region, atoms, sources, companies, 4 * atoms + 2 * sources + companies as theme_score, case when atoms >= 4 and sources >= 2 then 'high' else 'mid' end as confidence
from stats join largest using (week, region)
where atoms >= 2 and not (largest / reports > 0.75 and sources < 2 and companies < 2 and days < 2) and greatest(companies, families, types, days) >= 2""",
    "daily_dedupe": f"""
with recursive {_NAMED_SQL},
judged as materialized (
  select *, coalesce(firm, alias, subject) as entity, firm is null and alias is null and subject <> '' as by_title, tracked and named is not null as own from keyed),
twins as materialized (
  select a.ord as early, b.ord as late from judged a join judged b on a.day = b.day and a.ord < b.ord
  where a.url = b.url or case
    when a.type = b.type and a.entity <> '' and a.entity = b.entity and a.type in ('funding', 'ma', 'earnings')
      then a.anchored and b.anchored and (a.type <> 'earnings' or a.loss = b.loss) and ({_ALIKE} >= 0.4 or not (a.by_title or b.by_title))
    when a.type = b.type and a.entity <> '' and a.entity = b.entity and a.type = 'strategy' then {_ALIKE} >= 0.42
    else {_ALIKE} >= 0.72 end),
numbered as materialized (
  select day, ord, row_number() over (partition by day order by ord) as i, coalesce(early, []) as early, case when own then named else '' end as capped,
    case when own and ord % 11 = 0 and not (aliased and (name like 'Nova %' or name like 'Kite Cloud %')) then 'alias' when own and ord % 13 = 0 then 'low_signal' end as noise
  from judged left join (select late, list(early) as early from twins group by late) on late = ord),
walk as (
  select distinct day, 0::bigint as i, null::bigint as ord, null::varchar as fate, null::bigint as twin, []::bigint[] as kept, []::varchar[] as firms from numbered
  union all
  select day, i, ord, fate, case when fate = 'repeat' then twin end, case when fate = 'kept' then list_append(kept, ord) else kept end, case when fate = 'kept' then list_append(firms, capped) else firms end
  from (
    select n.day, n.i, n.ord, n.capped, w.kept, w.firms, list_min(list_intersect(w.kept, n.early)) as twin,
      coalesce(n.noise, case when list_min(list_intersect(w.kept, n.early)) is not null then 'repeat' when n.capped <> '' and len([f for f in w.firms if f = n.capped]) >= 3 then 'cap' else 'kept' end) as fate
    from walk w join numbered n on n.day = w.day and n.i = w.i + 1))
select ord, fate, twin from walk where i > 0""",
    "display_dedupe": f"""
with recursive {_NAMED_SQL},
judged as materialized (
  select *, case when key <> '' then min(ord) over (partition by key) else ord end as first_ord, coalesce(nullif(subject, ''), nullif({_key_sql("coalesce(named, '')")}, ''), '') as entity from keyed),
grouped as materialized (select * from judged where first_ord = ord and entity <> '' and type in ('funding', 'ma', 'earnings', 'strategy')),
twins as materialized (
  select a.ord as early, b.ord as late from grouped a join grouped b on a.type = b.type and a.entity = b.entity and a.ord < b.ord
  where abs(date_diff('day', a.day, b.day)) <= case when a.type = 'strategy' then 0 else 3 end and {_ALIKE} >= 0.3),
numbered as materialized (
  select type || '|' || entity as block, ord, row_number() over (partition by type, entity order by ord) as i, coalesce(early, []) as early
  from grouped left join (select late, list(early) as early from twins group by late) on late = ord),
walk as (
  select distinct block, 0::bigint as i, null::bigint as ord, null::bigint as twin, []::bigint[] as kept from numbered
  union all
  select n.block, n.i, n.ord, list_min(list_intersect(w.kept, n.early)), case when list_min(list_intersect(w.kept, n.early)) is null then list_append(w.kept, n.ord) else w.kept end
  from walk w join numbered n on n.block = w.block and n.i = w.i + 1)
select ord, case when first_ord < ord or twin is not null then 'repeat' else 'kept' end as fate, case when first_ord < ord then first_ord else twin end as twin
from judged left join (select ord, twin from walk where i > 0) using (ord)""",
    "weekly_focus_windows": f"""
with {HEADLINES_SQL},
told as (
  select *, substring(nation, 1, 8) as region, strftime(day, '%G-W%V') as period, coalesce(company, substring(title, 1, 18)) as object, coalesce(tier, source) as origin,
    case when ord % 8 = 0 then 3 when ord % 8 < 3 then 2 else 1 end as prio, ord % 9 = 0 as fine, ord % 11 as score,
    case when event_type in ('funding', 'ma', 'earnings') then event_type when ord % 10 = 1 then 'expansion' when ord % 10 = 2 then 'compliance'
      when ord % 6 = 0 then 'payment' when ord % 6 = 1 then 'ai_infra' else 'strategy' end as signal
  from heads where event_type <> 'other' and ord % 13 <> 0 and ord % 17 <> 0),
kept as (select * from told where fine or prio > 1 or event_type in ('funding', 'ma', 'earnings')),
grouped as (
  select period, region, signal, count(*) as events, count(distinct object) as objects, count(distinct origin) as sources, count(distinct day) as days, count(*) filter (prio = 3 or fine) as high
  from kept group by all having count(*) >= 2 and (count(distinct object) >= 2 or count(distinct origin) >= 2 or count(distinct day) >= 2)),
ordered as (select *, row_number() over (partition by period, region, signal order by prio desc, score desc, day desc, ord) as place from kept),
firsts as (select period, region, signal, object, min(place) as place from ordered group by all),
named as (select period, region, signal, array_to_string(list(object order by place)[1:4], '、') as names from firsts group by all),
scored as (select *, case when events >= 4 and high >= 2 then '高' when high > 0 then '中' else '观察' end as confidence, 3 * events + 5 * high + objects as window_score from grouped join named using (period, region, signal))
select period, cast(row_number() over w as integer) as place, region, signal, names, events, objects, high, confidence, window_score from scored
window w as (partition by period order by confidence = '高' desc, window_score desc, events desc, region, signal) qualify row_number() over w <= 3""",
    "company_changes": _changes_sql("company", 91),
    "market_changes": _changes_sql("nation", 28),
}
QUERIES = {name: globals()[name] for name in SQL}
