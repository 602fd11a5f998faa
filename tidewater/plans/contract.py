"""The contract spine: classify, scope, score, prioritise and freeze the view of every event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.lexicon import DOMAINS, EVENT_TYPES, FIXTURE, INDUSTRIES, REGIONS, Lexicon
from tidewater.functions.text import amount_millions, title_key
from tidewater.operators import gates, score
from tidewater.sources.fixtures import NEWS_SQL, news, sql_hit, table

TRUSTED = ("L1", "L3", "L4-vertical")


def contract(events: DataFrame, lexicon: Lexicon = FIXTURE, industries: Lexicon = INDUSTRIES) -> DataFrame:
    """All contract columns; every stage only adds columns, and each text is matched once."""
    rows = gates.assess_scope(events, lexicon, industries)
    known = set(rows.columns)
    hit = lambda name: F.col(f"hit_{name}") if f"hit_{name}" in known else F.lit(False)
    quantified, company = hit("quantified"), F.col("is_company")
    action = F.when(hit("policy"), "policy").when(hit("product"), "product").when(hit("capital"), "funding").when(F.col("event_type") == "earnings", "earnings").otherwise("other")
    countries = F.when(F.col("region").isNotNull(), F.when(company, 2).otherwise(1)).otherwise(0)
    fits = F.size("scope_industries") > 0
    in_target = (F.col("scope_status") == "qualified") | fits
    explicit = F.col("event_type").isin("funding", "ma", "earnings", "regional_policy") | hit("industry_change") | hit("action") | quantified
    rows = rows.withColumns({"relevance": gates.relevance_of(hit), "amount": amount_millions(F.col("title")), "text_length": F.length("text")})
    rows = rows.withColumns(
        {
            "base_score": score.base_score(F.col("amount"), F.col("event_type"), F.col("scope_layer"), F.size("scope_industries"), F.col("tier").isin(*TRUSTED), F.col("company").isNotNull(), F.col("region")),
            "change": score.change_score(in_target, explicit, quantified, action, fits, countries),
        }
    )
    base = score.authority((F.col("ord") % 12).cast("double"), F.col("tier"))
    confidence = score.confidence(base, F.col("url").isNotNull(), F.col("source").isNotNull(), F.col("text_length") > 600, F.col("ord") % 60 >= 45, company, quantified)
    attention = score.attention(F.col("change.score"), F.col("relevance"), F.col("company").isNotNull(), F.col("scope_status"), F.col("ord") % 2 == 0, F.col("scope_status") == "filtered", F.col("score") >= 7)
    rows = rows.withColumns({"confidence": confidence, "attention": attention})
    rows = rows.withColumn("grade", score.grade(F.least("confidence", "attention")))
    return gates.view_gates(rows.withColumn("bd_priority", gates.bd_priority()))


def relevance_funnel_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", FIXTURE.found(F.lower("text")).alias("terms"))
    docs = docs.select("source", gates.relevance_of(lambda name: FIXTURE.in_found(F.col("terms"), name)).alias("relevance"))
    count = lambda c: F.count_if(c)
    return docs.groupBy("source").agg(F.count("*").alias("pool"), count(F.col("relevance") == 3).alias("core"), count(F.col("relevance") >= 2).alias("mainline"), count(F.col("relevance") == 0).alias("dropped"))


def scope_gate_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.assess_scope(news(spark, sf_dir), FIXTURE, INDUSTRIES).groupBy("scope_status", "scope_reason", "scope_layer").agg(F.count("*").alias("events"), F.sum(F.size("scope_industries")).alias("industries"))


def event_type_multilabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels per text; report and model suppress strategy; none is 'other'."""
    docs = table(spark, sf_dir, "documents").select("lang", EVENT_TYPES.found(F.lower("text")).alias("terms"))
    docs = docs.select("lang", EVENT_TYPES.found_labels(F.col("terms")).alias("labels"))
    labels = F.col("labels")
    first_class = F.arrays_overlap(labels, F.array(F.lit("report"), F.lit("model")))
    labels = F.when(first_class, F.array_remove(labels, "strategy")).otherwise(labels)
    labels = F.when(F.size(labels) == 0, F.array(F.lit("other"))).otherwise(labels)
    return docs.select("lang", F.explode(labels).alias("event_type")).groupBy("lang", "event_type").agg(F.count("*").alias("events"))


def domain_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", DOMAINS.most(F.lower("text"), "other").alias("domain"))


def region_first_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = news(spark, sf_dir)
    return rows.select("ord", REGIONS.first(F.lower("title"), F.coalesce("region", F.lit("GLOBAL"))).alias("region"))


def contract_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contract(news(spark, sf_dir))
    return rows.select("ord", "relevance", "base_score", F.col("change.score").alias("change_score"), F.col("change.blocked").alias("change_blocked"), "confidence", "attention", "grade")


def view_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract(news(spark, sf_dir)).select("ord", "bd_priority", "in_main", "in_review", "view_status", "drop_reason")


def signal_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type and in total: pool, signal, main, review and dropped rows."""
    rows = contract(news(spark, sf_dir)).select("event_type", "scope_status", "view_status")
    status = F.col("view_status")
    return rows.rollup("event_type").agg(
        F.count("*").alias("pool"),
        F.count_if((F.col("scope_status") == "qualified") & (F.col("event_type") != "other")).alias("signal"),
        F.count_if(status == "main").alias("main"),
        F.count_if(status == "review").alias("review"),
        F.count_if(status == "filtered").alias("dropped"),
    )


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id", "left").withColumn("title", F.substring("text", 1, 40))
    summary = F.when(F.col("doc_id") % 4 == 0, F.substring("text", 1, 30)).when(F.col("doc_id") % 4 == 1, "").otherwise(F.substring("text", 20, 30))
    flags = gates.quality_flags(summary, F.when(F.col("quality") == 1, F.lit("explained")), F.when(F.col("toxic") == 0, F.lit("known")).otherwise("Unknown"), F.col("title"))
    rows = rows.select("source", flags.alias("flags"))
    flagged = lambda name: F.count_if(F.array_contains("flags", name)).alias(name)
    return rows.groupBy("source").agg(
        F.count("*").alias("events"),
        F.count_if(F.size("flags") == 0).alias("clean"),
        flagged("missing_summary"),
        flagged("summary_repeats_title"),
        flagged("missing_reason"),
        flagged("unknown_impact"),
        (F.count_if(F.size("flags") > 0) / F.count("*")).alias("repair_ratio"),
    )


def title_key_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each normalised title longer than 10, and the ratio of repeats."""
    rows = news(spark, sf_dir).select("ord", title_key(F.col("title")).alias("title_key")).filter(F.length("title_key") > 10)
    grouped = rows.groupBy("title_key").agg(F.min("ord").alias("first_ord"), F.count("*").alias("copies"))
    return grouped.filter("copies > 1")


def _hit(name: str, text: str = "body") -> str:
    return sql_hit(text, FIXTURE.terms(name))


def _labels(lexicon: Lexicon, text: str) -> str:
    return "list_filter([" + ", ".join(f"case when {sql_hit(text, terms)} then '{name}' end" for name, terms in lexicon.classes) + "], lambda x: x is not null)"


_RELEVANCE = f"""case when {_hit('hard_out')} then 0 when {_hit('core')} then case when {_hit('out')} then 2 else 3 end
  when {_hit('adjacent')} then 2 when {_hit('edge')} then 1 when {_hit('out')} then 0 else 1 end"""

_SCOPE = f"""{NEWS_SQL},
hits as (
  select *, lower(title || ' ' || text) as body, lower(title) as low_title, coalesce(role = 'official_ir' or tier in ('L1', 'L4-vertical') or is_company, false) as trusted from news),
found as (
  select *, {_labels(INDUSTRIES, 'body')} as direct, {_hit('policy')} as h_policy, {_hit('digital')} as h_digital, {_hit('industry_change')} as h_industry,
    {_hit('quantified')} as h_quantified, {_hit('action')} as h_action, {_hit('policy', 'low_title')} as t_policy, {_hit('structural', 'low_title')} as t_structural,
    {_hit('editorial', 'low_title')} as t_editorial, {_hit('action', 'low_title')} as t_action, {_hit('quantified', 'low_title')} as t_quantified,
    {_hit('product')} as h_product, {_hit('capital')} as h_capital, {_RELEVANCE} as relevance from hits),
picked as (
  select *, h_action or event_type in ('funding', 'ma', 'earnings', 'regional_policy', 'strategy') as acts,
    case when len(direct) > 0 then direct when declared_industries is not null and trusted
      and (h_action or event_type in ('funding', 'ma', 'earnings', 'regional_policy', 'strategy') or h_industry or is_company) then declared_industries else [] end as scope_industries from found),
cases as (
  select *, len(scope_industries) = 0 as nothing, (t_policy and h_digital) or event_type = 'regional_policy' as leg_a,
    coalesce(region is not null and region <> 'GLOBAL', false) and t_structural and h_digital as leg_b,
    t_editorial and not (t_policy or t_action or t_quantified) as editorial, not (h_policy or h_industry or acts) as no_change from picked),
scoped as (
  select *, case when nothing and (leg_a or leg_b) then 'qualified' when nothing then 'filtered' when editorial or no_change then 'candidate' else 'qualified' end as scope_status,
    case when nothing and leg_a then 'policy_without_industry' when nothing and leg_b then 'structural_without_industry' when nothing then 'no_target_industry'
      when editorial then 'editorial_title' when no_change then 'no_explicit_change' else 'direct_industry_change' end as scope_reason,
    case when nothing and leg_a then 'regional_policy' when nothing and leg_b then 'industry_change' when nothing or editorial or no_change then null
      when h_policy then 'regional_policy' when h_industry and not is_company then 'industry_change' else 'company_action' end as scope_layer from cases)
"""

_CONTRACT = f"""{_SCOPE},
amounts as (
  select *, regexp_extract(title, '(?i)[$€]\\s?([0-9][0-9,]*(?:\\.[0-9]+)?)\\s?(billion|bn|b|million|mn|m)\\b', 1) as money,
    lower(regexp_extract(title, '(?i)[$€]\\s?([0-9][0-9,]*(?:\\.[0-9]+)?)\\s?(billion|bn|b|million|mn|m)\\b', 2)) as unit from scoped),
points as (
  select *, coalesce(try_cast(replace(money, ',', '') as double) * case when unit like 'b%' then 1000 else 1 end, 0) as amount from amounts),
based as (
  select *, least(greatest(cast(trunc(cast(
      case when amount >= 1000 then 5 when amount >= 500 then 4 when amount >= 100 then 3 when amount >= 20 then 2 when amount >= 5 then 1 else 0 end
      + case when event_type in ('ma', 'earnings', 'report', 'model', 'regional_policy') then 2 when event_type in ('funding', 'strategy') then 1 else 0 end
      + case scope_layer when 'regional_policy' then 3 when 'industry_change' then 2 when 'company_action' then 1 else 0 end
      + case when len(scope_industries) > 0 then 1 else 0 end + case when tier in ('L1', 'L3', 'L4-vertical') then 1 else 0 end
      + case when company is not null then 1 else 0 end as double)
      * case region when 'AFRICA' then 1.3::double when 'MIDDLE EAST' then 1.25::double when 'ASIA' then 1.2::double when 'AMERICA' then 1.15::double else 1.0::double end) as integer), 1), 10) as base_score,
    case when not (scope_status = 'qualified' or len(scope_industries) > 0) then 'out_of_target_industry'
      when not (event_type in ('funding', 'ma', 'earnings', 'regional_policy') or h_industry or h_action or h_quantified) then 'no_explicit_change' end as change_blocked,
    least(100, case when h_quantified then 35 else 20 end
      + case when h_policy then 25 when h_product then 24 when h_capital then 22 when event_type = 'earnings' then 18 else 15 end
      + case when len(scope_industries) > 0 then 20 else 12 end + case when region is null then 0 when is_company then 11 else 8 end) as change_points from points),
scored as (
  select *, case when change_blocked is not null then 0 else change_points end as change_score,
    least(100, cast(round_even(case when ord % 12 > 0 then least(greatest((ord % 12)::double * 3.5::double, 8), 35)
        else case tier when 'L1' then 33 when 'L4-vertical' then 29 when 'L3' then 23 when 'L2' then 20 when 'L5' then 10 else 16 end end
      + 10 + case when source is not null then 8 else 0 end + case when length(text) > 600 then 7 else 0 end + case when ord % 60 >= 45 then 15 else 7 end
      + case when is_company then 10 else 5 end + case when h_quantified then 5 else 0 end, 0) as integer)) as confidence from based),
attended as (
  select *, least(100, least(45, change_score) + case when relevance >= 3 then 20 else 10 end + case when company is not null then 5 else 0 end
    + case scope_status when 'qualified' then 20 when 'filtered' then 0 else 8 end
    + case when scope_status = 'filtered' then 0 when ord % 2 = 0 then 15 else 10 end + case when score >= 7 then 10 else 5 end) as attention from scored),
ranked as (
  select *, case when least(confidence, attention) >= 80 then 'A' when least(confidence, attention) >= 65 then 'B' when least(confidence, attention) >= 50 then 'C' else 'D' end as grade,
    case when scope_status <> 'qualified' then 'watch' when event_type = 'funding' and not actionable then 'watch'
      when event_type in ('report', 'model') then case when needs_review then 'watch' when attention >= 70 and confidence >= 65 then 'high' when attention >= 50 and confidence >= 50 then 'mid' else 'watch' end
      when event_type = 'other' then case when is_company and tier = 'L1' and score >= 4 then 'mid' else 'watch' end
      when is_google and low_signal then 'watch' when score >= case when tier = 'L1' then 5 else 7 end then 'high'
      when event_type in ('funding', 'ma', 'earnings') and score >= 5 and not is_google then 'high'
      when event_type in ('funding', 'ma', 'earnings', 'regional_policy', 'strategy') and (score >= 4 or is_company) then 'mid' else 'watch' end as bd_priority from attended),
gated as (
  select *, scope_status = 'qualified' and relevance >= 2 and not needs_review and (
      (bd_priority = 'high' and not needs_review and actionable and event_type <> 'other' and not is_google)
      or (actionable and case when event_type in ('report', 'model') then not is_google and attention >= 50 and confidence >= 50
        else event_type in ('funding', 'ma', 'earnings', 'regional_policy', 'strategy') and not is_google and score >= 2 end)) as in_main from ranked),
viewed as (
  select *, not in_main and scope_status = 'qualified' and relevance >= 2 and case
      when event_type in ('report', 'model') then attention >= 40 and confidence >= 45 and not needs_review
      when is_google then event_type in ('funding', 'ma', 'earnings', 'regional_policy', 'strategy') and score >= 5 and not low_signal and not needs_review
      else event_type in ('funding', 'ma', 'earnings', 'regional_policy', 'strategy') and (score >= 3 or bd_priority = 'mid') end as in_review from gated),
final as (
  select *, case when in_main then 'main' when in_review then 'review' else 'filtered' end as view_status,
    case when in_main then 'main' when scope_status <> 'qualified' then 'out_of_scope_industry' when event_type = 'funding' and not actionable then 'capital_only_low_actionability'
      when needs_review then 'quality_review' when is_google then 'google_not_main' when event_type = 'other' then 'other_type' else 'weak_signal' end as drop_reason from viewed)
"""

_DOMAIN_COUNTS = ", ".join("(" + " + ".join(f"cast(contains(lower(text), '{t}') as integer)" for t in terms) + f") as n_{name}" for name, terms in DOMAINS.classes)
_DOMAIN_MAX = "greatest(" + ", ".join(f"n_{name}" for name, _ in DOMAINS.classes) + ")"

SQL = {
    "relevance_funnel_by_source": f"""
with labelled as (select source, {_RELEVANCE} as relevance from (select source, lower(text) as body from documents))
select source, count(*) as pool, count(*) filter (relevance = 3) as core, count(*) filter (relevance >= 2) as mainline, count(*) filter (relevance = 0) as dropped
from labelled group by source""",
    "scope_gate_status": f"with {_SCOPE} select scope_status, scope_reason, scope_layer, count(*) as events, cast(sum(len(scope_industries)) as bigint) as industries from scoped group by all",
    "event_type_multilabel": f"""
with labelled as (select lang, {_labels(EVENT_TYPES, 'lower(text)')} as labels from documents),
kept as (select lang, case when list_contains(labels, 'report') or list_contains(labels, 'model') then list_filter(labels, lambda x: x <> 'strategy') else labels end as labels from labelled)
select lang, event_type, count(*) as events from (select lang, unnest(case when len(labels) = 0 then ['other'] else labels end) as event_type from kept) group by all""",
    "domain_argmax": f"""
select doc_id, case when {_DOMAIN_MAX} = 0 then 'other' {' '.join(f"when n_{name} = {_DOMAIN_MAX} then '{name}'" for name, _ in DOMAINS.classes)} end as domain
from (select doc_id, {_DOMAIN_COUNTS} from documents)""",
    "region_first_hit": f"""
with {NEWS_SQL} select ord, case {' '.join(f"when {sql_hit('lower(title)', terms)} then '{name}'" for name, terms in REGIONS.classes)} else coalesce(region, 'GLOBAL') end as region from news""",
    "contract_scores": f"with {_CONTRACT} select ord, relevance, base_score, change_score, change_blocked, confidence, attention, grade from final",
    "view_contract": f"with {_CONTRACT} select ord, bd_priority, in_main, in_review, view_status, drop_reason from final",
    "signal_funnel": f"""
with {_CONTRACT} select event_type, count(*) as pool, count(*) filter (scope_status = 'qualified' and event_type <> 'other') as signal, count(*) filter (view_status = 'main') as main,
  count(*) filter (view_status = 'review') as review, count(*) filter (view_status = 'filtered') as dropped from final group by rollup (event_type)""",
    "quality_summary": """
with rows as (
  select source, substring(text, 1, 40) as title, case doc_id % 4 when 0 then substring(text, 1, 30) when 1 then '' else substring(text, 20, 30) end as summary,
    quality = 1 as explained, toxic = 0 as known from documents left join labels using (doc_id)),
flags as (
  select source, trim(summary) = '' as f1, trim(summary) <> '' and starts_with(title, substring(summary, 1, 12)) as f2, not coalesce(explained, false) as f3, not coalesce(known, false) as f4 from rows)
select source, count(*) as events, count(*) filter (not (f1 or f2 or f3 or f4)) as clean, count(*) filter (f1) as missing_summary, count(*) filter (f2) as summary_repeats_title,
  count(*) filter (f3) as missing_reason, count(*) filter (f4) as unknown_impact, count(*) filter (f1 or f2 or f3 or f4)::double / count(*) as repair_ratio from flags group by source""",
    "title_key_duplicates": f"""
with {NEWS_SQL}, keys as (select ord, regexp_replace(lower(title), '[^a-z0-9]+', '', 'g') as title_key from news)
select title_key, min(ord) as first_ord, count(*) as copies from keys where length(title_key) > 10 group by title_key having count(*) > 1""",
}
QUERIES = {name: globals()[name] for name in SQL}
