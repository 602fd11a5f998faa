"""Reports over events, news, orders and pages, each with its SQL oracle."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import dates
from tidewater.functions.text import title_key, tokens
from tidewater.operators import health, joins, narrative, reports, score, state, windows
from tidewater.plans.contract import _CONTRACT, contract
from tidewater.sources.fixtures import NEWS_SQL, news, table

#: Entity aliases of the fixture: words and phrases that occur in the invented texts.
ALIASES = ((1, "ai"), (1, "the ing"), (2, "thou"), (3, "of the"), (3, "and"), (4, "die"), (5, "que de"), (6, "in the on"))


def near_duplicate_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = news(spark, sf_dir).select("ord", "day", tokens(F.col("title")).alias("tokens"))
    return joins.similar_sets(rows, "ord", "tokens", 0.72, "day", 3)


def weekly_narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return narrative.narratives(narrative.ranked_clusters(contract(news(spark, sf_dir))))


def company_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return narrative.company_cards(news(spark, sf_dir), "2024-02-20")


def weight_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three weightings of the score parts, and how far their leaders agree."""
    rows = contract(news(spark, sf_dir)).select("ord", F.col("change.score").cast("double").alias("change"), F.col("confidence").cast("double").alias("confidence"), F.col("attention").cast("double").alias("attention"))
    weights = {"even": {}, "change": {"change": 2.0, "confidence": 0.5}, "trust": {"confidence": 2.0, "attention": 0.25}}
    return narrative.weight_report(rows, weights, ["change", "confidence", "attention"])


def quick_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contract(news(spark, sf_dir)).withColumn("title_key", title_key(F.col("title")))
    return health.quick_facts(rows, "2024-02-20")


def health_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = {"future": ("most", 0), "main": ("least", 1), "review_ratio": ("most", 0.02), "duplicate_ratio": ("most", 0.9), "source_share": ("most", 0.04)}
    return health.gate_failures(quick_health(spark, sf_dir), limits)


def collection_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("run")).agg(F.count("*").alias("raw"), F.countDistinct("user_id").alias("sources"))
    return health.collection_timing(runs)


def over_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = health.over_rate(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", 2)
    return found.withColumn("starts", F.date_format("starts", "yyyy-MM-dd HH"))


def smart_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = news(spark, sf_dir).select("day", "ord", "event_type", "region", "company", F.col("score").alias("priority"), (F.col("tier") == "L1").alias("official"))
    return health.smart_filter(items).withColumn("day", F.col("day").cast("string"))


def entity_alias_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = spark.createDataFrame(list(ALIASES), "entity int, alias string")
    found = joins.alias_matches(table(spark, sf_dir, "documents"), "doc_id", "text", aliases)
    return found.select(F.col("id").alias("doc_id"), "entity")


def entity_country_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event's country: the company's own nation, else the first nation of its region."""
    rows = news(spark, sf_dir).select("ord", "company", "region")
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    by_company = customers.select(F.col("c_name").alias("company_key"), F.lit(None).cast("string").alias("region_key"), F.col("n_name").alias("country"))
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    by_region = nations.select(F.lit(None).cast("string").alias("company_key"), F.col("r_name").alias("region_key"), F.col("n_name").alias("country"))
    return joins.first_match(rows, "ord", by_company.unionByName(by_region), [("company", "company_key"), ("region", "region_key")], "country")


def lineage_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name an event counts under: its supplier by id, by its source's number, or the source itself."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.when(F.col("doc_id") % 4 == 0, F.col("doc_id") % 150).alias("origin"), F.regexp_extract("source", "([0-9]+)$", 1).try_cast("long").alias("number"))
    first, second = suppliers.toDF("k1", "by_origin"), suppliers.toDF("k2", "by_number")
    named = rows.join(first, F.col("origin") == F.col("k1"), "left").join(second, F.col("number") * 7 == F.col("k2"), "left")
    resolved = F.coalesce("by_origin", "by_number", "source")
    basis = F.when(F.col("by_origin").isNotNull(), "origin").when(F.col("by_number").isNotNull(), "alias").otherwise("display")
    return named.groupBy(resolved.alias("name"), basis.alias("basis")).agg(F.count("*").alias("events"))


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a source: a user's events of a day; purchases are items, errors are failures."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.col("user_id").alias("source"), F.to_date("ts").alias("run")).agg(
        F.count_if(F.col("event_type") == "purchase").alias("items"), F.max((F.col("event_type") == "error").cast("int")).alias("failed"), F.count("*").alias("raw"), F.count_if(F.col("event_type") == "signup").alias("signals")
    )


def silent_source_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.run_alerts(_runs(spark, sf_dir))


def source_full_outer_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of the runs and of the documents side by side, with their lifecycle."""
    runs = _runs(spark, sf_dir).groupBy((F.col("source") % 30).alias("n")).agg(
        F.count("*").alias("runs"), F.count_if(F.col("items") > 0).alias("nonzero"), F.sum("raw").alias("raw"), F.sum("signals").alias("signals"), F.sum("failed").alias("failed")
    )
    stored = table(spark, sf_dir, "documents").groupBy(F.regexp_extract("source", "([0-9]+)$", 1).try_cast("long").alias("m")).agg(F.count("*").alias("stored"), F.count_if(F.col("doc_id") % 11 >= 7).alias("high"))
    both = runs.join(stored, F.col("n") + 5 == F.col("m"), "full_outer").select(F.coalesce(F.col("n") + 5, F.col("m")).alias("source"), "runs", "nonzero", "raw", "signals", "failed", "stored", "high")
    both = both.fillna(0)
    status = reports.lifecycle(*(F.col(c) for c in ("runs", "nonzero", "raw", "signals", "failed", "stored", "high")))
    return both.select("*", status.alias("lifecycle"))


def weekly_change_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"))
    return windows.change_windows(facts, "event_type", "day", "2024-01-22", "2024-01-28")


def weekly_change_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    return windows.change_windows(facts, "user_id", "day", "2024-01-15", "2024-01-28", priors=1, min_weeks=2)


def iso_week_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO weeks of the orders: open while as_of lies in them, closed after."""
    as_of = F.lit("1998-08-02").cast("date")
    rows = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), "o_totalprice").filter(F.col("day") <= as_of)
    week = rows.groupBy(F.to_date(F.date_trunc("week", "day")).alias("starts")).agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("largest"))
    ends = F.date_add("starts", 6)
    return week.select("starts", dates.iso_week(F.col("starts")).alias("week"), ends.alias("ends"), "orders", "largest", F.when(as_of > ends, "closed").otherwise("open").alias("status"))


def month_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar months: preview up to day 20 of the running month, then mature, closed after it."""
    as_of = F.lit("1998-07-21").cast("date")
    rows = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), "o_custkey").filter(F.col("day") <= as_of)
    month = rows.groupBy(F.to_date(F.date_trunc("month", "day")).alias("starts")).agg(F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("customers"), F.countDistinct("day").alias("days"))
    status = F.when(as_of > F.last_day("starts"), "closed").when(F.dayofmonth(as_of) <= 20, "preview").otherwise("mature")
    return month.select("starts", "orders", "customers", "days", status.alias("status"))


def rolling_7d_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contract(news(spark, sf_dir)).withColumn("topic", F.coalesce("company", F.col("source")))
    return reports.signal_clusters(rows, "2024-02-20", 7, "2024-02-20")


def daily_coverage_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from the first one up to 2024-03-05, days without events too."""
    rows = contract(news(spark, sf_dir)).select("day", "in_main", "company", "region")
    per_day = rows.groupBy("day").agg(F.count("*").alias("stored"), F.count_if("in_main").alias("main"), F.countDistinct("company").alias("entities"), F.countDistinct("region").alias("regions"))
    # The first day needs the day column only, not the gates.
    spine = dates.day_spine(news(spark, sf_dir).agg(F.min("day").alias("first"), F.lit("2024-03-05").cast("date").alias("last")), "first", "last")
    full = spine.join(per_day, "day", "left").fillna(0)
    return full.select("*", reports.coverage_status(F.col("main"), F.col("stored"), F.col("entities"), F.col("regions")).alias("coverage"))


def country_sector_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by country, by sector, by both and in total, in one pass."""
    customers, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    rows = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select(F.col("n_name").alias("country"), F.col("c_mktsegment").alias("sector"), "o_custkey")
    grouped = rows.groupingSets([["country"], ["sector"], ["country", "sector"], []], "country", "sector")
    return grouped.agg(F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("customers"))


def conversion_governance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pool to main conversion of each source and the action it asks for."""
    rows = contract(news(spark, sf_dir))
    signal = (F.col("scope_status") == "qualified") & (F.col("event_type") != "other")
    per = rows.groupBy("source").agg(
        F.count("*").alias("raw"), F.count_if(signal).alias("signal"), F.count_if(F.col("view_status") != "filtered").alias("stored"), F.count_if("in_main").alias("main"), F.count_if(F.col("drop_reason") == "weak_signal").alias("weak"), F.count_if(F.col("drop_reason") == "quality_review").alias("reviews")
    )
    per = per.withColumn("lost", F.col("signal") - F.col("stored"))
    google = F.col("source") == "src3"
    action = reports.governance_action(google, F.col("raw"), F.col("signal"), F.col("stored"), F.col("main"), F.col("lost"))
    return per.select("*", F.bround(F.col("stored") / F.col("raw"), 6).alias("stored_share"), action.alias("action"))


def governance_top8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversion_governance(spark, sf_dir)
    return windows.top_per_group(rows, ["action"], [F.col("lost").desc(), F.col("raw").desc(), F.col("source")], 8).select("action", "rank", "source", "lost")


def regional_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region: orders, large ones, customers, mean price and the commonest priority (of ties the first by name)."""
    customers = table(spark, sf_dir, "customer")
    geo = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    per = rows.groupBy("r_name", "o_orderpriority").agg(F.count("*").alias("n"), F.count_if(F.col("o_totalprice") >= 300000).alias("large"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    customers_of = rows.groupBy("r_name").agg(F.countDistinct("o_custkey").alias("customers"))
    top = F.min(F.struct((-F.col("n")).alias("n"), F.col("o_orderpriority").alias("p")))["p"]
    summed = per.groupBy("r_name").agg(F.sum("n").alias("orders"), F.sum("large").alias("large"), top.alias("top_priority"), F.sum("total").cast("double").alias("total_price"))
    return summed.join(customers_of, "r_name")


def customer_tiers(spark: SparkSession, sf_dir: str, limit: int = 200) -> DataFrame:
    """Top customers: A with three large orders, B with one, else C; the label sorts descending, as published."""
    per = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("customer")).agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("best"), F.count_if(F.col("o_totalprice") >= 400000).alias("large"))
    tier = F.when(F.col("large") >= 3, "A").when(F.col("large") >= 1, "B").otherwise("C")
    return per.withColumn("tier", tier).orderBy(F.col("tier").desc(), F.col("best").desc(), F.col("orders").desc(), "customer").limit(limit)


def theme_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directions of the parts' types, split and counted."""
    rows = table(spark, sf_dir, "part").select(F.explode(F.split("p_type", " ")).alias("theme"), "p_size")
    return rows.filter("theme <> ''").groupBy("theme").agg(F.count("*").alias("parts"), F.sum("p_size").alias("sizes"))


def top_opportunities(spark: SparkSession, sf_dir: str, limit: int = 40) -> DataFrame:
    """First event per company (or title), best priority first."""
    rows = contract(news(spark, sf_dir))
    rank = F.when(F.col("bd_priority") == "high", 0).when(F.col("bd_priority") == "mid", 1).otherwise(2)
    rows = rows.select("ord", F.coalesce("company", "title").alias("who"), rank.alias("p"), (-F.col("score")).alias("s"), F.datediff(F.lit("2030-01-01").cast("date"), "day").alias("age"), "bd_priority")
    return windows.first_seen(rows, ["who"], ["p", "s", "age", "ord"]).orderBy("p", "s", "age", "ord").limit(limit).select("ord", "who", "bd_priority")


def smart_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every day: signals all pass; others by priority, at most 12 a region less the signals kept there, at most 40 in all."""
    rows = news(spark, sf_dir).select("day", "ord", "region", "event_type", "score")
    signals = rows.filter("event_type not in ('other', 'model')")
    kept = signals.groupBy("day", "region").agg(F.least(F.count("*"), F.lit(8)).alias("reserved"))
    others = windows.running_quota(rows.filter("event_type in ('other', 'model')"), "region", [F.col("score").desc(), F.col("ord")], 12, 40, kept, within=["day"])
    return signals.withColumn("kept_as", F.lit("signal")).unionByName(others.drop("place").withColumn("kept_as", F.lit("quota"))).withColumn("day", F.col("day").cast("string"))


def featured_event_decay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's featured event: value by tier, losing 30 % a day; of ties the first."""
    rows = table(spark, sf_dir, "events").filter(F.to_date("ts") <= F.lit("2024-01-30").cast("date"))
    tier = F.when(F.col("user_id") % 10 == 0, "must").when(F.col("user_id") % 3 == 0, "strategic")
    weight = score.decayed(F.col("value"), tier, F.datediff(F.lit("2024-01-30").cast("date"), F.to_date("ts")))
    best = F.max_by("event_id", F.struct(weight.alias("w"), (-F.col("event_id")).alias("first")))
    return rows.groupBy("user_id").agg(best.alias("featured"), F.count("*").alias("events"))


def feed_priority_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed of every day: high-value rows, then main rows, first seen by url; no search feeds."""
    rows = contract(news(spark, sf_dir)).filter("not is_google").withColumn("day", F.col("day").cast("string"))
    # A row that is both stands with the high-value ones; one that is neither has no rank.
    ranked = rows.select("day", "url", "ord", F.when(F.col("bd_priority") == "high", 0).when(F.col("in_main"), 1).alias("rank"))
    return windows.first_seen(ranked, ["day", "url"], ["rank", "ord"], F.col("rank").isNotNull())


def mature_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest day with at least three main events, else the newest day."""
    per_day = contract(news(spark, sf_dir)).groupBy("day").agg(F.count_if("in_main").alias("main"))
    return per_day.agg(F.coalesce(F.max(F.when(F.col("main") >= 3, F.col("day"))), F.max("day")).alias("mature_date"), F.count_if(F.col("main") >= 3).alias("mature_days"))


def _half_years(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 20).alias("entity"), F.col("o_custkey").alias("job"), F.col("o_orderpriority").alias("tag"), F.to_date("o_orderdate").alias("day"))
    halves = [rows.filter(F.col("day").between(a, b)).drop("day").distinct() for a, b in (("1997-01-01", "1997-06-30"), ("1997-07-01", "1997-12-31"))]
    return halves[0], halves[1]


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous, current = _half_years(spark, sf_dir)
    diff = state.snapshot_diff(previous, current, ["entity", "job", "tag"])
    sizes = previous.groupBy("entity").agg(F.countDistinct("job").alias("previous")).join(current.groupBy("entity").agg(F.countDistinct("job").alias("current")), "entity", "full_outer").fillna(0)
    return state.diff_summary(diff, "entity", sizes, "tag")


def candidate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate pool of all weeks: a user is a candidate, qualified in a week of many purchases."""
    events = table(spark, sf_dir, "events")
    week = events.groupBy("user_id", F.to_date(F.date_trunc("week", "ts")).alias("week")).agg(F.count("*").alias("refs"), F.count_if(F.col("event_type") == "purchase").alias("bought"), F.count_if(F.col("event_type") == "error").alias("errors"))
    status = F.when(F.col("bought") >= 5, "qualified").when(F.col("errors") > F.col("bought"), "rejected").otherwise("accumulating")
    return state.merge_candidates(week.withColumn("status", status), "user_id", "week")


def observation_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities by nation from their points (customers): latest orders give each point's state."""
    as_of = F.lit("1998-06-30").cast("date")
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus").filter(F.col("day") <= as_of)
    seen = orders.groupBy("o_custkey").agg(F.count_if(F.col("day") > F.date_sub(as_of, 30)).alias("recent"), F.max("day").alias("last_success"), F.max_by("o_orderstatus", F.struct("day", "o_orderstatus")).alias("last_status"))
    points = table(spark, sf_dir, "customer").join(seen, F.col("c_custkey") == F.col("o_custkey"), "left")
    status = (
        F.when(F.col("c_acctbal") < -900, "pending")
        .when(F.col("last_success").isNull(), "unverified")
        .when(F.col("last_success") < F.date_sub(as_of, 900), "failed")
        .when(F.col("recent") >= 1, "active")
        .when(F.col("last_status") == "O", "changed_below_threshold")
        .otherwise("quiet")
    )
    points = points.select((F.col("c_custkey") % 400).alias("entity"), status.alias("status"), "last_success")
    latest = points.groupBy("entity").agg(F.max("last_success").alias("last_success"))
    return reports.observed_status(points.drop("last_success")).join(latest, "entity")


def funnel_stage_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage counts of runs as maps, merged by adding up."""
    per_run = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("run"), "event_type").agg(F.count("*").alias("n"))
    maps = per_run.groupBy("run").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("stages"))
    return maps.select(F.explode("stages").alias("stage", "n")).groupBy("stage").agg(F.sum("n").alias("total"), F.count("*").alias("runs"))


def run_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of odd days are upserted over all runs; the newest 30 stay."""
    runs = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("run")).agg(F.count("*").alias("raw"))
    new = runs.filter(F.dayofmonth("run") % 2 == 1).withColumn("raw", F.col("raw") + 1000)
    return state.retain_runs(runs, new, "run", "run")


def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1).alias("title"), F.size(F.regexp_extract_all(html, F.lit("<a "), F.lit(0))).alias("anchors"))


def fenced_json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bracketed part of every turn's text, with code fences gone, and its number of items; null without one.

    The texts hold no JSON, so even turns are put into a fenced answer first.
    """
    plain = F.regexp_replace("text", "```[a-z]*", "")
    answer = F.concat(F.lit("```json\n["), F.col("turn").cast("string"), F.lit(", "), F.length(plain).cast("string"), F.lit("]\n``` done"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 2 == 0, answer).otherwise(F.col("text")).alias("answer"))
    part = F.nullif(F.regexp_extract(F.regexp_replace("answer", "```[a-z]*", ""), "(?s)\\[.*\\]", 0), F.lit(""))
    items = F.size(F.from_json("json", "array<string>"))
    return turns.select("conv_id", "turn", part.alias("json")).select("*", F.when(items >= 0, items).alias("items"))


def json_props_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_type", F.explode(F.from_json("props", "map<string, bigint>")).alias("key", "n"))
    return rows.groupBy("event_type", "key").agg(F.count("*").alias("events"), F.sum("n").alias("total"), F.max("n").alias("largest"))


def lineitem_heavy_topk(spark: SparkSession, sf_dir: str, limit: int = 100) -> DataFrame:
    """Top suppliers of each return flag by revenue, three a flag and status."""
    revenue = (F.col("l_extendedprice").cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(5,2)"))).cast("decimal(28,4)")
    rows = table(spark, sf_dir, "lineitem").filter("l_shipdate < timestamp '1998-09-01'").select("l_returnflag", "l_linestatus", "l_suppkey", "l_orderkey", revenue.alias("revenue"))
    per = rows.groupBy("l_returnflag", "l_linestatus", "l_suppkey").agg(F.sum("revenue").cast("double").alias("revenue"), F.countDistinct("l_orderkey").alias("orders"))
    return windows.top_per_group(per, ["l_returnflag", "l_linestatus"], [F.col("revenue").desc(), F.col("l_suppkey")], 3).orderBy("l_returnflag", "l_linestatus", "rank").limit(limit)


def _plain(run):
    """The query with its dates as text, which every reader of results compares alike."""

    @wraps(run)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run(spark, sf_dir)
        return df.withColumns({c: F.col(c).cast("string") for c, kind in df.dtypes if kind == "date"})

    return query


_RUNS = """runs as (
  select user_id as source, cast(ts as date) as run, count(*) filter (event_type = 'purchase') as items, max(cast(event_type = 'error' as integer)) as failed,
    count(*) as raw, count(*) filter (event_type = 'signup') as signals from events group by 1, 2)"""


def _change_sql(key: str, start: str, end: str, priors: int, min_weeks: int) -> str:
    return f"""
with facts as (
  select {key} as k, cast(ts as date) as day, cast(floor(date_diff('day', cast(ts as date), date '{end}')::double / (date_diff('day', date '{start}', date '{end}') + 1)) as integer) as back from events),
counts as (select back, k, count(*) as atoms, count(distinct extract('week' from day)) as weeks from facts where back between 0 and {priors} group by all),
totals as (select back, sum(atoms) as total from counts group by back),
bases as (select max(total) filter (back = 0)::double as current_total, count(*) filter (back > 0) as windows, avg(total) filter (back > 0) as mean_total from totals),
per_key as (
  select k, cast(sum(atoms) filter (back = 0) as bigint) as atoms, max(weeks) filter (back = 0) as weeks, coalesce(sum(atoms) filter (back > 0), 0)::double as before from counts group by k),
rated as (
  select k, atoms, weeks, before / windows as base, coalesce(case when windows > 0 then case when current_total / mean_total < 0.8 or current_total / mean_total > 1.25
      then least(greatest(mean_total / current_total, 0.75::double), 1.30::double) else 1.0::double end end, 1.0::double) as correction, windows
  from per_key, bases where atoms >= 3 and weeks >= {min_weeks}),
adjusted as (select *, atoms * correction as adjusted from rated)
select k as {key}, atoms, weeks, base, correction, adjusted,
  case when windows = 0 then 'new' when adjusted >= base + 2 and case when base > 0 then adjusted / base else 2 end >= 1.25 then 'rising'
    when adjusted <= base - 2 and case when base > 0 then adjusted / base else 2 end <= 0.75 then 'falling' else 'steady' end as trend,
  4 * atoms + 3 * weeks + greatest(round_even(adjusted - coalesce(base, 0), 0), 0::double) as change_points from adjusted"""


_ALIAS_ROWS = ", ".join(f"({e}, '{a}')" for e, a in ALIASES)
_DIFF = """
rows as (select o_custkey % 20 as entity, o_custkey as job, o_orderpriority as tag, cast(o_orderdate as date) as day from orders),
prev as (select distinct entity, job, tag from rows where day between date '1997-01-01' and date '1997-06-30'),
cur as (select distinct entity, job, tag from rows where day between date '1997-07-01' and date '1997-12-31'),
diff as (select *, 'added' as change from (select * from cur except select * from prev) union all select *, 'removed' from (select * from prev except select * from cur)),
tags as (select entity, change, tag, count(*) as n from diff group by all),
counts as (select entity, cast(sum(case when change = 'added' then n else 0 end) as bigint) as added, cast(sum(case when change = 'removed' then n else 0 end) as bigint) as removed,
  max(case when change = 'added' then n else 0 end) as top_tag, max(n) as top_any from tags group by entity),
sizes as (select entity, count(distinct case when h = 0 then job end) as previous, count(distinct case when h = 1 then job end) as current
  from (select *, 0 as h from prev union all select *, 1 from cur) group by entity)"""

SQL = {
    "near_duplicate_titles": f"""
with {NEWS_SQL}, sets as (select ord, day, list_sort(list_distinct(list_filter(regexp_extract_all(lower(title), '[a-z0-9]+'), lambda t: length(t) >= 3))) as items from news),
classes as (select items, day, min(ord) as head, count(*) as members from sets where len(items) > 0 group by all),
pairs as (
  select a.head as a, b.head as b, len(list_intersect(a.items, b.items)) as common, len(a.items) as na, len(b.items) as nb, a.members as members_a, b.members as members_b
  from classes a join classes b on a.head < b.head and abs(date_diff('day', a.day, b.day)) <= 3)
select a, b, common::double / (na + nb - common) as similarity, members_a, members_b from pairs where common::double / (na + nb - common) >= 0.72::double""",
    "entity_alias_match": f"""
with aliases(entity, alias) as (values {_ALIAS_ROWS}),
plain as (select doc_id, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ' as body from documents)
select distinct doc_id, entity from plain join aliases on contains(body, ' ' || alias || ' ')""",
    "entity_country_bridge": f"""
with {NEWS_SQL}, own as (select c_name, min(n_name) as country from customer join nation on c_nationkey = n_nationkey group by c_name),
near as (select r_name, min(n_name) as country from nation join region on n_regionkey = r_regionkey group by r_name)
select ord, company, region, coalesce(own.country, near.country) as country from news left join own on company = c_name left join near on region = r_name""",
    "lineage_resolution": """
with rows as (select doc_id, source, case when doc_id % 4 = 0 then doc_id % 150 end as origin, try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint) as number from documents)
select coalesce(a.s_name, b.s_name, source) as name, case when a.s_name is not null then 'origin' when b.s_name is not null then 'alias' else 'display' end as basis, count(*) as events
from rows left join supplier a on a.s_suppkey = origin left join supplier b on b.s_suppkey = number * 7 group by 1, 2""",
    "silent_source_alerts": f"""
with {_RUNS}, ranked as (select *, row_number() over (partition by source order by run desc) as back from runs),
stats as (select source, max(items) as best, max(items) filter (back <= 5) as recent_best, cast(sum(failed) filter (back <= 5) as bigint) as recent_failed, cast(sum(items) as bigint) as stored,
  max(run) filter (items > 0) as last_alive from ranked group by source)
select source, case when recent_failed >= 2 then 'fetch_failure' else 'supply_drop' end as kind, last_alive, stored, recent_failed from stats where best > 0 and recent_best = 0 and (recent_failed >= 2 or stored >= 5)""",
    "source_full_outer_health": f"""
with {_RUNS}, a as (select source % 30 as n, count(*) as runs, count(*) filter (items > 0) as nonzero, cast(sum(raw) as bigint) as raw, cast(sum(signals) as bigint) as signals, cast(sum(failed) as bigint) as failed from runs group by 1),
b as (select try_cast(regexp_extract(source, '([0-9]+)$', 1) as bigint) as m, count(*) as stored, count(*) filter (doc_id % 11 >= 7) as high from documents group by 1),
j as (select coalesce(n + 5, m) as source, coalesce(runs, 0) as runs, coalesce(nonzero, 0) as nonzero, coalesce(raw, 0) as raw, coalesce(signals, 0) as signals, coalesce(failed, 0) as failed,
  coalesce(stored, 0) as stored, coalesce(high, 0) as high from a full join b on n + 5 = m)
select *, case when raw = 0 and stored = 0 and failed > 0 then 'failed' when raw = 0 and stored = 0 then 'zero-hit'
  when (runs > 0 and nonzero >= greatest(2, runs // 2) and signals > 0) or high >= 5 or stored >= 20 then 'stable' else 'partial' end as lifecycle from j""",
    "weekly_change_by_type": _change_sql("event_type", "2024-01-22", "2024-01-28", 3, 1),
    "weekly_change_by_user": _change_sql("user_id", "2024-01-15", "2024-01-28", 1, 2),
    "iso_week_archive": """
with weeks as (select cast(date_trunc('week', cast(o_orderdate as date)) as date) as starts, count(*) as orders, max(o_totalprice) as largest from orders where cast(o_orderdate as date) <= date '1998-08-02' group by 1)
select starts, cast(extract('isoyear' from starts) as varchar) || '-W' || lpad(cast(extract('week' from starts) as varchar), 2, '0') as week, starts + 6 as ends, orders, largest,
  case when date '1998-08-02' > starts + 6 then 'closed' else 'open' end as status from weeks""",
    "month_archive": """
with rows as (select cast(o_orderdate as date) as day, o_custkey from orders where cast(o_orderdate as date) <= date '1998-07-21')
select cast(date_trunc('month', day) as date) as starts, count(*) as orders, count(distinct o_custkey) as customers, count(distinct day) as days,
  case when date '1998-07-21' > last_day(cast(date_trunc('month', day) as date)) then 'closed' when 21 <= 20 then 'preview' else 'mature' end as status from rows group by 1""",
    "rolling_7d_clusters": f"""
with {_CONTRACT}, recent as (select *, coalesce(company, source) as topic from final where day > date '2024-02-20' - 7 and day <= date '2024-02-20' and event_type <> 'other' and not needs_review and relevance >= 2),
g as (select region, event_type, topic, count(*) as events, count(distinct company) as companies, count(distinct source) as sources, count(distinct day) as days, bool_or(bd_priority = 'high') as any_high,
  count(*) filter (not is_google) as direct, bool_or(tier = 'L1') as official, max(score) as best_score, bool_or(day = date '2024-02-20') as has_focus, list_sum(list_reverse_sort(list(score))[1:3]) as top_scores from recent group by all),
f as (select *, (companies >= 2)::int + (sources >= 2)::int + (days >= 2)::int + any_high::int + (direct >= 2)::int + official::int + (best_score >= 7)::int as flags from g)
select region, event_type, topic, events, companies, sources, flags, has_focus, cast(10 * flags + 2 * events + top_scores + case when has_focus then 8 else 0 end as bigint) as cluster_score,
  case when flags >= 4 and (any_high or direct >= 2) then 'high' when flags >= 3 then 'mid' else 'watch' end as confidence from f where events >= 2 and flags >= 2 and direct > 0""",
    "daily_coverage_spine": f"""
with {_CONTRACT}, rows as (select day, in_main, company, region from final),
spine as (select cast(unnest(generate_series((select min(day) from rows)::timestamp, timestamp '2024-03-05', interval 1 day)) as date) as day),
per as (select day, count(*) as stored, count(*) filter (in_main) as main, count(distinct company) as entities, count(distinct region) as regions from rows group by day),
j as (select spine.day, coalesce(stored, 0) as stored, coalesce(main, 0) as main, coalesce(entities, 0) as entities, coalesce(regions, 0) as regions from spine left join per using (day))
select *, case when main >= 8 and entities >= 5 and regions >= 3 then 'healthy' when stored >= 8 and entities >= 3 and regions >= 2 then 'thin_but_usable' when stored >= 3 then 'thin' else 'sparse' end as coverage from j""",
    "country_sector_grouping_sets": """
select n_name as country, c_mktsegment as sector, count(*) as orders, count(distinct o_custkey) as customers from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
group by grouping sets ((n_name), (c_mktsegment), (n_name, c_mktsegment), ())""",
    "conversion_governance": "",
    "governance_top8": "",
    "regional_map": """
with rows as (select r_name, o_orderpriority as p, o_totalprice, o_custkey from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
per as (select r_name, p, count(*) as n from rows group by all), top as (select r_name, p, row_number() over (partition by r_name order by n desc, p) as k from per)
select r.r_name, count(*) as orders, count(*) filter (o_totalprice >= 300000) as large, any_value(top.p) as top_priority, cast(sum(cast(o_totalprice as decimal(18,2))) as double) as total_price, count(distinct o_custkey) as customers
from rows r join top on r.r_name = top.r_name and k = 1 group by r.r_name""",
    "customer_tiers": """
with per as (select o_custkey as customer, count(*) as orders, max(o_totalprice) as best, count(*) filter (o_totalprice >= 400000) as large from orders group by 1)
select *, case when large >= 3 then 'A' when large >= 1 then 'B' else 'C' end as tier from per order by tier desc, best desc, orders desc, customer limit 200""",
    "theme_counts": "select theme, count(*) as parts, cast(sum(p_size) as bigint) as sizes from (select unnest(string_split(p_type, ' ')) as theme, p_size from part) where theme <> '' group by theme",
    "top_opportunities": f"""
with {_CONTRACT}, r as (select ord, coalesce(company, title) as who, case bd_priority when 'high' then 0 when 'mid' then 1 else 2 end as p, -score as s, date_diff('day', day, date '2030-01-01') as age, bd_priority from final),
f as (select *, row_number() over (partition by who order by p, s, age, ord) as k from r)
select ord, who, bd_priority from f where k = 1 order by p, s, age, ord limit 40""",
    "smart_quota": f"""
with {NEWS_SQL}, rows as (select day, ord, region, event_type, score from news),
signals as (select * from rows where event_type not in ('other', 'model')), kept as (select day, region, least(count(*), 8) as reserved from signals group by day, region),
others as (select *, row_number() over (partition by day, region order by score desc, ord) as place from rows where event_type in ('other', 'model')),
passed as (select o.*, row_number() over (partition by o.day order by score desc, ord) as nth from others o left join kept k on o.region = k.region and o.day = k.day where place <= 12 - coalesce(reserved, 0))
select cast(day as varchar) as day, ord, region, event_type, score, 'signal' as kept_as from signals union all select cast(day as varchar), ord, region, event_type, score, 'quota' from passed where nth <= 40""",
    "featured_event_decay": """
with w as (select user_id, event_id, value / 100.0::double * case when user_id % 10 = 0 then 1.3::double when user_id % 3 = 0 then 1.2::double else 1.0::double end
  * pow(0.7::double, greatest(date_diff('day', cast(ts as date), date '2024-01-30'), 0)) as w from events where cast(ts as date) <= date '2024-01-30'),
r as (select *, row_number() over (partition by user_id order by w desc nulls last, event_id) as k from w)
select user_id, any_value(event_id) filter (k = 1) as featured, count(*) as events from r group by user_id""",
    "feed_priority_union": f"""
with {_CONTRACT}, rows as (select * from final where not is_google),
u as (select day, url, ord, 0 as rank from rows where bd_priority = 'high' union all select day, url, ord, 1 from rows where in_main), f as (select *, row_number() over (partition by day, url order by rank, ord) as k from u)
select cast(day as varchar) as day, url, ord, rank from f where k = 1""",
    "mature_date": f"""
with {_CONTRACT}, per as (select day, count(*) filter (in_main) as main from final group by day)
select coalesce(max(day) filter (main >= 3), max(day)) as mature_date, count(*) filter (main >= 3) as mature_days from per""",
    "snapshot_diff": f"""
with {_DIFF}, j as (select entity, previous, current, coalesce(added, 0) as added, coalesce(removed, 0) as removed, coalesce(top_tag, 0) as top_tag, coalesce(top_any, 0) as top_any from sizes left join counts using (entity))
select entity, previous, current, added, removed, top_tag, case when not (added >= 3 or removed >= 3 or top_any >= 2) then 'none'
  when previous >= 10 and current >= 10 and (current < 0.4::double * previous or least(added, removed)::double / greatest(previous, current) >= 1) then 'rejected'
  when removed > added then 'accumulating' when added >= 3 and top_tag >= 2 then 'qualified' else 'accumulating' end as status from j""",
    "candidate_merge": """
with week as (select user_id, cast(date_trunc('week', ts) as date) as week, count(*) as refs, count(*) filter (event_type = 'purchase') as bought, count(*) filter (event_type = 'error') as errors from events group by 1, 2),
rated as (select *, case when bought >= 5 then 'qualified' when errors > bought then 'rejected' else 'accumulating' end as status from week),
marked as (select *, min(week) filter (status = 'qualified') over (partition by user_id) as promoted_at from rated)
select user_id, min(week) as first_seen, max(week) as last_seen, cast(sum(refs) as bigint) as refs, case when max(promoted_at) is not null then 'promoted' else arg_max(status, week) end as status
from marked where promoted_at is null or week <= promoted_at group by user_id order by last_seen desc, user_id limit 500""",
    "observation_ledger": """
with o as (select o_custkey, cast(o_orderdate as date) as day, o_orderstatus from orders where cast(o_orderdate as date) <= date '1998-06-30'),
seen as (select o_custkey, count(*) filter (day > date '1998-06-30' - 30) as recent, max(day) as last_success, arg_max(o_orderstatus, (day, o_orderstatus)) as last_status from o group by 1),
p as (select c_custkey % 400 as entity, last_success, case when c_acctbal < -900 then 'pending' when last_success is null then 'unverified' when last_success < date '1998-06-30' - 900 then 'failed'
  when recent >= 1 then 'active' when last_status = 'O' then 'changed_below_threshold' else 'quiet' end as status from customer left join seen on c_custkey = o_custkey),
g as (select entity, count(*) as points, count(*) filter (status = 'active') as active_points, max(last_success) as last_success, count(*) filter (status = 'pending') as np, count(*) filter (status = 'failed') as nf,
  count(*) filter (status = 'unverified') as nu, count(*) filter (status = 'changed_below_threshold') as nc from p group by entity)
select entity, points, active_points, last_success, case when np = points then 'pending' when nf = points - np then 'failed' when nf + nu + np > 0 then 'partial' when active_points > 0 then 'active' when nc > 0 then 'changed' else 'quiet' end as entity_status from g""",
    "funnel_stage_merge": "select event_type as stage, count(*) as total, count(distinct cast(ts as date)) as runs from events group by 1",
    "run_retention": """
with runs as (select cast(ts as date) as run, count(*) as raw from events group by 1)
select run, raw + case when extract('day' from run) % 2 = 1 then 1000 else 0 end as raw from runs order by run desc limit 30""",
    "page_titles": "select page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as title, cast(len(regexp_extract_all(html, '<a ')) as integer) as anchors from pages",
    "quick_health": f"""
with {_CONTRACT}, keyed as (select regexp_replace(lower(title), '[^a-z0-9]+', '', 'g') as k, count(*) as n from final group by 1),
r as (select coalesce(sum(n - 1), 0)::double as repeats, coalesce(sum(n), 0)::double as keyed from keyed where length(k) >= 11), l as (select max(n) as largest from (select source, count(*) as n from final group by source))
select count(*) as events, count(distinct day) as days, count(*) filter (day > date '2024-02-20') as future, count(*) filter (in_main) as main, count(*) filter (needs_review)::double / count(*) as review_ratio,
  any_value(repeats / nullif(keyed, 0)) as duplicate_ratio, any_value(largest)::double / count(*) as source_share from final, r, l""",
    "health_gate": "",
    "collection_timing": """
with runs as (select cast(ts as date) as run, count(*) as raw, count(distinct user_id) as sources from events group by 1)
select *, cast(date_diff('day', lag(run) over (order by run), run) as integer) as days_since from runs order by run desc limit 8""",
    "over_rate": """
select user_id, strftime(date_trunc('hour', ts), '%Y-%m-%d %H') as starts, count(*) as requests from events group by 1, 2 having count(*) > 2""",
    "smart_filter": f"""
with {NEWS_SQL}, items as (select day, ord, event_type, region, company, score as priority, tier = 'L1' as official from news),
o as (select *, row_number() over (partition by day, company order by priority desc, ord) as nth from items where official and event_type = 'other' and company is not null),
s as (select *, row_number() over (partition by day, company, official order by ord) as nth from items where event_type <> 'other'),
kept as (select day, ord, event_type, region, company, priority, official, 'official' as kept_as from o where nth = 1 union all
  select day, ord, event_type, region, company, priority, official, 'signal' from s where not official or company is null or nth <= 3),
used as (select day, region, count(*) as used from kept group by day, region), total as (select day, count(*) as total from kept group by day),
rest as (select i.*, row_number() over (partition by i.day, i.region order by priority desc, ord) as place, coalesce(used, 0) as used from items i left join used u on i.region = u.region and i.day = u.day
  where event_type = 'other' and ord not in (select ord from kept where kept_as = 'official')),
best as (select *, row_number() over (partition by day order by priority desc, ord) as nth from rest where place <= 12 - used)
select * replace (cast(day as varchar) as day) from kept union all select cast(b.day as varchar), ord, event_type, region, company, priority, official, 'quota' from best b left join total t on b.day = t.day where nth <= 40 - coalesce(total, 0)""",
    "company_cards": f"""
with {NEWS_SQL}, r as (select *, date_diff('day', day, date '2024-02-20') as age from news where company is not null and date_diff('day', day, date '2024-02-20') >= 0),
g as (select company, count(*) filter (age < 7) as week, count(*) filter (age < 30) as month, max(day) as last_day, arg_max(ord, (-age, score, -ord)) as latest from r group by company)
select *, case when week >= 3 then 'busy' when week > 0 then 'active' when month > 0 then 'watched' else 'quiet' end as card_status from g""",
    "weight_calibration": f"""
with {_CONTRACT}, w(config, a, b, c) as (values ('even', 1.0::double, 1.0::double, 1.0::double), ('change', 2.0::double, 0.5::double, 1.0::double), ('trust', 1.0::double, 2.0::double, 0.25::double)),
t as (select config, ord, a * change_score + b * confidence + c * attention as total from final, w),
k as (select *, row_number() over (partition by config order by total desc, ord) as nth from t),
s as (select config, count(*) as shared from k where nth <= 15 and ord in (select ord from k where config = 'even' and nth <= 15) group by config)
select config, round(avg(total), 6) as mean, median(total) as median, count(*) as rows, coalesce(any_value(shared), 0) as shared from t left join s using (config) group by config""",
    "fenced_json_repair": """
with plain as (select conv_id, turn, regexp_replace(text, '```[a-z]*', '', 'g') as text from conversations),
parts as (select conv_id, turn, case when turn % 2 = 0 then '[' || turn || ', ' || length(text) || ']' else nullif(regexp_extract(text, '(?s)\\[.*\\]', 0), '') end as json from plain)
select conv_id, turn, json, case when json_valid(json) then cast(json_array_length(json) as integer) end as items from parts""",
    "json_props_flatten": """
with e as (select event_type, unnest(map_entries(cast(cast(props as json) as map(varchar, bigint)))) as kv from events)
select event_type, kv.key as key, count(*) as events, cast(sum(kv.value) as bigint) as total, max(kv.value) as largest from e group by 1, 2""",
    "lineitem_heavy_topk": """
with per as (select l_returnflag, l_linestatus, l_suppkey, cast(sum(cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(5,2))) as decimal(28,4))) as double) as revenue, count(distinct l_orderkey) as orders
  from lineitem where l_shipdate < timestamp '1998-09-01' group by 1, 2, 3),
r as (select *, cast(row_number() over (partition by l_returnflag, l_linestatus order by revenue desc, l_suppkey) as integer) as rank from per)
select * from r where rank <= 3""",
}
SQL["health_gate"] = f"""
with f as ({SQL["quick_health"]}), c as (
  select 'future' as fact, future::double as value, 'most' as bound, 0.0::double as limit_ from f union all select 'main', main, 'least', 1 from f union all
  select 'review_ratio', review_ratio, 'most', 0.02 from f union all select 'duplicate_ratio', duplicate_ratio, 'most', 0.9 from f union all select 'source_share', source_share, 'most', 0.04 from f)
select fact, value, bound, limit_ as "limit" from c where case bound when 'most' then value > limit_ else value < limit_ end"""
_GOVERNANCE = f"""
{_CONTRACT}, per as (select source, count(*) as raw, count(*) filter (scope_status = 'qualified' and event_type <> 'other') as signal, count(*) filter (view_status <> 'filtered') as stored,
  count(*) filter (in_main) as main, count(*) filter (drop_reason = 'weak_signal') as weak, count(*) filter (drop_reason = 'quality_review') as reviews from final group by source),
acted as (select *, signal - stored as lost, round_even(stored::double / raw, 6) as stored_share, case when source = 'src3' then 'keep_as_gap_fill' when signal >= 50 and main = 0 then 'audit_raw_signal_quality'
  when signal >= 20 and stored = 0 then 'instrument_candidate_loss' when stored >= 20 and main::double / stored >= 0.4 then 'promote_weight'
  when main >= 10 or (main >= 5 and main::double / nullif(stored, 0) >= 0.35) then 'keep_core' when stored >= 5 and main = 0 then 'downgrade_or_reclassify' when raw = 0 and stored = 0 then 'pause'
  when signal - stored >= 20 and coalesce(stored::double / nullif(signal, 0), 0) < 0.15 then 'audit_conversion_loss' else 'observe' end as action from per)"""
SQL["conversion_governance"] = f"with {_GOVERNANCE} select * from acted"
SQL["governance_top8"] = f"""
with {_GOVERNANCE}, r as (select action, cast(row_number() over (partition by action order by lost desc, raw desc, source) as integer) as rank, source, lost from acted) select * from r where rank <= 8"""
for _name, _days in (
    ("silent_source_alerts", ("last_alive",)),
    ("iso_week_archive", ("starts", "ends")),
    ("month_archive", ("starts",)),
    ("daily_coverage_spine", ("day",)),
    ("mature_date", ("mature_date",)),
    ("candidate_merge", ("first_seen", "last_seen")),
    ("observation_ledger", ("last_success",)),
    ("run_retention", ("run",)),
    ("company_cards", ("last_day",)),
    ("collection_timing", ("run",)),
):
    SQL[_name] = f"select * replace ({', '.join(f'cast({d} as varchar) as {d}' for d in _days)}) from ({SQL[_name]})"
QUERIES = {name: _plain(globals()[name]) for name in [*SQL, "weekly_narratives"]}
