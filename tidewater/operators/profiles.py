"""Profiles of events: content, subject, claim and action types, countries, topics, day groups and briefs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.lexicon import Lexicon
from tidewater.functions.text import first_text

# Fixed values.
CONTENT_TYPES = ("industry_report", "company_action", "model_release", "regional_policy", "capital_event", "generic_industry_change")
ACTION_TYPES = ("product_release", "policy_change", "funding", "earnings", "expansion", "hiring", "other")
PROFILE = Lexicon(
    (
        ("report", ("report", "research", "forecast", "market outlook", "market map", "benchmark", "market share", "market size", "行业报告", "研报", "市场预测", "市场份额", "市场规模", "基准测试")),
        ("model", ("foundation model", "language model", "large language model", "multimodal model", "ai model", "model release", "model launches", "open-source model", "open source model", "模型发布", "大模型", "多模态模型", "开源模型")),
        ("model_action", ("launch", "launches", "released", "release", "unveils", "available", "推出", "发布", "上线", "开放")),
        ("performance", ("benchmark", "领先", "best")),
        ("policy", ("regulation", "regulatory", "regulator", "legislation", "antitrust", "central bank", "rules", "fined", "fines", "bars", "bans", "ban", "banned", "orders", "tax", "taxes", "taxable", "tariff", "tariffs", "sanction", "sanctions", "tribunal", "ruling", "监管", "法规", "法案", "反垄断", "央行", "牌照", "关税", "制裁")),
        ("release", ("launch", "launches", "launched", "released", "releases", "release", "unveils", "unveil", "debuts", "available in", "rolls out", "推出", "发布", "上线", "开放")),
        ("expansion", ("expands", "expansion", "enters", "partnership", "partners", "new market", "regional", "扩张", "进入", "合作", "生态")),
        ("hiring", ("hiring", "hires", "appoints", "layoff", "layoffs", "restructures", "招聘", "任命", "裁员", "重组")),
    )
)
SOURCE_LABELS = (("L1", "官方动作"), ("L2", "行业交易"), ("L3", "区域生态"), ("L4", "垂类信号"))
REGION_ENDING = "\\s*[—-]\\s*(欧洲|亚太|中东|非洲|拉美|全球|中资).*$"
GROUP_LABELS = (("selected", "精选"), ("important", "重点"), ("watch", "观察"))
TYPE_LABELS = (("funding", "融资"), ("ma", "并购"), ("earnings", "财报"), ("strategy", "战略"))


def profiled(events: DataFrame, text: Column) -> DataFrame:
    """``events`` with content_type, subject_type, claim_type and action_type.

    Reads event_type, company, source_type, source_signals, scope_layer and the
    declared_content, declared_subject, declared_claim and declared_action that a
    source may give; null columns count as not given.  ``text`` is matched once.
    """
    rows = events.withColumn("_terms", PROFILE.found(F.lower(text)))
    hit = lambda name: PROFILE.in_found(F.col("_terms"), name)
    kind, named = F.coalesce("event_type", F.lit("other")), F.col("company").isNotNull()
    content = (
        F.when(F.col("declared_content").isin(*CONTENT_TYPES), F.col("declared_content"))
        .when(F.lower("source_type").isin("research_report", "research", "report"), "industry_report")
        .when(F.array_contains("source_signals", "industry_analysis") & hit("report"), "industry_report")
        .when(hit("model") & hit("model_action"), "model_release")
        .when(F.col("scope_layer") == "regional_policy", "regional_policy")
        .when(kind.isin("funding", "ma", "earnings"), "capital_event")
        .when(named, "company_action")
        .otherwise("generic_industry_change")
    )
    rows = rows.withColumn("content_type", content)
    content = F.col("content_type")
    subject = F.when(content == "industry_report", "report").when(content == "model_release", "ai_model").when(content == "regional_policy", "region_policy").when(named, "company").otherwise("industry")
    claim = (
        F.when(content == "industry_report", "institutional_assessment")
        .when((content == "model_release") & hit("performance"), "performance_claim")
        .when(content == "model_release", "release_fact")
        .when(content == "regional_policy", "policy_change")
        .when(content == "company_action", "company_action")
        .otherwise("industry_change")
    )
    action = (
        F.when(F.col("declared_action").isin(*ACTION_TYPES), F.col("declared_action"))
        .when((content == "regional_policy") | hit("policy"), "policy_change")
        .when(kind == "earnings", "earnings")
        .when(kind.isin("funding", "ma") | (content == "capital_event"), "funding")
        .when((content == "model_release") | hit("release"), "product_release")
        .when(hit("hiring"), "hiring")
        .when(kind.isin("strategy", "partnership") | hit("expansion"), "expansion")
        .otherwise("other")
    )
    return rows.withColumns({"subject_type": F.coalesce(first_text(F.col("declared_subject")), subject), "claim_type": F.coalesce(first_text(F.col("declared_claim")), claim), "action_type": action}).drop("_terms")


def tagged_countries(events: DataFrame, markets: DataFrame, countries: Lexicon) -> DataFrame:
    """``events`` with countries (sorted), primary_country and tag_method.

    ``markets`` has company, country and is_home: a company's markets decide
    first (its home, of several the least, is the primary one), then the
    countries whose terms a title holds; the least in order is primary.  Without
    either the list is empty, the country null and the method ''.  The join is by
    company; its countries are one array, as long as the list of countries at most.
    """
    home = F.min(F.when(F.col("is_home"), F.col("country"))).alias("_home")
    known = markets.filter("company is not null and country is not null").groupBy("company").agg(F.array_sort(F.collect_set("country")).alias("_markets"), home)
    rows = events.withColumn("_terms", countries.found(F.lower("title"))).join(known, "company", "left")
    titled = F.array_sort(countries.found_labels(F.col("_terms")))
    rows = rows.withColumn("countries", F.coalesce("_markets", titled))
    method = F.when(F.col("_markets").isNotNull(), "company_market").when(F.size("countries") > 0, "title_keyword").otherwise("")
    return rows.withColumns({"primary_country": F.coalesce("_home", F.try_element_at("countries", F.lit(1))), "tag_method": method}).drop("_terms", "_markets", "_home")


def source_family(tier: Column, role: Column, source: Column) -> Column:
    """The tier, else the role, else the source; '' if all are blank."""
    return F.coalesce(first_text(tier, role, source), F.lit(""))


def event_topic(topic: Column, label: Column, title: Column) -> Column:
    """The topic, else the label, else the first four words of the title."""
    words = F.array_join(F.slice(F.split(F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), "\\s+", " ")), " "), 1, 4), " ")
    return F.coalesce(first_text(topic, label), words)


def cluster_topic(topic: Column, company: Column, direction: Column, title: Column, watching: str = "持续观察") -> Column:
    """The topic without its region, else the company, else the direction before '/', else four words of the title."""
    plain = F.nullif(F.trim(F.regexp_replace(topic, REGION_ENDING, "")), F.lit(""))
    heading = F.nullif(F.nullif(F.trim(F.substring_index(direction, "/", 1)), F.lit("")), F.lit(watching))
    words = F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), "[^A-Za-z0-9_\\u4e00-\\u9fff]+", " "))
    subject = F.coalesce(F.nullif(F.array_join(F.slice(F.split(words, " "), 1, 4), " "), F.lit("")), F.lit("区域信号"))
    return F.coalesce(plain, first_text(company), heading, subject)


def source_label(tier: Column, is_google: Column) -> Column:
    """The kind of signal that a source's tier stands for."""
    return F.coalesce(*(F.when(tier.startswith(t), F.lit(label)) for t, label in SOURCE_LABELS), F.when(is_google, F.lit("补漏来源")), F.lit("公开信号"))


def day_groups(events: DataFrame) -> DataFrame:
    """Per day the number of events by reading priority and the sentence that announces them.

    ``view_priority`` (selected, important, watch) stands if given, else ``bd_priority``
    (高, 中, other) decides.  Days without events have no row.
    """
    frozen = F.when(F.col("view_priority").isin("selected", "important", "watch"), F.col("view_priority"))
    key = F.coalesce(frozen, F.when(F.col("bd_priority") == "高", "selected").when(F.col("bd_priority") == "中", "important"), F.lit("watch"))
    counts = events.withColumn("_key", key).groupBy("day").agg(*(F.count_if(F.col("_key") == name).alias(name) for name, _ in GROUP_LABELS))
    parts = F.array_compact(F.array(*(F.when(F.col(name) > 0, F.format_string(f"{label} %d 条", F.col(name))) for name, label in GROUP_LABELS)))
    total = sum((F.col(name) for name, _ in GROUP_LABELS), F.lit(0))
    return counts.withColumn("navigation", F.concat(F.format_string("今日事件导航：%d 条合格事件。", total), F.array_join(parts, "，")))


def first_seen(rows: DataFrame, group: str, value: str, order: str, most: int) -> DataFrame:
    """(group, value list): the first ``most`` different values of each group in order.

    Values are made distinct before the ranking, which keeps ``most`` of a group
    before its shuffle.
    """
    firsts = rows.filter(F.col(value).isNotNull() & (F.col(value) != "")).groupBy(group, value).agg(F.min(order).alias("_at"))
    ranked = firsts.withColumn("_nth", F.row_number().over(Window.partitionBy(group).orderBy("_at", value))).filter(F.col("_nth") <= most)
    listed = ranked.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_nth", value))).alias("_list"))
    return listed.select(group, F.transform("_list", lambda x: x[value]).alias(value))


def day_briefs(events: DataFrame) -> DataFrame:
    """Per day: title and judgement from the first three labels, regions and types in input order ``ord``."""
    counts = events.groupBy("day").agg(F.count("*").alias("events"))
    for value in ("label", "region", "event_type"):
        counts = counts.join(first_seen(events, "day", value, "ord", 3), "day", "left")
    names, n = F.array_join("label", "、"), F.coalesce(F.size("label"), F.lit(0))
    title = F.when(n >= 3, F.concat(F.lit("今日优先看"), names, F.lit("等对象"))).when(n == 2, F.concat(F.lit("今日优先看"), names)).when(n == 1, F.concat(F.lit("今日优先看"), names, F.lit("的新动作"))).otherwise("今日观察主线")
    labels = F.create_map(*(F.lit(x) for pair in TYPE_LABELS for x in pair))
    types = F.array_join(F.transform("event_type", lambda t: F.coalesce(F.try_element_at(labels, t), t)), "、")
    parts = F.concat_ws("，", F.format_string("今日新增%d条可读事件", F.col("events")), F.when(F.size("region") > 0, F.concat(F.lit("覆盖"), F.array_join("region", "、"))), F.when(F.size("event_type") > 0, F.concat(F.lit("重点类型为"), types)))
    return counts.select("day", "events", title.alias("title"), F.concat(parts, F.lit("；日报先看对象和证据，周报再收敛窗口和方向。")).alias("judgement"))


def unique_evidence(evidence: DataFrame, most: int = 8) -> DataFrame:
    """The first ``most`` different pieces of evidence of each narrative: narrative, nth, url, title.

    ``evidence`` has narrative, place, url, day and title.  A piece is its url, or
    its day and title without one; pieces with none of them are left out.
    """
    key = F.coalesce(first_text(F.col("url")), F.nullif(F.concat_ws("|", F.coalesce(F.col("day").cast("string"), F.lit("")), F.coalesce("title", F.lit(""))), F.lit("|")))
    firsts = evidence.withColumn("_key", key).filter("_key is not null").groupBy("narrative", "_key").agg(F.min(F.struct("place", "url", "title")).alias("_first"))
    order = Window.partitionBy("narrative").orderBy("_first", "_key")
    return firsts.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= most).select("narrative", "nth", "_first.url", "_first.title")


def narrative_confidence(clusters: Column, high: Column, coverage: Column, promotable: Column) -> Column:
    """高, 中 or 观察 from the number of clusters, of sure ones, the covered share of the evidence and its independence."""
    return F.when((clusters > 0) & ~promotable, "观察").when((clusters >= 2) & (high >= 1) & (coverage >= 0.75), "高").when((clusters > 0) & (coverage >= 0.5), "中").otherwise("观察")
