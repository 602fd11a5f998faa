"""Subjects, dates and profiles of headlines, on examples with known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import subjects
from tidewater.functions.lexicon import Lexicon
from tidewater.operators import profiles

FIELDS = "event_type string, company string, source_type string, source_signals array<string>, scope_layer string, declared_content string, declared_subject string, declared_claim string, declared_action string, title string"


def values(spark, function, *rows):
    """The function over one string column, row by row."""
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r[1] for r in frame.select("i", function(F.col("t"))).orderBy("i").collect()]


def test_subjects(spark):
    titles = ["Stripe raises $1B", "Update: Blue Grid Inc acquires a rival - The Wire", "Why Nova Pay is valued at $2B", "Quill & Sons announces results", "nothing happens", "", None, "AI raises funds", "X wins"]
    assert values(spark, subjects.title_subject, *titles) == ["stripe", "blue grid", "pay", "quill and sons", "", "", "", "", ""]
    names = ["Sea Limited", "Square Enix Holdings", "Holdings Ltd", "A B C D E Inc", "", None]
    assert values(spark, subjects.company_key, *names) == ["sea", "square enix", "holdings", "a b c d", "", ""]
    assert values(spark, subjects.source_entity, "Acme IR News", "Acme Developer Changelog", " Acme ", None) == ["Acme", "Acme", "Acme", ""]
    assert values(spark, subjects.reports_loss, "Profit FALLS", "净利下滑", "profit up", None) == [True, True, False, False]
    rows = spark.createDataFrame([("Acme Corp", None, "x"), (None, ["Beta Ltd"], "x"), (None, [], "x"), (None, None, "")], "c string, l array<string>, s string")
    got = rows.select(subjects.event_subject(F.col("c"), F.col("l"), F.col("s")), subjects.display_subject(F.col("c"), F.col("l"), F.col("s"))).collect()
    assert [r[0] for r in got] == ["acme", "beta", "x", ""] and [r[1] or "" for r in got] == ["x", "x", "x", ""]


@pytest.mark.parametrize(
    ("text", "day"),
    [("On March 3rd it", dt.date(2024, 3, 3)), ("Sept. 30", dt.date(2023, 9, 30)), ("may 5", dt.date(2023, 5, 5)), ("Feb 30", None), ("Feb 29", dt.date(2024, 2, 29)), ("soon", None), ("", None), (None, None)],
)
def test_recent_month_day(spark, text, day):
    assert values(spark, lambda t: subjects.recent_month_day(t, F.lit("2024-03-10").cast("date")), text) == [day]


def test_article_date(spark):
    rows = [
        ("https://a/2024/03/01/x", "t 2024-02-01", "b 2024-01-01"),
        ("https://a/2024/09/01/x", "t", "b 2024-01-01"),
        ("https://a/2024/09/01/x", "t", None),
        ("https://a/x", "on 2024-02-01", ""),
        ("https://a/x", None, "Posted March 2"),
        (None, None, None),
    ]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, url string, title string, body string")
    found = [r["x"] for r in frame.select("i", subjects.article_date(F.col("url"), F.col("title"), F.col("body"), F.lit("2024-03-10").cast("date")).alias("x")).orderBy("i").collect()]
    assert [(x["basis"], x["confidence"]) for x in found] == [("url_path", "high"), ("body_text", "low"), ("url_path", "high"), ("title_text", "medium"), ("body_month_day", "low"), ("observed_at", "observed")]
    assert found[0]["published_at"] == dt.date(2024, 3, 1) and found[2]["published_at"] is None and found[2]["scheduled_at"] == dt.date(2024, 9, 1)
    assert found[4]["published_at"] == dt.date(2024, 3, 2) and found[5]["published_at"] is None


def test_profiles(spark):
    def row(kind, company=None, title="", **declared):
        names = [f.split()[0] for f in FIELDS.split(", ")]
        return tuple({"event_type": kind, "company": company, "title": title, **declared}.get(n) for n in names)

    rows = [
        row(None, title=None),
        row("funding", "Acme"),
        row("other", "Acme", "Acme hires engineers"),
        row("model", title="Lab launches a large language model"),
        row("model", title="Lab launches a language model, best in class"),
        row("other", title="Regulator fined it", scope_layer="regional_policy"),
        row("strategy", title="market share report", source_signals=["industry_analysis"]),
        row("strategy", title="x", source_type="Research"),
        row("earnings", "Acme", "Antitrust ruling"),
        row("other", title="relaunches"),
        row("other", title="新品上线"),
        row("other", declared_content="company_action", declared_subject="fund", declared_claim=" ", declared_action="hiring"),
    ]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {FIELDS}")
    got = profiles.profiled(frame, F.col("title")).orderBy("i").select("content_type", "subject_type", "claim_type", "action_type").collect()
    assert [tuple(r) for r in got] == [
        ("generic_industry_change", "industry", "industry_change", "other"),
        ("capital_event", "company", "industry_change", "funding"),
        ("company_action", "company", "company_action", "hiring"),
        ("model_release", "ai_model", "release_fact", "product_release"),
        ("model_release", "ai_model", "performance_claim", "product_release"),
        ("regional_policy", "region_policy", "policy_change", "policy_change"),
        ("industry_report", "report", "institutional_assessment", "expansion"),
        ("industry_report", "report", "institutional_assessment", "expansion"),
        ("capital_event", "company", "industry_change", "policy_change"),
        ("generic_industry_change", "industry", "industry_change", "other"),
        ("generic_industry_change", "industry", "industry_change", "product_release"),
        ("company_action", "fund", "company_action", "hiring"),
    ]


def test_countries(spark):
    lexicon = Lexicon((("Japan", ("japan", "tokyo")), ("Brazil", ("brazil", "são paulo")), ("US", ("united states", "u.s."))))
    markets = spark.createDataFrame([("Acme", "Japan", False), ("Acme", "Brazil", False), ("Beta", "Brazil", False), ("Beta", "US", True), (None, "US", True)], "company string, country string, is_home boolean")
    events = spark.createDataFrame([(1, "Acme", "in the U.S."), (2, "Beta", ""), (3, None, "From Tokyo to Brazil"), (4, "New", "Brazilian"), (5, None, None)], "ord int, company string, title string")
    got = {r["ord"]: (r["countries"], r["primary_country"], r["tag_method"]) for r in profiles.tagged_countries(events, markets, lexicon).collect()}
    assert got == {1: (["Brazil", "Japan"], "Brazil", "company_market"), 2: (["Brazil", "US"], "US", "company_market"), 3: (["Brazil", "Japan"], "Brazil", "title_keyword"), 4: ([], None, ""), 5: ([], None, "")}


def test_topics_and_groups(spark):
    rows = spark.createDataFrame([("支付 — 亚太观察", None, None, "t"), (None, " ", "云/x", "t"), (None, None, "持续观察", "a, b c d e"), ("", None, None, "")], "topic string, company string, direction string, title string")
    assert [r[0] for r in rows.select(profiles.cluster_topic(*map(F.col, rows.columns))).collect()] == ["支付", "云", "a b c d", "区域信号"]
    events = spark.createDataFrame([("d1", "watch", "高"), ("d1", None, "高"), ("d1", "odd", "中"), ("d2", None, None)], "day string, view_priority string, bd_priority string")
    got = {r["day"]: (r["selected"], r["important"], r["watch"], r["navigation"]) for r in profiles.day_groups(events).collect()}
    assert got == {"d1": (1, 1, 1, "今日事件导航：3 条合格事件。精选 1 条，重点 1 条，观察 1 条"), "d2": (0, 0, 1, "今日事件导航：1 条合格事件。观察 1 条")}
    told = spark.createDataFrame([(1, "d1", "A", "R", "ma"), (2, "d1", "A", None, "x"), (3, "d1", "B", "", None), (4, "d2", None, None, None)], "ord int, day string, label string, region string, event_type string")
    got = {r["day"]: (r["title"], r["judgement"]) for r in profiles.day_briefs(told).collect()}
    tail = "；日报先看对象和证据，周报再收敛窗口和方向。"
    assert got == {"d1": ("今日优先看A、B", "今日新增3条可读事件，覆盖R，重点类型为并购、x" + tail), "d2": ("今日观察主线", "今日新增1条可读事件" + tail)}


def test_unique_evidence(spark):
    rows = [("n", 1, "u1", None, "a"), ("n", 2, "u1", None, "b"), ("n", 3, None, None, None), ("n", 4, "", None, "c"), ("n", 5, None, None, "c"), ("m", 9, "u1", None, "a")]
    frame = spark.createDataFrame(rows, "narrative string, place int, url string, day date, title string")
    assert sorted((r["narrative"], r["nth"], r["title"]) for r in profiles.unique_evidence(frame).collect()) == [("m", 1, "a"), ("n", 1, "a"), ("n", 2, "c")]
    assert profiles.unique_evidence(frame.limit(0)).count() == 0


def test_narrative_confidence(spark):
    rows = spark.createDataFrame([(2, 1, 0.8, True), (2, 1, 0.8, False), (1, 0, 0.5, True), (0, 0, 1.0, False)], "c int, h int, s double, p boolean")
    assert [r[0] for r in rows.select(profiles.narrative_confidence(*map(F.col, rows.columns))).collect()] == ["高", "观察", "中", "观察"]
