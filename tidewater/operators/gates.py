"""Scope, relevance, priority and view gates as projections over lexicon hits.

Each gate is one ``when`` chain over boolean hit columns; the order of the
branches is the meaning.  Facts come from raw text only, never from generated
reasons.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.lexicon import Lexicon

STRONG_TYPES = ("funding", "ma", "earnings", "regional_policy", "strategy")
FIRST_CLASS = ("report", "model")
HARD_TYPES = ("funding", "ma", "earnings")


def relevance_of(hit: Callable[[str], Column]) -> Column:
    """0 to 3: hard-out terms 0; core 3, adjacent 2, edge 1; otherwise 1, or 0 with out terms.

    With out terms a core hit counts 2.  ``hit`` gives the hit column of a class.
    """
    return (
        F.when(hit("hard_out"), 0)
        .when(hit("core"), F.when(hit("out"), 2).otherwise(3))
        .when(hit("adjacent"), 2)
        .when(hit("edge"), 1)
        .when(hit("out"), 0)
        .otherwise(1)
    )


def relevance(text: Column, lexicon: Lexicon) -> Column:
    return relevance_of(lambda name: lexicon.hit(text, name))


def with_hits(df: DataFrame, lexicon: Lexicon, industries: Lexicon) -> DataFrame:
    """Add ``hit_<class>`` (title and text), ``title_<class>`` (title) and ``direct_industries``.

    Every text is matched once, with all terms of both lexicons, into a column
    of its own; the optimizer does not copy such a column into its many users.
    """
    body, title = F.lower(F.concat_ws(" ", "title", "text")), F.lower(F.coalesce("title", F.lit("")))
    rows = df.withColumns({"body_terms": lexicon.found(body, industries), "title_terms": lexicon.found(title)})
    hits = {f"hit_{name}": lexicon.in_found(F.col("body_terms"), name, industries) for name, _ in lexicon.classes}
    hits |= {f"title_{name}": lexicon.in_found(F.col("title_terms"), name) for name, _ in lexicon.classes}
    return rows.withColumns(hits | {"direct_industries": industries.found_labels(F.col("body_terms"), lexicon)}).drop("body_terms", "title_terms")


def assess_scope(df: DataFrame, lexicon: Lexicon, industries: Lexicon) -> DataFrame:
    """Add scope_status, scope_reason, scope_layer and scope_industries, and the columns of ``with_hits``.

    Needs title, text, declared_industries, event_type, tier, role, region and
    is_company.  Nulls count as no hit; a class that the lexicon lacks never hits.
    """
    df = with_hits(df, lexicon, industries)
    known = set(df.columns)
    hit = lambda name: F.col(name) if name in known else F.lit(False)
    direct, company = F.col("direct_industries"), F.coalesce("is_company", F.lit(False))
    contracted = F.array_distinct(F.concat(direct, F.coalesce("declared_industries", F.array().cast("array<string>"))))
    kind = F.coalesce(F.col("event_type"), F.lit("other"))
    action = hit("hit_action") | kind.isin(*STRONG_TYPES)
    trusted = F.coalesce(F.col("role").isin("official_ir", "developer_change") | F.col("tier").isin("L1", "L4-vertical") | F.col("is_company"), F.lit(False))
    by_source = (F.size(direct) == 0) & (F.size(contracted) > 0) & trusted & (action | hit("hit_industry_change") | company)
    df = df.withColumn("scope_industries", F.when(F.size(direct) > 0, direct).when(by_source, contracted).otherwise(F.array().cast("array<string>")))
    none = F.size("scope_industries") == 0
    leg_a = (hit("title_policy") & hit("hit_digital")) | (kind == "regional_policy")
    leg_b = F.coalesce(F.col("region").isNotNull() & (F.col("region") != "GLOBAL"), F.lit(False)) & hit("title_structural") & hit("hit_digital")
    editorial = hit("title_editorial") & ~(hit("title_policy") | hit("title_action") | hit("title_quantified"))
    no_change = ~(hit("hit_policy") | hit("hit_industry_change") | action)
    reason = (
        F.when(none & leg_a, "policy_without_industry")
        .when(none & leg_b, "structural_without_industry")
        .when(none, "no_target_industry")
        .when(editorial, "editorial_title")
        .when(no_change, "no_explicit_change")
        .otherwise("direct_industry_change")
    )
    layer = (
        F.when(none & leg_a, "regional_policy")
        .when(none & leg_b, "industry_change")
        .when(none | editorial | no_change, F.lit(None))
        .when(hit("hit_policy"), "regional_policy")
        .when(hit("hit_industry_change") & ~company, "industry_change")
        .otherwise("company_action")
    )
    # The reason says the status, so its chain is not walked twice.
    df = df.withColumns({"scope_reason": reason, "scope_layer": layer})
    because = F.col("scope_reason")
    status = F.when(because == "no_target_industry", "filtered").when(because.isin("editorial_title", "no_explicit_change"), "candidate").otherwise("qualified")
    return df.withColumn("scope_status", status)


def quality_flags(summary: Column, reason: Column, impact: Column, title: Column) -> Column:
    """Flags of an analysed event, in fixed order."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    return F.array_compact(
        F.array(
            F.when(blank(summary), "missing_summary"),
            F.when(~blank(summary) & F.startswith(F.coalesce(title, F.lit("")), F.substring(summary, 1, 12)), "summary_repeats_title"),
            F.when(blank(reason), "missing_reason"),
            F.when(blank(impact) | (F.lower(impact) == "unknown"), "unknown_impact"),
        )
    )


def bd_priority() -> Column:
    """high / mid / watch from scope_status, actionable, event_type, score, tier, is_company, is_google, attention, confidence."""
    s, kind = F.coalesce("score", F.lit(0)), F.coalesce(F.col("event_type"), F.lit("other"))
    attention, confidence = F.coalesce("attention", F.lit(0)), F.coalesce("confidence", F.lit(0))
    company = F.coalesce("is_company", F.lit(False))
    first_class = F.when((attention >= 70) & (confidence >= 65), "high").when((attention >= 50) & (confidence >= 50), "mid").otherwise("watch")
    l1 = F.coalesce(F.col("tier") == "L1", F.lit(False))
    return (
        F.when(F.col("scope_status") != "qualified", "watch")
        .when((kind == "funding") & ~F.col("actionable"), "watch")
        .when(kind.isin(*FIRST_CLASS), F.when(F.col("needs_review"), "watch").otherwise(first_class))
        .when(kind == "other", F.when(company & l1 & (s >= 4), "mid").otherwise("watch"))
        .when(F.col("is_google") & F.col("low_signal"), "watch")
        .when(s >= F.when(l1, 5).otherwise(7), "high")
        .when(kind.isin(*HARD_TYPES) & (s >= 5) & ~F.col("is_google"), "high")
        .when(kind.isin(*STRONG_TYPES) & ((s >= 4) | company), "mid")
        .otherwise("watch")
    )


def view_gates(df: DataFrame) -> DataFrame:
    """Add in_main, in_review, view_status and drop_reason to rows with a priority."""
    kind, s = F.coalesce(F.col("event_type"), F.lit("other")), F.coalesce("score", F.lit(0))
    scope, mainline = F.col("scope_status") == "qualified", F.col("relevance") >= 2
    strong, first_class = kind.isin(*STRONG_TYPES), kind.isin(*FIRST_CLASS)
    google, review = F.col("is_google"), F.col("needs_review")
    attention, confidence = F.coalesce("attention", F.lit(0)), F.coalesce("confidence", F.lit(0))
    high = (F.col("bd_priority") == "high") & ~review & F.col("actionable") & (kind != "other") & ~google
    by_class = F.when(first_class, ~google & (attention >= 50) & (confidence >= 50)).otherwise(strong & ~google & (s >= 2))
    main = scope & mainline & ~review & (high | (F.col("actionable") & by_class))
    second = (
        F.when(first_class, (attention >= 40) & (confidence >= 45) & ~review)
        .when(google, strong & (s >= 5) & ~F.col("low_signal") & ~review)
        .otherwise(strong & ((s >= 3) | (F.col("bd_priority") == "mid")))
    )
    gated = df.withColumns({"in_main": main, "in_review": ~main & scope & mainline & second})
    reason = (
        F.when(F.col("in_main"), "main")
        .when(~scope, "out_of_scope_industry")
        .when((kind == "funding") & ~F.col("actionable"), "capital_only_low_actionability")
        .when(review, "quality_review")
        .when(google, "google_not_main")
        .when(kind == "other", "other_type")
        .otherwise("weak_signal")
    )
    status = F.when(F.col("in_main"), "main").when(F.col("in_review"), "review").otherwise("filtered")
    return gated.withColumns({"view_status": status, "drop_reason": reason})
