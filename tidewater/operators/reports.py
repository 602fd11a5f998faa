"""Governance decisions: lifecycles, conversion actions, coverage, clusters and tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lifecycle(runs: Column, nonzero: Column, raw: Column, signals: Column, failed: Column, stored: Column, high: Column) -> Column:
    """failed / zero-hit / stable / partial of a source."""
    steady = (runs > 0) & (nonzero >= F.greatest(F.lit(2), F.floor(runs / 2).cast("long"))) & (signals > 0)
    return (
        F.when((raw == 0) & (stored == 0) & (failed > 0), "failed")
        .when((raw == 0) & (stored == 0), "zero-hit")
        .when(steady | (high >= 5) | (stored >= 20), "stable")
        .otherwise("partial")
    )


def governance_action(google: Column, raw: Column, signal: Column, stored: Column, main: Column, lost: Column) -> Column:
    """The first action that applies to a source's conversion."""
    share = F.when(stored > 0, main / stored).otherwise(0.0)
    kept = F.when(signal > 0, stored / signal).otherwise(0.0)
    return (
        F.when(google, "keep_as_gap_fill")
        .when((signal >= 50) & (main == 0), "audit_raw_signal_quality")
        .when((signal >= 20) & (stored == 0), "instrument_candidate_loss")
        .when((stored >= 20) & (share >= 0.4), "promote_weight")
        .when((main >= 10) | ((main >= 5) & (share >= 0.35)), "keep_core")
        .when((stored >= 5) & (main == 0), "downgrade_or_reclassify")
        .when((raw == 0) & (stored == 0), "pause")
        .when((lost >= 20) & (kept < 0.15), "audit_conversion_loss")
        .otherwise("observe")
    )


def coverage_status(main: Column, stored: Column, entities: Column, regions: Column) -> Column:
    return (
        F.when((main >= 8) & (entities >= 5) & (regions >= 3), "healthy")
        .when((stored >= 8) & (entities >= 3) & (regions >= 2), "thin_but_usable")
        .when(stored >= 3, "thin")
        .otherwise("sparse")
    )


def signal_clusters(rows: DataFrame, as_of: str, days: int, focus: str) -> DataFrame:
    """Clusters of the last ``days`` days by (region, event_type, topic).

    At least two events, two of seven flags and one source that is no search
    feed.  The score is 10 a flag, 2 an event, the three best scores and 8 if the
    focus day is among the days.
    """
    recent = rows.filter((F.col("day") > F.date_sub(F.lit(as_of).cast("date"), days)) & (F.col("day") <= F.lit(as_of).cast("date")))
    # Relevance is asked inside the aggregations: a filter by it would be pushed down with copies of the match.
    eligible = recent.filter("event_type <> 'other' and not needs_review").withColumn("told", F.col("relevance") >= 2)
    told = lambda c: F.when(F.col("told"), c)
    keys = ["region", "event_type", "topic"]
    # Three scores of a cluster leave a task, however many it has.
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("told"), F.desc("score")))
    best = eligible.filter("score is not null").withColumn("nth", nth).filter("nth <= 3 and told").groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.sum("score").cast("int").alias("top_scores"))
    grouped = eligible.groupBy("region", "event_type", "topic").agg(
        F.count_if("told").alias("events"),
        F.countDistinct(told(F.col("company"))).alias("companies"),
        F.countDistinct(told(F.col("source"))).alias("sources"),
        F.countDistinct(told(F.col("day"))).alias("days"),
        F.max(told(F.col("bd_priority") == "high")).alias("any_high"),
        F.count_if(F.col("told") & ~F.col("is_google")).alias("direct"),
        F.max(told(F.col("tier") == "L1")).alias("official"),
        F.max(told(F.col("score"))).alias("best_score"),
        F.max(told(F.col("day") == F.lit(focus).cast("date"))).alias("has_focus"),
    )
    grouped = grouped.join(best, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").withColumn("top_scores", F.coalesce("top_scores", F.lit(0)))
    flags = [F.col("companies") >= 2, F.col("sources") >= 2, F.col("days") >= 2, F.col("any_high"), F.col("direct") >= 2, F.col("official"), F.col("best_score") >= 7]
    count = sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))
    scored = grouped.withColumn("flags", count).filter("events >= 2 and flags >= 2 and direct > 0")
    points = 10 * F.col("flags") + 2 * F.col("events") + F.col("top_scores") + F.when(F.col("has_focus"), 8).otherwise(0)
    sure = F.when((F.col("flags") >= 4) & (F.col("any_high") | (F.col("direct") >= 2)), "high").when(F.col("flags") >= 3, "mid").otherwise("watch")
    return scored.select("region", "event_type", "topic", "events", "companies", "sources", "flags", "has_focus", points.alias("cluster_score"), sure.alias("confidence"))


def observed_status(points: DataFrame) -> DataFrame:
    """One status per entity folded from its points' statuses."""
    total, of = F.count("*"), lambda s: F.count_if(F.col("status") == s)
    folded = (
        F.when(of("pending") == total, "pending")
        .when(of("failed") == total - of("pending"), "failed")
        .when(of("failed") + of("unverified") + of("pending") > 0, "partial")
        .when(of("active") > 0, "active")
        .when(of("changed_below_threshold") > 0, "changed")
        .otherwise("quiet")
    )
    return points.groupBy("entity").agg(F.count("*").alias("points"), of("active").alias("active_points"), folded.alias("entity_status"))


def signal_key(event_type: Column, triggers: Column, direction: Column) -> Column:
    """The kind of window that an event belongs to: by its type, else its triggers, else its direction."""
    triggers = F.coalesce(triggers, F.array().cast("array<string>"))
    head = F.trim(F.substring_index(F.coalesce(direction, F.lit("")), "/", 1))
    return (
        F.when(event_type.isin("funding", "ma", "earnings"), event_type)
        .when(F.arrays_overlap(triggers, F.array(F.lit("扩张窗口"), F.lit("生态窗口"))), "expansion")
        .when(F.array_contains(triggers, "合规窗口"), "compliance")
        .when(head.contains("支付"), "payment")
        .when(head.contains("云") | head.contains("AI") | head.contains("基础设施"), "ai_infra")
        .otherwise("strategy")
    )


def focus_windows(rows: DataFrame, limit: int = 3) -> DataFrame:
    """The ``limit`` best (region, signal) windows of each period: events, objects, high, confidence and score.

    ``rows`` has ord, period, region, event_type, triggers, direction, object, source, day, priority
    (高, 中, 观察), high_value, is_google, mainline and score.  A window needs two events
    from more than one object, source or day.  Events of no type, of search feeds and off
    the main line do not count, nor do those without priority unless their type is hard.
    The first four objects are named, best event first.
    """
    told = rows.filter("event_type <> 'other' and not is_google and mainline").withColumn("region", F.coalesce(F.nullif("region", F.lit("")), F.lit("多地区")))
    told = told.filter(F.col("high_value") | F.col("priority").isin("高", "中") | F.col("event_type").isin("funding", "ma", "earnings"))
    told = told.withColumn("signal", signal_key(F.col("event_type"), F.col("triggers"), F.col("direction")))
    keys = ["period", "region", "signal"]
    sure = (F.col("priority") == "高") | F.col("high_value")
    named = F.nullif("object", F.lit(""))
    grouped = told.groupBy(*keys).agg(F.count("*").alias("events"), F.countDistinct(named).alias("objects"), F.countDistinct(F.nullif("source", F.lit(""))).alias("sources"), F.countDistinct("day").alias("days"), F.count_if(sure).alias("high"))
    grouped = grouped.filter("events >= 2 and (objects >= 2 or sources >= 2 or days >= 2)")
    rank = F.when(F.col("priority") == "高", 3).when(F.col("priority") == "中", 2).otherwise(1)
    place = F.struct((-rank).alias("rank"), (-F.col("score")).alias("score"), (-F.unix_date("day")).alias("day"), "ord")
    first = told.filter(named.isNotNull()).groupBy(*keys, "object").agg(F.min(place).alias("place"))
    first = first.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("place"))).filter("nth <= 4")
    names = first.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("nth", "object"))), lambda o: o["object"]), "、").alias("names"))
    confidence = F.when((F.col("events") >= 4) & (F.col("high") >= 2), "高").when(F.col("high") > 0, "中").otherwise("观察")
    scored = grouped.join(names, keys, "left").withColumns({"confidence": confidence, "window_score": 3 * F.col("events") + 5 * F.col("high") + F.col("objects"), "names": F.coalesce("names", "region")})
    order = Window.partitionBy("period").orderBy((F.col("confidence") == "高").desc(), F.desc("window_score"), F.desc("events"), "region", "signal")
    ranked = scored.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= limit)
    return ranked.select("period", "place", "region", "signal", "names", "events", "objects", "high", "confidence", "window_score")
