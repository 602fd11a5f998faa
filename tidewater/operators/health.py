"""Health facts of a store and the gates over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def quick_facts(events: DataFrame, as_of: str, shortest_key: int = 11) -> DataFrame:
    """One row: events, days, future events, repair and duplicate ratios, share of the largest source.

    Needs day, title_key, source, needs_review and in_main.  Repeats are counted over
    title keys of at least ``shortest_key`` characters.
    """
    keys = events.filter(F.length("title_key") >= shortest_key).groupBy("title_key").agg(F.count("*").alias("n"))
    repeats = keys.agg(F.sum(F.col("n") - 1).alias("repeats"), F.sum("n").alias("keyed"))
    largest = events.groupBy("source").agg(F.count("*").alias("n")).agg(F.max("n").alias("largest"))
    totals = events.agg(
        F.count("*").alias("events"),
        F.countDistinct("day").alias("days"),
        F.count_if(F.col("day") > F.lit(as_of).cast("date")).alias("future"),
        F.count_if("in_main").alias("main"),
        F.count_if("needs_review").alias("reviews"),
    )
    # Three one-row tables side by side.
    row = totals.join(F.broadcast(repeats)).join(F.broadcast(largest))
    ratio = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return row.select("events", "days", "future", "main", ratio("reviews", "events").alias("review_ratio"), ratio("repeats", "keyed").alias("duplicate_ratio"), ratio("largest", "events").alias("source_share"))


def gate_failures(facts: DataFrame, limits: dict[str, tuple[str, float]]) -> DataFrame:
    """(fact, value, bound, limit) of every fact beyond its limit; no rows mean that the gate is passed.

    ``limits`` maps a fact to ("most" or "least", limit); a null fact fails.
    """
    checks = [F.struct(F.lit(k).alias("fact"), F.col(k).cast("double").alias("value"), F.lit(b).alias("bound"), F.lit(float(v)).alias("limit")) for k, (b, v) in limits.items()]
    rows = facts.select(F.explode(F.array(*checks)).alias("c")).select("c.*")
    failed = F.when(F.col("bound") == "most", F.col("value") > F.col("limit")).otherwise(F.col("value") < F.col("limit"))
    return rows.filter(F.coalesce(failed, F.lit(True)))


def collection_timing(runs: DataFrame, last: int = 8) -> DataFrame:
    """The newest runs with the time since the one before, newest first."""
    order = Window.partitionBy(F.lit(0)).orderBy("run")
    newest = runs.orderBy(F.col("run").desc()).limit(last + 1)
    timed = newest.withColumn("days_since", F.datediff("run", F.lag("run").over(order)))
    return timed.orderBy(F.col("run").desc()).limit(last)


def over_rate(requests: DataFrame, who: str, at: str, most: int = 5, window: str = "1 hour") -> DataFrame:
    """Callers with more than ``most`` requests in a tumbling window."""
    counted = requests.groupBy(F.window(at, window).alias("w"), who).agg(F.count("*").alias("requests"))
    return counted.filter(F.col("requests") > most).select(who, F.col("w.start").alias("starts"), "requests")


def smart_filter(items: DataFrame, per_region: int = 12, overall: int = 40, per_company: int = 3) -> DataFrame:
    """The selection of every day: official company items, all signals, then others by region within the quotas.

    Needs day, ord, event_type, region, company, priority and official; every rule holds
    within a day.  Official company items of type other come first, by priority and
    company: at most one per company.  All items of another type follow.  Other
    items fill each region up to ``per_region`` less what it has, and the day up to
    ``overall``; of official items a company keeps at most ``per_company``.
    """
    is_other = F.col("event_type") == "other"
    best_first = [F.col("priority").desc(), F.col("ord")]
    official = items.filter(F.col("official") & is_other & F.col("company").isNotNull())
    official = official.withColumn("nth", F.row_number().over(Window.partitionBy("day", "company").orderBy(*best_first))).filter("nth <= 1").drop("nth")
    signals = items.filter(~is_other)
    capped = signals.withColumn("nth", F.row_number().over(Window.partitionBy("day", "company", "official").orderBy("ord"))).filter(~F.col("official") | F.col("company").isNull() | (F.col("nth") <= per_company)).drop("nth")
    kept = official.withColumn("kept_as", F.lit("official")).unionByName(capped.withColumn("kept_as", F.lit("signal")))
    used = kept.groupBy("day", "region").agg(F.count("*").alias("used"))
    total = kept.groupBy("day").agg(F.count("*").alias("total"))
    rest = items.filter(is_other).join(official.select("ord"), "ord", "left_anti")
    # Ranks up to a fixed place are limited before the shuffle, so a day's other items never meet in one task.
    place = F.row_number().over(Window.partitionBy("day", "region").orderBy(*best_first))
    rest = rest.withColumn("place", place).filter(F.col("place") <= per_region).join(used, ["day", "region"], "left").filter(F.col("place") <= F.lit(per_region) - F.coalesce("used", F.lit(0)))
    nth = F.row_number().over(Window.partitionBy("day").orderBy(*best_first))
    chosen = rest.withColumn("nth", nth).filter(F.col("nth") <= overall).join(total, "day", "left").filter(F.col("nth") <= F.lit(overall) - F.coalesce("total", F.lit(0)))
    return kept.unionByName(chosen.select(*items.columns, F.lit("quota").alias("kept_as")))
