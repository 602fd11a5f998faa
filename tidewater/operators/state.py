"""Snapshot differences, the candidate pool and run retention, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def snapshot_diff(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change): rows only in the current snapshot are added, only in the previous one removed.

    One full outer join; repeated rows count once.
    """
    old = previous.select(*keys).distinct().withColumn("was", F.lit(True))
    new = current.select(*keys).distinct().withColumn("is", F.lit(True))
    both = old.join(new, keys, "full_outer").filter("was is null or is is null")
    return both.select(*keys, F.when(F.col("was").isNull(), "added").otherwise("removed").alias("change"))


def diff_summary(diff: DataFrame, entity: str, sizes: DataFrame, tag: str) -> DataFrame:
    """Per entity: added, removed, the strongest tag's count, and what becomes of it.

    ``sizes`` has entity, previous and current counts.  A refresh of the whole
    board (both sides of ten or more; shrunk below 40 % or fully exchanged) is rejected.
    """
    by_tag = diff.groupBy(entity, "change", tag).agg(F.count("*").alias("n"))
    counts = by_tag.groupBy(entity).agg(
        F.sum(F.when(F.col("change") == "added", F.col("n")).otherwise(0)).alias("added"),
        F.sum(F.when(F.col("change") == "removed", F.col("n")).otherwise(0)).alias("removed"),
        F.max(F.when(F.col("change") == "added", F.col("n")).otherwise(0)).alias("top_tag"),
        F.max("n").alias("top_any"),
    )
    rows = sizes.join(counts, entity, "left").fillna(0, ["added", "removed", "top_tag", "top_any"])
    big = (F.col("previous") >= 10) & (F.col("current") >= 10)
    churn = F.least("added", "removed") / F.greatest("previous", "current")
    reset = big & ((F.col("current") < 0.4 * F.col("previous")) | (churn >= 1))
    signal = (F.col("added") >= 3) | (F.col("removed") >= 3) | (F.col("top_any") >= 2)
    status = (
        F.when(~signal, "none")
        .when(reset, "rejected")
        .when(F.col("removed") > F.col("added"), "accumulating")
        .when((F.col("added") >= 3) & (F.col("top_tag") >= 2), "qualified")
        .otherwise("accumulating")
    )
    return rows.select(entity, "previous", "current", "added", "removed", "top_tag", status.alias("status"))


def merge_candidates(observed: DataFrame, key: str, order: str, keep: int = 500) -> DataFrame:
    """The candidate pool after all observations, as one aggregation.

    ``observed`` has the key, an order, status (accumulating / qualified /
    rejected) and refs.  A candidate is promoted at its first qualified
    observation and never changes after it: only observations up to that one count.
    The newest ``keep`` candidates stay.
    """
    first = Window.partitionBy(key)
    promoted_at = F.min(F.when(F.col("status") == "qualified", F.col(order))).over(first)
    live = observed.withColumn("promoted_at", promoted_at).filter("promoted_at is null or " + order + " <= promoted_at")
    pool = live.groupBy(key).agg(
        F.min(order).alias("first_seen"),
        F.max(order).alias("last_seen"),
        F.sum("refs").alias("refs"),
        F.when(F.max("promoted_at").isNotNull(), "promoted").otherwise(F.max_by("status", order)).alias("status"),
    )
    return pool.orderBy(F.col("last_seen").desc(), key).limit(keep)


def retain_runs(existing: DataFrame, new: DataFrame, key: str, order: str, keep: int = 30) -> DataFrame:
    """Upsert by key (new rows replace old ones), then the newest ``keep`` rows."""
    merged = existing.join(new.select(key), key, "left_anti").unionByName(new)
    return merged.orderBy(F.col(order).desc(), key).limit(keep)
