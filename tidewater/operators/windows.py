"""Ranked selection, quotas, run series and change detection against prior windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_group(df: DataFrame, groups: list[str], order: list[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows of each group; the rank limit is applied before the shuffle too."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).filter(F.col("rank") <= limit)


def first_seen(df: DataFrame, keys: list[str], order: list[str], where: Column | None = None) -> DataFrame:
    """The first row per key, by aggregation (one struct per key and task is shuffled).

    ``where`` leaves rows out inside the aggregation.  A filter would be pushed below the columns
    it asks for, with a copy of what makes them for each time they are asked.
    """
    rest = [c for c in df.columns if c not in order]
    row = F.struct(*order, *rest)
    first = F.min(row if where is None else F.when(where, row)).alias("row")
    return df.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(first).filter("row is not null").select("row.*").select(*df.columns)


def running_quota(df: DataFrame, group: str, order: list[Column], per_group: int, overall: int, reserved: DataFrame | None = None, within: list[str] | None = None) -> DataFrame:
    """Rows within a quota per group and, of those, within an overall one; both hold for each value of ``within`` (a day).

    ``reserved`` (within, group, reserved) lowers the quota of a group.  The overall cut
    ranks at most per_group rows of each group.
    """
    within = within or []
    ranked = df.withColumn("place", F.row_number().over(Window.partitionBy(*within, group).orderBy(*order))).filter(F.col("place") <= per_group)
    if reserved is not None:
        ranked = ranked.join(reserved, [*within, group], "left").filter(F.col("place") <= F.lit(per_group) - F.coalesce("reserved", F.lit(0))).drop("reserved")
    if not within:
        return ranked.orderBy(*order).limit(overall)
    return ranked.withColumn("of_all", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).filter(F.col("of_all") <= overall).drop("of_all")


def run_alerts(runs: DataFrame, last: int = 5, failed_at_least: int = 2, stored_at_least: int = 5) -> DataFrame:
    """Sources that were alive once and whose last ``last`` runs all returned nothing.

    ``runs`` has source, run (ordered), items, failed (0/1).  kind is
    fetch_failure if enough of those runs failed, else supply_drop if the source
    ever stored enough; other silent sources give no alert.
    """
    ranked = runs.withColumn("back", F.row_number().over(Window.partitionBy("source").orderBy(F.col("run").desc())))
    recent = F.col("back") <= last
    stats = ranked.groupBy("source").agg(
        F.max("items").alias("best"),
        F.max(F.when(recent, F.col("items"))).alias("recent_best"),
        F.sum(F.when(recent, F.col("failed"))).alias("recent_failed"),
        F.sum("items").alias("stored"),
        F.max(F.when(F.col("items") > 0, F.col("run"))).alias("last_alive"),
    )
    kind = F.when(F.col("recent_failed") >= failed_at_least, "fetch_failure").when(F.col("stored") >= stored_at_least, "supply_drop")
    return stats.filter("best > 0 and recent_best = 0").withColumn("kind", kind).filter("kind is not null").select("source", "kind", "last_alive", "stored", "recent_failed")


def change_windows(facts: DataFrame, key: str, day: str, start: str, end: str, priors: int = 3, min_atoms: int = 3, min_weeks: int = 1) -> DataFrame:
    """Current window against the mean of equal prior windows, corrected for coverage.

    One row per key with at least ``min_atoms`` facts in at least ``min_weeks`` ISO
    weeks.  Windows without any fact do not enter the baseline; a coverage ratio
    outside 0.8 to 1.25 scales the current count by 0.75 to 1.30.  Facts are counted in one
    pass: a row's window number follows from its distance to the end.
    """
    span = F.datediff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1
    back = F.floor(F.datediff(F.lit(end).cast("date"), F.col(day)) / span).cast("int")
    rows = facts.withColumn("back", back).filter((F.col("back") >= 0) & (F.col("back") <= priors))
    counts = rows.groupBy("back", key).agg(F.count("*").alias("atoms"), F.countDistinct(F.weekofyear(day)).alias("weeks"))
    totals = counts.groupBy("back").agg(F.sum("atoms").alias("total"))
    # One row per window: at most ``priors`` + 1.
    bases = totals.agg(
        F.max(F.when(F.col("back") == 0, F.col("total"))).alias("current_total"),
        F.count_if(F.col("back") > 0).alias("windows"),
        F.avg(F.when(F.col("back") > 0, F.col("total"))).alias("mean_total"),
    )
    per_key = counts.groupBy(key).agg(
        F.sum(F.when(F.col("back") == 0, F.col("atoms"))).alias("atoms"), F.max(F.when(F.col("back") == 0, F.col("weeks"))).alias("weeks"), F.sum(F.when(F.col("back") > 0, F.col("atoms"))).alias("before")
    )
    current = per_key.filter((F.col("atoms") >= min_atoms) & (F.col("weeks") >= min_weeks)).join(F.broadcast(bases))
    ratio = F.col("current_total") / F.col("mean_total")
    fix = F.when((ratio < 0.8) | (ratio > 1.25), F.least(F.greatest(F.col("mean_total") / F.col("current_total"), F.lit(0.75)), F.lit(1.30))).otherwise(1.0)
    rated = current.withColumns({"base": F.coalesce("before", F.lit(0)) / F.nullif("windows", F.lit(0)), "correction": F.coalesce(F.when(F.col("windows") > 0, fix), F.lit(1.0))})
    rated = rated.withColumn("adjusted", F.col("atoms") * F.col("correction"))
    growth = F.when(F.col("base") > 0, F.col("adjusted") / F.col("base")).otherwise(2.0)
    trend = (
        F.when(F.coalesce("windows", F.lit(0)) == 0, "new")
        .when((F.col("adjusted") >= F.col("base") + 2) & (growth >= 1.25), "rising")
        .when((F.col("adjusted") <= F.col("base") - 2) & (growth <= 0.75), "falling")
        .otherwise("steady")
    )
    rise = F.greatest(F.bround(F.col("adjusted") - F.coalesce("base", F.lit(0.0)), 0), F.lit(0.0))
    return rated.select(key, "atoms", "weeks", "base", "correction", "adjusted", trend.alias("trend"), (4 * F.col("atoms") + 3 * F.col("weeks") + rise).alias("change_points"))
