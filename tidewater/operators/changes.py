"""Change of a subject against prior windows, counted in independent facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.cluster import evidence_atoms, independence
from tidewater.sources.scratch import written


def atom_changes(events: DataFrame, key: str, span: int, origin: str, priors: int = 3, min_atoms: int = 3, min_weeks: int = 2) -> DataFrame:
    """One row per window and key whose evidence may be promoted: how it changed against the windows before.

    Windows of ``span`` days follow one another from ``origin`` on; every one is
    compared with the ``priors`` before it, in one pass over the window number.
    ``events`` has ord, title, companies, event_type, source, source_family, topic
    and day; reports of one key and window are collapsed into atoms first, so that what is counted is
    facts and not their copies.  A key needs ``min_atoms`` atoms in ``min_weeks`` ISO weeks.

    Windows without any report do not enter the baseline, those without the key
    count as 0.  All reports of a window, also those without a key, are its
    coverage: beyond 0.8 to 1.25 of the mean before, the count is scaled by 0.75 to
    1.30.  Reports without a day are left out.
    """
    window = F.floor(F.datediff("day", F.lit(origin).cast("date")) / span).cast("int")
    rows = events.filter(F.col("day").isNotNull()).withColumns({"window": window, "key": F.col(key).cast("string")})
    later = F.explode(F.sequence(F.col("window") + 1, F.col("window") + priors)).alias("window")
    totals = rows.groupBy("window").agg(F.count("*").alias("total"))
    coverage = totals.select(later, "total").groupBy("window").agg(F.count("*").alias("windows"), F.avg("total").alias("mean_total"))

    keyed = rows.filter("key <> ''")
    columns = ["window", "key", "ord", "event_type", "companies", "source", "source_family", "topic", "day"]
    facts = written(keyed.select(*columns).join(evidence_atoms(keyed, [F.col("window"), F.col("key")]), "ord"), "window-facts")
    week = F.extract(F.lit("YEAROFWEEK"), "day") * 100 + F.weekofyear("day")
    weeks = facts.groupBy("window", "key").agg(F.countDistinct(week).alias("weeks"))
    stats = independence(facts, ["window", "key"]).join(weeks, ["window", "key"])
    before = stats.select("key", later, "atoms").groupBy("window", "key").agg(F.sum("atoms").alias("before"))
    current = stats.filter(F.col("promotable") & (F.col("atoms") >= min_atoms) & (F.col("weeks") >= min_weeks))
    current = current.join(before, ["window", "key"], "left").join(totals, "window").join(coverage, "window", "left")

    ratio = F.col("total") / F.col("mean_total")
    fix = F.when((ratio < 0.8) | (ratio > 1.25), F.least(F.greatest(F.col("mean_total") / F.col("total"), F.lit(0.75)), F.lit(1.30))).otherwise(1.0)
    known = F.coalesce("windows", F.lit(0)) > 0
    rated = current.withColumns({"baseline": F.when(known, F.coalesce("before", F.lit(0)) / F.col("windows")).otherwise(0.0), "coverage_ratio": F.when(known, ratio).otherwise(1.0), "correction": F.when(known, fix).otherwise(1.0)})
    rated = rated.withColumn("adjusted", F.col("atoms") * F.col("correction"))
    growth = F.col("adjusted") / F.nullif("baseline", F.lit(0.0))
    change = (
        F.when(~known, "new")
        .when((F.col("adjusted") >= F.col("baseline") + 2) & (F.coalesce(growth, F.lit(2.0)) >= 1.25), "rising")
        .when((F.col("adjusted") <= F.col("baseline") - 2) & (F.coalesce(growth, F.lit(0.0)) <= 0.75), "falling")
        .otherwise("steady")
    )
    rise = F.greatest(F.bround(F.col("adjusted") - F.col("baseline"), 0), F.lit(0.0))
    return rated.select("window", "key", "atoms", "weeks", "sources", "companies", "baseline", "coverage_ratio", "adjusted", change.alias("change"), (4 * F.col("atoms") + 3 * F.col("weeks") + rise).alias("change_score"))
