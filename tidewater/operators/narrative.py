"""Narratives from clusters, and the company cards and panels around them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pick_coherent(clusters: list[dict], limit: int = 3) -> list[int]:
    """Places of up to ``limit`` clusters in order: no company twice, and each shares the first one's region or theme."""
    kept: list[int] = []
    used: set = set()
    for i, c in enumerate(clusters):
        companies = set(c["names"])
        if companies & used:
            continue
        if kept and c["region"] != clusters[kept[0]]["region"] and c["theme"] != clusters[kept[0]]["theme"]:
            continue
        kept.append(i)
        used |= companies
        if len(kept) == limit:
            break
    return kept


def _narrate(limit: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place", ignore_index=True)
        kept = pick_coherent(block.to_dict("records"), limit)
        some = block.iloc[kept]
        covered = some["evidence"].sum() >= 0.5 * block["evidence"].head(limit).sum()
        kind = "narrative" if len(some) >= 2 and covered else "daily_brief"
        return pd.DataFrame({"period": [block["period"][0]], "kind": [kind], "clusters": [len(some)], "evidence": [int(some["evidence"].sum())], "regions": ["|".join(sorted(set(some["region"].dropna())))], "lead": [int(some["place"].iloc[0]) if len(some) else -1]})

    return run


def narratives(clusters: DataFrame, most: int = 50, limit: int = 3) -> DataFrame:
    """One row per period from its best ``most`` clusters: kind, clusters, evidence, regions, lead.

    ``clusters`` has period, place (1 is best), region, theme, names and evidence.
    Only the best clusters can be told, so the walk over them is bounded by ``most``.
    """
    best = clusters.filter(F.col("place") <= most).select("period", "place", "region", "theme", F.coalesce("names", F.array().cast("array<string>")).alias("names"), "evidence")
    return best.groupBy("period").applyInPandas(_narrate(limit), "period string, kind string, clusters long, evidence long, regions string, lead long")


def ranked_clusters(rows: DataFrame) -> DataFrame:
    """Clusters of each ISO week by (region, event type), ranked by size and score; input of ``narratives``."""
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), "day").cast("string"), F.lit("-W"), F.lpad(F.weekofyear("day").cast("string"), 2, "0"))
    # Relevance is asked inside the aggregations: a filter by it would be pushed down with copies of the match.
    rows = rows.filter("event_type <> 'other'").select(week.alias("period"), "region", F.col("event_type").alias("theme"), "score", "company", (F.col("relevance") >= 2).alias("told"))
    keys = ["period", "region", "theme"]
    grouped = rows.groupBy(*keys).agg(F.count_if("told").alias("evidence"), F.sum(F.when(F.col("told"), F.col("score"))).alias("points")).filter("evidence > 0")
    # The first two names of a cluster, without a set of all.
    once = rows.filter("company is not null").groupBy(*keys, "company").agg(F.count_if("told").alias("n")).filter("n > 0")
    once = once.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("company"))).filter("nth <= 2")
    names = once.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.array_sort(F.collect_list("company")).alias("names"))
    grouped = grouped.join(names, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
    order = Window.partitionBy("period").orderBy(F.col("evidence").desc(), F.col("points").desc(), "region", "theme")
    return grouped.withColumn("place", F.row_number().over(order))


def company_cards(rows: DataFrame, as_of: str) -> DataFrame:
    """Per company: events of 7 and 30 days, the last day, and a status; quiet companies keep a card."""
    age = F.datediff(F.lit(as_of).cast("date"), F.col("day"))
    cards = rows.filter(F.col("company").isNotNull() & (age >= 0)).groupBy("company").agg(
        F.count_if(age < 7).alias("week"), F.count_if(age < 30).alias("month"), F.max("day").alias("last_day"), F.max_by("ord", F.struct(-age, F.col("score"), -F.col("ord"))).alias("latest")
    )
    status = F.when(F.col("week") >= 3, "busy").when(F.col("week") > 0, "active").when(F.col("month") > 0, "watched").otherwise("quiet")
    return cards.withColumn("card_status", status)


def weight_report(rows: DataFrame, weights: dict[str, dict[str, float]], parts: list[str], top: int = 15) -> DataFrame:
    """Per weight configuration: mean, median, and how many of its top rows the first configuration shares.

    A row's score is the weighted sum of its parts; ties go to the earlier row.
    """
    totals = [F.struct(F.lit(name).alias("config"), sum((F.col(p) * w.get(p, 1.0) for p in parts), F.lit(0.0)).alias("total")) for name, w in weights.items()]
    every = rows.select("ord", F.explode(F.array(*totals)).alias("x")).select("ord", "x.config", "x.total")
    stats = every.groupBy("config").agg(F.round(F.avg("total"), 6).alias("mean"), F.percentile("total", 0.5).alias("median"), F.count("*").alias("rows"))
    best = every.withColumn("nth", F.row_number().over(Window.partitionBy("config").orderBy(F.col("total").desc(), "ord"))).filter(F.col("nth") <= top)
    first = next(iter(weights))
    base = best.filter(F.col("config") == first).select("ord")
    shared = best.join(base, "ord", "left_semi").groupBy("config").agg(F.count("*").alias("shared"))
    return stats.join(shared, "config", "left").fillna(0, ["shared"])
