"""Queries that run the streaming forms over the events table until it is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.plans.headlines import headlines
from tidewater.sources.readers import page_anchors
from tidewater.sources.fixtures import table
from tidewater.sources.scratch import new_folder
from tidewater.streaming import streams, upgrades


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table may be a folder or one file; a file is named by a glob, as streams read folders."""
    return streams.event_stream(spark, f"{sf_dir}/events.parque[t]")


def stream_late_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "deduplicated")
    streams.run_to_table(streams.deduplicated(_events(spark, sf_dir)), out, out + "-checkpoint")
    return spark.read.parquet(out).groupBy("event_type").agg(F.count("*").alias("events"), F.countDistinct("event_id").alias("ids"))


def _newest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last row of each key over all batches of an update-mode stream."""
    rows = spark.read.parquet(path)
    columns = [c for c in rows.columns if c != "batch"]
    return rows.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.max_by(F.struct(*columns), "batch").alias("row")).select("row.*")


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "windows")
    streams.run_to_table(streams.tumbling(_events(spark, sf_dir)), out, out + "-checkpoint", "update")
    return _newest(spark, out, ["starts", "event_type"]).select(F.date_format("starts", "yyyy-MM-dd").alias("day"), "event_type", "events", "total")


def stream_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per type over seven days, for windows that begin on each day."""
    out = new_folder(spark, "rolling")
    streams.run_to_table(streams.rolling(_events(spark, sf_dir)), out, out + "-checkpoint", "update")
    return _newest(spark, out, ["starts", "event_type"]).select(F.date_format("starts", "yyyy-MM-dd").alias("day"), "event_type", "events")


def stream_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of each candidate after the stream."""
    out = new_folder(spark, "candidates")
    streams.run_to_table(streams.candidates(_events(spark, sf_dir)), out, out + "-checkpoint", "update")
    newest = F.row_number().over(Window.partitionBy("user_id").orderBy(F.col("batch").desc()))
    return spark.read.parquet(out).withColumn("nth", newest).filter("nth = 1").select("user_id", "refs", "status")


def stream_upgrades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headlines of all companies as reports that arrive in four batches: what is stored in the end."""
    k, rows = F.col("ord"), headlines(spark, sf_dir)
    texts = {"overview": F.when(k % 3 == 1, F.col("body")), "summary": F.when(k % 4 == 0, F.col("topic")), "reason": F.when(k % 7 == 0, F.col("direction")), "impact": F.lit(""), "label": F.col("role"), "topic": F.col("topic")}
    rows = rows.withColumns({**texts, "event_types": F.array("event_type"), "companies": F.lit(None).cast("array<string>"), "is_company": F.lit(False), "aliases": F.lit(None).cast("array<string>"), "seen": F.col("day").cast("timestamp")})
    made, source, out = new_folder(spark, "reports"), new_folder(spark, "arrivals"), new_folder(spark, "upgrades")
    # Arrival follows the day, in quarters of the rows; each quarter is a batch of files of its own.
    quarter = F.ntile(4).over(Window.orderBy("day"))
    days = rows.groupBy("day").agg(F.count("*").alias("n")).withColumn("part", quarter).select("day", "part")  # one row a day
    upgrades.reports(rows).join(F.broadcast(days), "day").write.partitionBy("part").parquet(made)
    stored = spark.read.parquet(made).drop("part")
    for part in range(1, 5):
        spark.read.schema(stored.schema).parquet(f"{made}/part={part}").write.mode("append").parquet(source)
        upgrades.run_merge(spark, spark.readStream.schema(stored.schema).parquet(source), out, out + "-checkpoint", keep_days=14)
    return upgrades.newest(spark, out).select("ord", "title", "richness", "reports", "upgrades", F.size("merged").alias("merged"))


def page_anchor_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_anchors(table(spark, sf_dir, "pages"))


SQL = {
    "stream_late_dedupe": "select event_type, count(*) as events, count(distinct event_id) as ids from events group by event_type",
    "stream_tumbling": """
select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as events, cast(sum(cast(value as decimal(18,4))) as double) as total from events group by 1, 2""",
    "stream_rolling": """
select strftime(ts - to_days(cast(back as integer)), '%Y-%m-%d') as day, event_type, count(*) as events from events, range(7) as r(back) group by 1, 2""",
    "stream_candidates": """
with o as (select user_id, event_type, row_number() over (partition by user_id order by ts, event_type) as k, sum(cast(event_type = 'purchase' as integer)) over (partition by user_id order by ts, event_type rows between unbounded preceding and current row) as bought from events),
kept as (select *, bought - cast(event_type = 'purchase' as integer) as before from o)
select user_id, count(*) as refs, case when max(bought) >= 5 then 'promoted' else 'accumulating' end as status from kept where before < 5 group by user_id""",
}
QUERIES = {name: globals()[name] for name in [*SQL, "page_anchor_extract", "stream_upgrades"]}
