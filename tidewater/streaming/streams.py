"""Structured Streaming forms: late and repeated events, windows, and the candidate machine."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
CANDIDATE = "user_id bigint, first_seen timestamp, last_seen timestamp, refs bigint, status string"


def event_stream(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of a folder (or a glob of files) as a stream, a few files a batch; times count as UTC."""
    stored = EVENTS.replace("ts timestamp", "ts timestamp_ntz")
    return spark.readStream.schema(stored).option("maxFilesPerTrigger", files_per_batch).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def deduplicated(stream: DataFrame, key: str = "event_id", time: str = "ts", late: str = "2 days") -> DataFrame:
    """First arrival of each key; rows later than the watermark are dropped, and so is their state."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def tumbling(stream: DataFrame, time: str = "ts", length: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts and sums per event type and window."""
    return (
        stream.withWatermark(time, late)
        .groupBy(F.window(time, length).alias("w"), "event_type")
        .agg(F.count("*").alias("events"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))
        .select(F.col("w.start").alias("starts"), "event_type", "events", "total")
    )


def rolling(stream: DataFrame, time: str = "ts", length: str = "7 days", step: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts per event type over windows of ``length`` that begin every ``step``."""
    grouped = stream.withWatermark(time, late).groupBy(F.window(time, length, step).alias("w"), "event_type")
    return grouped.agg(F.count("*").alias("events")).select(F.col("w.start").alias("starts"), "event_type", "events")


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    first, last, refs, bought, promoted = state.get if state.exists else (None, None, 0, 0, False)
    # A key's rows of a trigger may come in several batches; they are put in order together.
    for ts, kind in sorted(row for batch in batches for row in zip(batch["ts"], batch["event_type"], strict=True)):
        if promoted:  # a promoted candidate never changes
            break
        first, last, refs = first or ts, ts if last is None or ts > last else last, refs + 1
        bought += kind == "purchase"
        promoted = bought >= 5
    state.update((first, last, refs, bought, promoted))
    yield pd.DataFrame({"user_id": [key[0]], "first_seen": [first], "last_seen": [last], "refs": [refs], "status": ["promoted" if promoted else "accumulating"]})


def candidates(stream: DataFrame) -> DataFrame:
    """The candidate of each user after every batch: accumulating until the fifth purchase, then promoted.

    State is five values a key; batches are applied in time order within a
    trigger.  Promoted is terminal, so replays and late rows do not change it.
    """
    state = "first timestamp, last timestamp, refs bigint, bought bigint, promoted boolean"
    return stream.select("user_id", "ts", "event_type").groupBy("user_id").applyInPandasWithState(_advance, CANDIDATE, state, "update", GroupStateTimeout.NoTimeout)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process all that is there and stop; a restart goes on from the checkpoint."""
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    else:

        def put(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

        query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
