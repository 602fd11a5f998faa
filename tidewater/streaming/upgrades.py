"""Reports merged across batches: a richer one replaces what is stored, days later if need be.

State is keyed by what a report is about and holds the list of its stored reports, which is read and
written once a trigger.  Of those that tell of the same event as a new report the first by number is
upgraded if the newcomer is richer, and in any case counts it.
The batch form walks the same reports at once and ends with the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewater.operators.dedupe import Kept, prepared

#: What a richer report brings along; the day of the stored one stays.
SHOWN = ("title", "url", "overview", "summary", "reason", "impact", "label", "topic")
_RULE = "type string, entity string, entity_source string, anchored boolean, loss boolean, tokens array<string>, day date"
_STORED = f"ord long, {', '.join(f'{c} string' for c in SHOWN)}, {_RULE}, richness int, merged array<string>, reports int, upgrades int, seen long"
_NAMES = [c.split()[0] for c in _STORED.split(", ")]
MERGED = f"reach string, ord long, {', '.join(f'{c} string' for c in SHOWN)}, day date, richness int, merged array<string>, reports int, upgrades int"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def reports(events: DataFrame, aliases: tuple[str, ...] = ()) -> DataFrame:
    """Events with what the merge reads: the columns of the pair rule, richness, and reach.

    ``events`` has what ``dedupe.prepared`` reads, the texts of ``SHOWN`` and ``seen``, the time of
    arrival.  Reports merge within one reach only: type and entity, or the address where there is no
    entity.  Richness is two for each token of the title, one for every twenty characters
    of the overview and one for a summary, a reason and a label.
    """
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SHOWN}
    ruled = prepared(events, [F.col("seen"), *(v.alias(f"_{c}") for c, v in texts.items())], aliases).drop("url")
    given = sum((F.when(F.col(f"_{c}") != "", 1).otherwise(0) for c in ("summary", "reason", "label")), F.lit(0))
    richness = (2 * F.size("tokens") + F.floor(F.length("_overview") / 20) + given).cast("int")
    reach = F.when(F.col("entity") != "", F.concat_ws("|", "type", "entity")).otherwise(F.concat(F.lit("url|"), "_url"))
    return ruled.select(reach.alias("reach"), "ord", "seen", *(F.col(f"_{c}").alias(c) for c in SHOWN), "type", "entity", "entity_source", "anchored", "loss", "tokens", "day", richness.alias("richness"))


def absorb(stored: Kept, row: dict) -> int:
    """Merge one report into the stored ones; returns the number of the one that changed."""
    row = {**row, "tokens": set(row["tokens"])}
    twin = stored.first(row)
    if twin is None:
        stored.put(row["ord"], {**{k: v for k, v in row.items() if k not in ("ord", "reach")}, "merged": [], "reports": 1, "upgrades": 0})
        return row["ord"]
    old = stored.rows[twin]
    if row["richness"] <= old["richness"]:
        old |= {"reports": old["reports"] + 1, "seen": max(old["seen"], row["seen"])}
        return twin
    # What the newcomer leaves blank stays; the pair rule reads the new title from now on.
    new = {**old, "reports": old["reports"] + 1, "seen": max(old["seen"], row["seen"]), "upgrades": old["upgrades"] + 1}
    new |= {c: row[c] for c in SHOWN if row[c]} | {c: row[c] for c in ("tokens", "anchored", "loss", "richness")}
    if row["url"] and row["url"] not in old["merged"]:
        new["merged"] = [*old["merged"], row["url"]]
    stored.put(twin, new)
    return twin


def _shown(reach: str, number: int, row: dict) -> dict:
    return {"reach": reach, "ord": number, **{c: row[c] for c in SHOWN}, "day": row["day"], **{c: row[c] for c in ("richness", "merged", "reports", "upgrades")}}


class Upgrades(StatefulProcessor):
    """Stored reports of one reach; each is forgotten ``keep_ms`` after its last report was seen, by the watermark.

    A reach with stored reports always has a timer that is not later than its first expiry; it drops
    all that have expired and sets the next, so timers are counted in reaches and not in reports.
    """

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stored = handle.getListState("stored", _STORED)

    def _all(self) -> dict[int, dict]:
        rows = (dict(zip(_NAMES, value, strict=True)) for value in self.stored.get())
        return {row.pop("ord"): {**row, "tokens": set(row["tokens"]), "merged": list(row["merged"])} for row in rows}

    def _keep(self, stored: dict[int, dict]) -> None:
        if stored:
            self.stored.put([(number, *([*row[c]] if c in ("tokens", "merged") else row[c] for c in _NAMES[1:])) for number, row in stored.items()])
        else:
            self.stored.clear()

    def _expiry(self, stored: dict[int, dict]) -> int | None:
        return min((row["seen"] for row in stored.values()), default=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        before, changed = self._all(), {}
        first = self._expiry(before)
        # All rows of a trigger in order of arrival, however many batches they come in.
        news = sorted((r.asDict() for r in rows), key=lambda r: (r["seen"], r["ord"]))
        stored = Kept([*before.values(), *news])
        for number, row in before.items():
            stored.put(number, row)
        for row in news:
            row["seen"] = int(row["seen"].timestamp() * 1000)
            changed[absorb(stored, row)] = None
        self._keep(stored.rows)
        now = self._expiry(stored.rows)
        if first is None or now < first:
            self.handle.registerTimer(now + self.keep_ms)
        for number in changed:
            yield Row(**_shown(key[0], number, stored.rows[number]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        watermark, stored = timerValues.getCurrentWatermarkInMs(), self._all()
        left = {number: row for number, row in stored.items() if row["seen"] + self.keep_ms > watermark}
        if len(left) < len(stored):
            self._keep(left)
        if left:
            self.handle.registerTimer(self._expiry(left) + self.keep_ms)
        yield from ()

    def close(self) -> None:
        pass


def merged_stream(stream: DataFrame, late: str = "1 day", keep_days: int = 7) -> DataFrame:
    """The stored reports that a trigger made or changed.

    ``stream`` comes from ``reports``.  State is one list a reach; what was last seen
    ``keep_days`` before the watermark is dropped by timers, so state does not grow
    with the history.
    """
    watched = stream.withWatermark("seen", late)
    return watched.groupBy("reach").transformWithState(Upgrades(keep_days * 86_400_000), MERGED, "Update", "EventTime")


def run_merge(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None, **options: int) -> None:
    """Process all that is there into ``path/batch=n``; a restart goes on from the checkpoint.

    The state has ``partitions`` parts from the first run on: by default one a core, as every part costs
    each batch a store and a Python process, whether it has rows or not.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    parts = partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # Lists and timers need this store.
    wanted = {"spark.sql.streaming.stateStore.providerClass": _ROCKS, "spark.sql.shuffle.partitions": str(parts)}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        query = merged_stream(stream, **options).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def newest(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every stored report, of all batches of ``run_merge``."""
    rows = spark.read.parquet(path)
    columns = [c.split()[0] for c in MERGED.split(", ")]
    return rows.groupBy("reach", "ord").agg(F.max_by(F.struct(*columns), "batch").alias("row")).select("row.*")


def merged_batch(rows: DataFrame) -> DataFrame:
    """The same merge over all reports at once; nothing is forgotten."""

    def walk(block: pd.DataFrame) -> pd.DataFrame:
        rows = block.sort_values(["seen", "ord"]).to_dict("records")
        stored = Kept(rows)
        for row in rows:
            row["seen"], row["day"] = int(row["seen"].timestamp() * 1000), None if pd.isna(row["day"]) else row["day"]
            absorb(stored, row)
        return pd.DataFrame([_shown(block["reach"].iloc[0], k, v) for k, v in stored.rows.items()])

    return rows.groupBy("reach").applyInPandas(walk, MERGED)
