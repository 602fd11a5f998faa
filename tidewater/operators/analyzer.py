"""Pluggable enrichment of events in batches: the place for model calls.

An analyzer is any callable from a list of dicts to a list of dicts (or JSON
text, possibly fenced).  It runs inside tasks; an answer that fails or cannot be
read leaves its rows to the fallback (fail open) or drops them (fail closed).
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Analyzer = Callable[[list[dict]], "list[dict] | str"]
RESULT = "url string, summary_short string, reason string, impact string, score int"
_FIELDS = ("url", "summary_short", "reason", "impact", "score")


def recovered_json(text: str) -> list[dict]:
    """The list of objects in a model's answer: fences go, then the outermost brackets are read."""
    plain = re.sub(r"```[a-zA-Z]*", "", text or "")
    for part in (plain, *(m[0] for m in [re.search(r"\[.*\]", plain, re.S)] if m)):
        try:
            found = json.loads(part)
        except ValueError:
            continue
        found = [found] if isinstance(found, dict) else found
        if isinstance(found, list):
            return [x for x in found if isinstance(x, dict)]
    return []


def plain_analyzer(batch: list[dict]) -> list[dict]:
    """The deterministic default: a summary from the title, a reason from type and region."""
    return [
        {
            "url": r["url"],
            "summary_short": (r.get("title") or "")[:62],
            "reason": f"{r.get('company') or 'A company'}: {r.get('event_type') or 'other'} in {r.get('region') or 'the market'}",
            "impact": "unknown",
            "score": None,
        }
        for r in batch
    ]


def _answers(analyzer: Analyzer, batch: list[dict], attempts: int) -> list[dict]:
    for _ in range(attempts):
        try:
            got = analyzer(batch)
        except Exception:  # noqa: BLE001  whatever a provider raises counts as no answer
            continue
        rows = recovered_json(got) if isinstance(got, str) else got
        if rows:
            return rows
    return []


def analyze(events: DataFrame, analyzer: Analyzer, *, size: int = 8, attempts: int = 2, single_retry: bool = True) -> DataFrame:
    """(url, summary_short, reason, impact, score) of the events that got an answer.

    Only answers for urls of the batch count, the last one a url.  Rows without an
    answer are asked for once more by themselves.
    """
    asked = events.select("url", "title", "company", "event_type", "region")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = batch.to_pylist(), {}
            for at in range(0, len(rows), size):
                part = rows[at : at + size]
                urls = {r["url"] for r in part}
                mine = {r.get("url"): r for r in _answers(analyzer, part, attempts) if r.get("url") in urls}
                if single_retry:
                    for r in part:
                        if r["url"] not in mine:
                            mine |= {x.get("url"): x for x in _answers(analyzer, [r], 1) if x.get("url") == r["url"]}
                found |= mine
            types = [pa.string()] * 4 + [pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([_typed(r.get(f), f) for r in found.values()], t) for f, t in zip(_FIELDS, types, strict=True)], names=list(_FIELDS))

    return asked.mapInArrow(run, RESULT)


def _typed(value, field: str):
    if field != "score":
        return None if value is None else str(value)
    try:
        return None if value is None else int(value)
    except (TypeError, ValueError):
        return None


def enriched(events: DataFrame, answers: DataFrame) -> DataFrame:
    """Events with their analysis; where a field is missing the deterministic fallback stands in."""
    once = answers.groupBy("url").agg(F.max_by(F.struct("summary_short", "reason", "impact", "score"), F.length(F.coalesce("summary_short", F.lit("")))).alias("a"))
    fallback = analyze(events, plain_analyzer).groupBy("url").agg(F.first("summary_short").alias("f_summary"), F.first("reason").alias("f_reason"))
    rows = events.join(once, "url", "left").join(fallback, "url", "left")
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return rows.select(
        *events.columns,
        F.coalesce(blank(F.col("a.summary_short")), "f_summary").alias("summary_short"),
        F.coalesce(blank(F.col("a.reason")), "f_reason").alias("reason"),
        F.coalesce(blank(F.col("a.impact")), F.lit("unknown")).alias("impact"),
        F.when(F.col("a").isNull(), "fallback").otherwise("model").alias("analysis_source"),
    )


def judged(events: DataFrame, scores: DataFrame, least: int = 3) -> DataFrame:
    """'other' events judged below ``least`` go; those without a judgement stay (fail open)."""
    rows = events.join(scores.groupBy("url").agg(F.max("score").alias("judged")), "url", "left")
    return rows.filter((F.col("event_type") != "other") | (F.coalesce("judged", F.lit(least)) >= least)).drop("judged")


def upgraded(stored: DataFrame, incoming: DataFrame, fields: list[str], key: str = "url") -> DataFrame:
    """Cross-batch merge by key: a richer newcomer fills and overwrites, others leave the stored row.

    Richness is the number of non-blank ``fields``; new keys are appended and
    ``merged`` counts the reports of a row.
    """
    richness = sum((F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False)).cast("int") for c in fields), F.lit(0))

    def side(df: DataFrame, order: int) -> DataFrame:
        return df.select(key, F.struct(richness.alias("rich"), F.lit(-order).alias("first"), *(F.col(c) for c in fields)).alias("row"))

    both = side(stored, 0).unionByName(side(incoming, 1)).groupBy(key).agg(F.max("row").alias("best"), F.min("row").alias("rest"), F.count("*").alias("merged"))
    blank = lambda c: F.coalesce(F.trim(c.cast("string")) == "", F.lit(True))
    return both.select(key, *(F.when(blank(F.col(f"best.{c}")), F.col(f"rest.{c}")).otherwise(F.col(f"best.{c}")).alias(c) for c in fields), "merged")
