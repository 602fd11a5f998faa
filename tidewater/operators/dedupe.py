"""Order-sensitive removal of repeated reports: same-event, daily and display dedupe.

Each rule walks rows in input order and compares with what is already kept, so a
Python pass per block stays; Spark builds the blocks such that no match crosses
them, and shuffles by block.
"""

from __future__ import annotations

import datetime as dt
import math
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import event_rules, subjects
from tidewater.functions.event_rules import HARD_TYPES
from tidewater.functions.text import title_key
from tidewater.sources.scratch import written


def similarity(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a and b else 0.0


def same_event(a: dict, b: dict) -> bool:
    """The pair rule: equal url; else at most three days apart and alike enough for the type.

    Rows have url, type, entity, entity_source (company, alias, title), tokens,
    anchored (the title carries its type's anchor), loss (it tells of a decline)
    and day.  Unknown days count as near.  Reports of a hard type and one entity
    are one event if both are anchored and, for earnings, agree on the direction;
    then similarity counts only where an entity was read from a title, and where
    they do not agree they are two events however alike.  All other pairs need 0.72.
    """
    if a["url"] and a["url"] == b["url"]:
        return True
    if a["day"] is not None and b["day"] is not None and abs((a["day"] - b["day"]).days) > 3:
        return False
    alike = similarity(a["tokens"], b["tokens"])
    if a["type"] == b["type"] and a["entity"] and a["entity"] == b["entity"]:
        if a["type"] in HARD_TYPES:
            by_title = "title" in (a["entity_source"], b["entity_source"])
            agree = a["type"] != "earnings" or a["loss"] == b["loss"]
            return a["anchored"] and b["anchored"] and agree and (alike >= 0.4 or not by_title)
        if a["type"] == "strategy":
            return alike >= 0.42
    return alike >= 0.72


class Kept:
    """Rows by number, in which the first that tells of the same event as another is found without meeting all.

    By ``same_event`` two rows have one url, or near days and: one hard type and
    entity, both anchored; or tokens that are alike enough, which then share one of their
    rarest.  Rows are listed under those, so a row meets few others however many are kept.
    ``rows`` are those to come: their tokens say which are rare; any order gives the same rows.
    """

    def __init__(self, rows: Iterable[dict] = ()) -> None:
        self.rows: dict[int, dict] = {}
        self.often = Counter(t for r in rows for t in r["tokens"])
        self.lists: dict[tuple, list[int]] = {}
        self.days: Counter = Counter()

    def _rare(self, tokens: Iterable[str], least: float) -> list[str]:
        """The tokens of which one is shared with every set at least so similar."""
        ranked = sorted(tokens, key=lambda t: (self.often[t], t))
        return ranked[: len(ranked) - math.ceil(least * len(ranked) - 1e-9) + 1] if ranked else ranked

    def _marks(self, row: dict) -> Iterator[tuple[tuple, bool]]:
        """What a row is listed or looked for under; whether rows find it there that do not go by their title."""
        own = (row["type"], row["entity"])
        if row["entity"] and row["type"] in HARD_TYPES:
            if row["anchored"]:
                own = (*own, row["loss"] if row["type"] == "earnings" else None)
                yield own, row["entity_source"] != "title"
                for token in self._rare(row["tokens"], 0.4):
                    yield (*own, token), True
        elif row["entity"] and row["type"] == "strategy":
            for token in self._rare(row["tokens"], 0.42):
                yield (*own, token), True
        for token in self._rare(row["tokens"], 0.72):
            yield (token,), True

    def put(self, number: int, row: dict) -> None:
        if number in self.rows:
            self.drop(number)
        self.rows[number] = row
        self.days[row["day"]] += 1
        for key in self._places(row):
            insort(self.lists.setdefault(key, []), number)

    def drop(self, number: int) -> None:
        row = self.rows.pop(number)
        self.days[row["day"]] -= 1
        if not self.days[row["day"]]:
            del self.days[row["day"]]
        for key in self._places(row):
            held = self.lists[key]
            del held[bisect_left(held, number)]
            if not held:
                del self.lists[key]

    def _places(self, row: dict) -> Iterator[tuple]:
        if row["url"]:
            yield ("url", row["url"])
        for mark, named in self._marks(row):
            # A row that goes by its title is not one event with all of its entity.
            yield ("day", row["day"], mark if named else (*mark, "by title"))

    def first(self, row: dict) -> int | None:
        """The least number of a row that tells of the same event."""
        found = self.lists.get(("url", row["url"]), ()) if row["url"] else ()
        best = found[0] if found else None
        day = row["day"]
        near = self.days if day is None else [d for d in (None, *(day + dt.timedelta(n) for n in range(-3, 4))) if d in self.days]
        marks = [mark for mark, named in self._marks(row) if named]
        met: set[int] = set()
        for d in near:
            for mark in marks:
                for number in self.lists.get(("day", d, mark), ()):
                    if best is not None and number >= best:
                        break
                    if number not in met:
                        met.add(number)
                        if same_event(row, self.rows[number]):
                            best = number
        return best


def walk_day(rows: list[dict], most_per_company: int = 3) -> list[tuple[str, int | None]]:
    """(fate, ord of the kept row it repeats) per row in order: kept, alias, low_signal, repeat or cap.

    A company's row without its alias goes first, then its low-signal titles, then
    repeats of a kept row, then a company's rows beyond its cap.
    """
    kept = Kept(rows)
    per_company: dict[str, int] = {}
    fates: list[tuple[str, int | None]] = []
    for place, row in enumerate(rows):
        if row["alias_missing"]:
            fates.append(("alias", None))
        elif row["low_signal"]:
            fates.append(("low_signal", None))
        elif (twin := kept.first(row)) is not None:
            fates.append(("repeat", kept.rows[twin]["ord"]))
        elif row["capped"] and per_company.get(row["capped"], 0) >= most_per_company:
            fates.append(("cap", None))
        else:
            fates.append(("kept", None))
            kept.put(place, row)
            if row["capped"]:
                per_company[row["capped"]] = per_company.get(row["capped"], 0) + 1
    return fates


def walk_display(rows: list[dict]) -> list[tuple[str, int | None]]:
    """First of each title key; then hard types within three days (strategy on one day) of equal subject and Jaccard 0.3."""
    kept: list[dict] = []
    by_key: dict[str, int] = {}
    fates: list[tuple[str, int | None]] = []
    for row in rows:
        if row["key"] and row["key"] in by_key:
            fates.append(("repeat", by_key[row["key"]]))
            continue

        def near(k: dict, row: dict = row) -> bool:
            if row["type"] != k["type"] or not row["entity"] or row["entity"] != k["entity"]:
                return False
            if row["day"] is None or k["day"] is None:
                close = row["day"] is k["day"]
            else:
                close = abs((row["day"] - k["day"]).days) <= (3 if row["type"] in HARD_TYPES else 0)
            return close and row["type"] in (*HARD_TYPES, "strategy") and similarity(row["tokens"], k["tokens"]) >= 0.3

        twin = next((k for k in kept if near(k)), None)
        if twin:
            fates.append(("repeat", twin["ord"]))
            continue
        fates.append(("kept", None))
        kept.append(row)
        by_key.setdefault(row["key"], row["ord"])
    return fates


def _walk(rule: Callable[[list[dict]], list[tuple[str, int | None]]]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("ord", ignore_index=True)
        rows = block.to_dict("records")
        for r in rows:
            r["tokens"], r["day"] = set(r["tokens"]), None if pd.isna(r["day"]) else r["day"]
        fates = rule(rows)
        return pd.DataFrame({"ord": block["ord"], "fate": [f for f, _ in fates], "twin": pd.array([t for _, t in fates], dtype="Int64")})

    return run


def prepared(events: DataFrame, block: list[Column], aliases: Iterable[str] = (), display: bool = False) -> DataFrame:
    """The columns that the walks read, with a block key; every rule on one row is a column made here.

    ``aliases`` are looked for in titles of rows without a company.  ``display``
    takes the subject of the headline first.
    """
    title, company = F.coalesce("title", F.lit("")), F.coalesce("company", F.lit(""))
    own = F.coalesce("is_company", F.lit(False))
    # The subject and the plain title are columns of their own, so that their patterns are matched once.
    rows = events.withColumns({"plain": event_rules.plain_title(title), "subject": subjects.title_subject(title), "alias": event_rules.alias_in_title(title, aliases), "type": F.coalesce(F.try_element_at("event_types", F.lit(1)), F.lit("other")) if display else event_rules.primary_type(F.col("event_types"))})
    subject = (subjects.display_subject if display else subjects.event_subject)(F.col("company"), F.col("companies"), F.col("subject"))
    by_headline = F.struct(subject.alias("key"), F.lit("title").alias("source"))
    rows = rows.withColumn("found", by_headline if display else event_rules.entity_key(company, F.col("alias"), subject))
    return rows.select(
        *block,
        "ord",
        F.coalesce("url", F.lit("")).alias("url"),
        "type",
        F.col("found.key").alias("entity"),
        F.col("found.source").alias("entity_source"),
        event_rules.anchored(F.col("type"), title).alias("anchored"),
        subjects.reports_loss(title).alias("loss"),
        (own & ~event_rules.mentions_alias(title, F.array_compact(F.array_append(F.coalesce("aliases", F.array().cast("array<string>")), F.col("company"))))).alias("alias_missing"),
        (own & event_rules.low_signal_title(title)).alias("low_signal"),
        F.when(own, company).otherwise("").alias("capped"),
        event_rules.event_tokens(title, F.col("plain")).alias("tokens"),
        title_key(title).alias("key"),
        "day",
    )


def dedupe_daily(events: DataFrame, reach: list[str], aliases: Iterable[str] = ()) -> DataFrame:
    """(ord, fate, twin) of every row, day by day.

    ``reach`` names further columns that repeats never cross (a market, a language),
    which bounds a block at scale; the company cap counts inside a block.  The
    input has ord, url, title, event_types, company, companies, is_company, aliases
    (of its company) and day.
    """
    rows = prepared(events, [F.coalesce(F.col("day").cast("string"), F.lit("")).alias("block"), *(F.col(c).alias(f"reach_{c}") for c in reach)], aliases)
    return rows.groupBy("block", *(f"reach_{c}" for c in reach)).applyInPandas(_walk(walk_day), "ord long, fate string, twin long")


def dedupe_display(events: DataFrame) -> DataFrame:
    """(ord, fate, twin) of every row: title repeats first, then repeats of one subject.

    The first row of each title is found by aggregation; the second rule only
    joins rows of one type and subject, which are the blocks.
    """
    # Written, as three branches read it: subjects are found once, and no filter repeats their patterns.
    rows = written(prepared(events, [], display=True), "reports")
    firsts = rows.filter("key <> ''").groupBy("key").agg(F.min("ord").alias("first_ord"))
    rows = rows.join(firsts, "key", "left")
    is_repeat = F.coalesce(F.col("first_ord") < F.col("ord"), F.lit(False))
    by_subject = (F.col("entity") != "") & F.col("type").isin(*HARD_TYPES, "strategy")
    schema = "ord long, fate string, twin long"
    # A row that no later rule reads is a block of its own only in name: it is decided in place.
    decided = rows.filter(is_repeat | ~by_subject).select("ord", F.when(is_repeat, "repeat").otherwise("kept").alias("fate"), F.when(is_repeat, F.col("first_ord")).alias("twin"))
    walked = rows.filter(~is_repeat & by_subject).drop("first_ord").groupBy("type", "entity").applyInPandas(_walk(walk_display), schema)
    return decided.unionByName(walked)
