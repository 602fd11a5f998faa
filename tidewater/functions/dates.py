"""Date functions over columns: strict parsing, dates in URLs and text, windows.

There is no "now" in here: whatever depends on the current day takes ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def strict_date(text: Column) -> Column:
    """The first ten characters as yyyy-mm-dd, or null."""
    head = F.substring(text, 1, 10)
    return F.when(head.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.to_date(F.try_to_timestamp(head, F.lit("yyyy-MM-dd"))))


def _from_parts(year: Column, month: Column, day: Column) -> Column:
    return strict_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")))


def date_in_url(url: Column) -> Column:
    """A date in a URL: /2024/01/31/, 2024-01-31 or 20240131, in this order."""
    found = []
    for pattern in ("/(20[0-9]{2})/([0-9]{1,2})/([0-9]{1,2})(?:/|$)", "(20[0-9]{2})-([0-9]{2})-([0-9]{2})", "[^0-9](20[0-9]{2})([0-9]{2})([0-9]{2})(?:[^0-9]|$)"):
        parts = [F.regexp_extract(url, pattern, i) for i in (1, 2, 3)]
        found.append(F.when(url.rlike(pattern), _from_parts(*parts)))
    return F.coalesce(*found)


def date_in_text(text: Column) -> Column:
    """An ISO date, 'Month d, yyyy' or 'd Month yyyy' in a text, in this order."""
    iso = "(20[0-9]{2})-([0-9]{1,2})-([0-9]{1,2})"
    names = "(" + "|".join(_MONTHS) + ")[a-z]*"
    month_first, day_first = f"(?i){names}\\.? ([0-9]{{1,2}}),? (20[0-9]{{2}})", f"(?i)([0-9]{{1,2}}) {names}\\.?,? (20[0-9]{{2}})"

    def month(name: Column) -> Column:
        return F.array_position(F.array(*map(F.lit, _MONTHS)), F.lower(name)).cast("string")

    def part(pattern: str, i: int) -> Column:
        return F.regexp_extract(text, pattern, i)

    return F.coalesce(
        F.when(text.rlike(iso), _from_parts(part(iso, 1), part(iso, 2), part(iso, 3))),
        F.when(text.rlike(month_first), _from_parts(part(month_first, 3), month(part(month_first, 1)), part(month_first, 2))),
        F.when(text.rlike(day_first), _from_parts(part(day_first, 3), month(part(day_first, 2)), part(day_first, 1))),
    )


def publication(published: Column, observed: Column, slack_hours: int = 24) -> Column:
    """struct(published_at, scheduled_at, bucket, basis): times later than observed plus the slack are scheduled."""
    future = published > observed + F.expr(f"interval {slack_hours} hours")
    kept = F.when(~F.coalesce(future, F.lit(False)), published)
    return F.struct(
        kept.alias("published_at"),
        F.when(future, published).alias("scheduled_at"),
        F.to_date(F.coalesce(kept, observed)).alias("bucket"),
        F.when(kept.isNotNull(), "published_at").otherwise("observed_at").alias("basis"),
    )


def iso_week(day: Column) -> Column:
    """'YYYY-Www' of the ISO calendar."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def is_recent(day: Column, as_of: Column, days: int = 2) -> Column:
    """Unknown days count as recent."""
    return F.coalesce(day >= F.date_sub(as_of, days), F.lit(True))


def close(a: Column, b: Column, days: int, unknown: bool) -> Column:
    """Whether two days lie at most ``days`` apart; ``unknown`` if either is null."""
    return F.coalesce(F.abs(F.datediff(a, b)) <= days, F.lit(unknown))


def day_spine(frame: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last`` (column names of a one-row frame)."""
    return frame.select(F.explode(F.sequence(F.col(first), F.col(last), F.expr("interval 1 day"))).alias("day"))
