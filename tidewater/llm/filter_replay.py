"""Interaction of quality filters: every order of them is replayed over every document.

Each document is reduced to the filters that it fails, one bit a filter.  The
flags are crossed with all orders of the filters (120 broadcast rows for five),
the document's first failure in each order is computed, the order's steps are
exploded, and one conditional aggregation counts what each step keeps, removes
and finds already removed.  Counts are combined in the tasks that replay, so
what is shuffled is one row per task, part, order and step.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.store import written

_SPACE = r"[\x20\x09-\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_filters(text: Column, *, least_words: int = 200, distinct_percent: int = 50, capital_percent: int = 3, marks: str = "#$%&*|") -> dict[str, Column]:
    """Failure conditions A to D of a text that is not null; words are runs of anything but ASCII white space."""
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", ""))
    return {
        "A": n < least_words,
        "B": 100 * F.size(F.array_distinct(words)) < distinct_percent * n,
        "C": 100 * capitals > capital_percent * F.length(text),
        "D": F.length(F.translate(text, marks, "")) < F.length(text),
    }


def _orders(df: DataFrame, letters: str) -> DataFrame:
    """All orders of the letters: name, and the bit of the filter at each step."""
    rows = [("".join(p), [1 << letters.index(x) for x in p]) for p in permutations(letters)]
    return df.sparkSession.createDataFrame(rows, "filter_order string, bits array<int>")


def replay(flags: DataFrame, letters: str) -> DataFrame:
    """Counts for every part, order of ``letters`` and step: filter, step and the columns of ``COUNTS``, and shapley.

    ``flags`` has part, fails (an int, bit k for filter ``letters[k]``), good and
    toxic (boolean).  shapley is what the step's filter removes, summed over all
    orders.  At most eight filters, whose 40,320 orders are still broadcast.
    """
    if len(letters) > 8:
        raise ValueError("at most eight filters are replayed in all orders")
    steps = range(1, len(letters) + 1)
    crossed = flags.crossJoin(F.broadcast(_orders(flags, letters)))
    fails = lambda bit: F.col("fails").bitwiseAND(bit) != 0
    first = F.least(*(F.when(fails(F.element_at("bits", k)), k).otherwise(len(letters) + 1) for k in steps))
    replayed = crossed.withColumn("first", first).select("part", "filter_order", "fails", "good", "toxic", "first", F.posexplode("bits").alias("at", "bit"))
    replayed = replayed.withColumn("step", F.col("at") + 1)
    count = lambda held: F.count(F.when(held, 1))
    removed = F.col("first") == F.col("step")
    counted = replayed.groupBy("part", "filter_order", "step").agg(
        count(F.col("first") > F.col("step")).alias("kept"),
        count(removed).alias("removed"),
        count((F.col("first") < F.col("step")) & fails(F.col("bit"))).alias("redundant"),
        count(F.col("fails") == F.col("bit")).alias("unique_fails"),
        count(removed & F.col("good")).alias("good_lost"),
        count(removed & F.col("toxic")).alias("toxic_lost"),
    )
    counted = counted.withColumn("filter", F.expr("substring(filter_order, step, 1)"))
    # One row per part, order and step: 600 rows a part for five filters.
    return counted.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter")))


def filter_interactions(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", **limits
) -> DataFrame:
    """Counts for every part, order of the filters A to E and step (see ``replay``).

    A to D are ``text_filters`` of the whole text (null: empty); E fails rows
    whose text some row of a smaller id has, wherever that row is removed.  Rows
    with a null id are neither copies nor originals of any; repeated rows count
    each, and of two rows with one id neither is the other's copy.  Texts are
    equal when their SHA-256 and length are.  A null part is the empty
    string.  A row is good or toxic if any label row of its id says 1; null and
    missing labels say nothing.  An empty table gives an empty result.  Other
    columns, whatever their names, are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("content"))
    conditions = text_filters(F.col("content"), **limits)
    letters = "".join(conditions) + "E"
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(conditions.values())), F.lit(0))
    # Whole texts are read once; what is written is some fifty bytes a document.
    skinny = written(rows.select("id", "part", mask.alias("mask"), F.unhex(F.sha2("content", 256)).alias("digest"), F.octet_length("content").alias("size")), "flags")
    # Both small sides are written, so that Spark knows their sizes and may split a skewed text or id.
    firsts = skinny.filter("id is not null").groupBy("digest", "size").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    firsts = written(firsts.filter("first_id < last_id").select("digest", "size", "first_id"), "first-ids")
    mark = lambda c: F.max(F.coalesce(F.col(c).cast("int") == 1, F.lit(False)))
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(mark("quality").alias("good"), mark("toxic").alias("toxic"))
    marks = written(marks.filter("good or toxic"), "marks")
    flags = skinny.join(firsts, ["digest", "size"], "left").join(marks, "id", "left")
    copy = F.coalesce(F.col("id") > F.col("first_id"), F.lit(False))
    flags = flags.select(
        "part",
        F.when(copy, F.col("mask") + (1 << len(conditions))).otherwise(F.col("mask")).alias("fails"),
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )
    return replay(flags, letters).select("part", "filter_order", "step", *COUNTS, "shapley")
