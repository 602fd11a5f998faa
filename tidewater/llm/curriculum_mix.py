"""Mixing sources to target weights along a time-varying curriculum.

Targets come from water-filling: sources share the budget by weight, none above
``max_repeat`` times its size.  The weight of a source over training time t in
[0, 1] is ``target * (1 + slope * (2 t - 1))``; its integral is the cumulative
token demand ``target * ((1 - slope) t + slope t**2)``.  A document's offset in
its source's (hash-ordered, repeatable) stream is put into the inverse of that
demand, which gives its training position; documents are range-sorted by it.

Only DataFrame functions run: the stream offsets are two-level prefix sums over
(source, slice of the hash order), so a hot source is spread over all slices.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.store import written

WEIGHTS = (3, 1, 2)
SLOPES = (0.5, 0.0, -0.5)
BUDGET = 1.5
MAX_REPEAT = 2
#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets of ``(source, source_size)``: adds place, weight, slope and target.

    Sorted by size/weight, the capped sources are a prefix, so the repeated
    resharing of what capped sources leave is one pass of running sums.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1

    def cycle(values: tuple) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (F.col("place") % len(values) + 1).cast("int"))

    named = sizes.withColumn("place", place).withColumns({"weight": cycle(WEIGHTS), "slope": cycle(SLOPES)})
    order = (F.col("source_size") / F.col("weight"), F.col("place"))
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    cap = F.col("source_size") * MAX_REPEAT
    level = (F.lit(BUDGET) * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("weight").over(onward)
    filled = named.withColumns({"level": level, "cap": cap}).withColumn("free", F.col("level") * F.col("weight") < F.col("cap"))
    # The level only falls after the first free source, so the greatest free level is the final one.
    settled = F.max(F.when(F.col("free"), F.col("level"))).over(everything)
    target = F.when(F.col("free"), settled * F.col("weight")).otherwise(F.col("cap")).cast("double")
    return filled.withColumn("target", target).select("source", "source_size", "place", "weight", "slope", "target")


def position(offset: Column, target: Column, slope: Column) -> Column:
    """Training time at which the cumulative demand of a source reaches ``offset``."""
    share = offset / target
    rest = F.lit(1.0) - slope
    curved = (F.sqrt(rest * rest + F.lit(4.0) * slope * share) - rest) / (F.lit(2.0) * slope)
    return F.when(slope == 0.0, share).otherwise(curved)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, slice_rows: int = 4000, with_source: bool = False) -> DataFrame:
    """One row per input row, range-sorted by training position.

    Columns: id, size, source_size, target, taken, position (first use) and
    again (second use).  A source's documents form a stream ordered by
    md5(id), id, size; ``taken`` counts the words of a document in the first
    ``round(target)`` words of that stream read up to twice, so the taken words
    of a source sum to its rounded target.  Documents that are not reached have
    taken 0 and a null position.  Null and empty texts have size 0; the null
    source is a source of its own, last in order; repeated rows are separate
    entries of the stream; an empty table gives an empty result.
    ``with_source`` adds the source column.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = written(rows.withColumn("hash", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))), "sizes")
    digits = max(1, math.ceil(math.log(max(1, rows.count()) / slice_rows, 16))) if slice_rows else 1
    rows = rows.withColumns({"source_key": F.struct("source"), "slice": F.substring("hash", 1, digits)})

    totals = rows.groupBy("source_key", "slice").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = totals.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    sources = source_targets(totals.groupBy("source_key").agg(F.sum("words").alias("source_size")).select(F.col("source_key.source").alias("source"), "source_size"))
    sources = sources.withColumn("source_key", F.struct("source")).drop("source", "place", "weight")
    slices = slices.join(sources, "source_key").drop("words")

    inside = Window.partitionBy("source_key", "slice").orderBy("hash", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("run", F.sum("size").over(inside)).join(slices, ["source_key", "slice"])
    start = F.col("ahead") + F.col("run") - F.col("size")
    quota = F.round("target").cast("long")
    once = F.least(F.col("size"), F.greatest(F.lit(0), quota - F.col("start")))
    twice = F.least(F.col("size"), F.greatest(F.lit(0), quota - F.col("source_size") - F.col("start")))
    placed = placed.withColumn("start", start).withColumns({"once": once, "twice": twice})
    out = placed.select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("once") + F.col("twice")).alias("taken"),
        F.when(F.col("once") > 0, position(F.col("start"), F.col("target"), F.col("slope"))).alias("position"),
        F.when(F.col("twice") > 0, position(F.col("start") + F.col("source_size"), F.col("target"), F.col("slope"))).alias("again"),
        *([F.col("source_key.source").alias("source")] if with_source else []),
    )
    return out.orderBy(F.col("position").asc_nulls_last(), id_col)


def draw_mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` once for each use that the mix makes of them, range-sorted by position.

    A use counts if it takes at least half of the document's words, so that
    documents stay whole and each source ends within half a document of its
    target.  Documents without words carry no weight in the mix and are kept
    once, at the start.  Repeated rows are matched by their place in the stream
    of equal (id, source, size), so each draws its own uses.
    """
    uses = mix_sources(docs, id_col, text_col, source_col, with_source=True)
    half = F.col("size") / 2
    once = F.least(F.col("taken"), F.col("size"))
    places = F.array(
        F.when(F.col("size") == 0, F.lit(0.0)).when((once > 0) & (once >= half), F.col("position")),
        F.when((F.col("size") > 0) & (F.col("taken") - once > 0) & (F.col("taken") - once >= half), F.col("again")),
    )
    uses = uses.select(F.struct(F.col(id_col).alias("id"), "source", "size").alias("key"), F.array_compact(places).alias("places"))
    same = Window.partitionBy("key").orderBy("places")
    uses = uses.withColumn("nth", F.row_number().over(same)).filter(F.size("places") > 0)
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.struct(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
    # Rows travel as one struct, so that no name of theirs can clash.
    rows = docs.select(key.alias("key"), F.xxhash64(text_col).alias("order"), F.struct("*").alias("row"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("order")))
    drawn = rows.join(uses, ["key", "nth"]).select("row", "key", F.explode("places").alias("place"))
    return drawn.orderBy("place", "key").select("row.*")
