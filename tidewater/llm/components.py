"""Connected components of a large sparse graph by alternating star contraction.

Every step is a min-aggregation (combined map-side) and an equi-join that AQE
may split on skewed hubs; no neighbour list is ever gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.store import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the least node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    joined = both.filter("other > node").join(least, "node")
    return joined.select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs itself and its smaller neighbours on the least of them."""
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").filter("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.unionByName(least.withColumnRenamed("least", "low")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Return ``(node, component)`` for every node with a link; component is its least node.

    Null endpoints and self-links are ignored, repeated links count once; no
    links give an empty result.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    edges = edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
    edges = written(edges.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct(), "links")
    before = _state(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)), "stars")
        now = _state(edges)
        if now == before:
            break
        before = now
    heads = edges.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(heads)
