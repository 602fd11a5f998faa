"""Contiguous balanced shards cut from a global byte-size prefix sum.

Rows are range-partitioned by id and written once without their text.  Totals
per partition (one row each) give every partition its global offset; inside a
partition a window adds the running size.  The global prefix is then cut at
equal targets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.store import written


def byte_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 16, rows_per_part: int = 20_000) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus one (null: 1).  Rows are ordered by id
    (null first), then checksum and size; repeated rows take neighbouring slots.
    A row goes to the shard in whose equal share of all bytes it begins, so two
    shards differ by less than the two largest rows.  A row larger than a share may
    leave the next shard empty; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    order = ("id", "text_crc32", "size")
    skinny = written(rows, "sizes")
    parts = max(1, -(-skinny.count() // rows_per_part))
    ranged = skinny.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "ranges")

    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    # One row per range partition, so its size is bounded by the partition count.
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(every).alias("all_bytes"),
    )
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.withColumns({"run": F.sum("size").over(inside), "nth": F.row_number().over(inside)}).join(F.broadcast(offsets), "part")
    placed = placed.withColumn("start", F.col("bytes_before") + F.col("run") - F.col("size"))
    placed = placed.withColumns({"shard": F.expr(f"cast(start * {shards} div all_bytes as int)"), "rank": F.col("rows_before") + F.col("nth") - 1})
    firsts = F.broadcast(placed.groupBy("shard").agg(F.min("rank").alias("first_rank")))
    return placed.join(firsts, "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("rank") - F.col("first_rank")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("start").alias("byte_offset")
    )

