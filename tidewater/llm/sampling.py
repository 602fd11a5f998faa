"""Bounded samples of labelled rows on which small models are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def hash_limit(rows: int, size: int) -> int:
    """A 64-bit signed hash below which ``rows`` of ``size`` uniform hashes lie, with room for chance."""
    most = 2 * rows + 1000  # many standard deviations above rows
    return (1 << 63) - 1 if size <= most else most * (1 << 64) // size - (1 << 63)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows_per_class: int, bytes_per_class: int = 1 << 27, **more: Column
) -> DataFrame:
    """(label, text, more...): up to ``rows_per_class`` ids of either class, in hash order of the id, one row each.

    Only ids and labels are ranked; whole texts are fetched for the chosen ids.
    The classes are counted first, and only hashes low enough to be among the
    chosen are ranked, so the ranking task's input does not grow with the table.
    A class ends before the text with which it would exceed ``bytes_per_class``
    (UTF-8), so what is fitted on is bounded in rows and in bytes.
    Null labels are left out; of different labels of one id the larger counts;
    of several rows of one id the one with the least text is taken.
    """
    label = F.col(label_col).cast("int")
    marks = labels.filter(label.isin(0, 1)).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label).alias("label"))
    sizes = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}  # two rows at most
    order = Window.partitionBy("label").orderBy("hash", "id")
    marks = marks.withColumn("hash", F.xxhash64("id"))
    for one, size in sizes.items():
        marks = marks.filter((F.col("label") != one) | (F.col("hash") <= hash_limit(rows_per_class, size)))
    chosen = marks.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= rows_per_class).select("id", "label", "hash")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.struct(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *(c.alias(name) for name, c in more.items())).alias("row"))
    # 2 * rows_per_class triples of numbers: bounded by the parameter.  Copies of an id are merged before any shuffle.
    single = texts.join(F.broadcast(chosen), "id").groupBy("label", "hash", "id").agg(F.min("row").alias("row"))
    filled = F.sum(F.octet_length("row.text").cast("long")).over(order)
    return single.withColumn("filled", filled).filter(F.col("filled") <= bytes_per_class).select("label", "row.text", *(f"row.{name}" for name in more))
