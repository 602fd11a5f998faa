"""Tables written to the folder that the driver and all executors share.

Intermediate results that several jobs read are written once as Parquet below
``spark.checkpoint.dir``: this cuts lineage, so a lost executor costs only the
tasks it was running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewater.sources.scratch import new_folder


def written(df: DataFrame, name: str, compression: str = "snappy", by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written; ``by`` gives each value of a column its folder."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("compression", compression)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
