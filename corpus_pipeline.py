"""The corpus pipeline: toxicity, exact dedup, near-dedup, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm.bm25_packing import pack_documents
from tidewater.llm.curriculum_mix import draw_mixture
from tidewater.llm.exact_dedup import drop_exact_duplicates
from tidewater.llm.simhash_tiles import drop_near_duplicates
from tidewater.llm.store import written
from tidewater.llm.toxic_lexicon import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon rejects go."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return drop_exact_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the one with the least id stays."""
    return drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix draws them, in training order."""
    return draw_mixture(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2048 ids, as pieces of documents."""
    return pack_documents(docs)


STAGES = [("toxicity", toxicity), ("exact dedup", exact_copies), ("SimHash near-dedup", near_copies), ("source mix", mixture), ("packing", packing)]

#: The lexicon, SimHash and the tokenizer have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
