"""Readers of the driver's tables and the news view that the gates and reports run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TYPES = ("funding", "ma", "earnings", "report", "model", "strategy", "regional_policy", "other")
TIERS = ("L1", "L2", "L3", "L4-vertical", "L5", "L6")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event per document; ``ord`` is the input order and the last key of every sort.

    Every document is an event, with its whole text.  By design of the fixture there
    are fifty tracked companies (customers 0 to 49, a broadcast of that size), and
    a title is the first sentence, up to 120 characters.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    region = table(spark, sf_dir, "region").select((F.col("r_regionkey")).alias("rk"), F.col("r_name").alias("region"))
    customer = table(spark, sf_dir, "customer").filter("c_custkey < 50").select(F.col("c_custkey").alias("ck"), F.col("c_name").alias("company_name"), F.col("c_nationkey").alias("nationkey"))
    suffix = F.coalesce(F.regexp_extract("source", "([0-9]+)$", 1).try_cast("int"), F.lit(0))
    rows = docs.join(F.broadcast(region), F.col("doc_id") % 5 == F.col("rk"), "left").join(F.broadcast(customer), F.col("doc_id") % 50 == F.col("ck"), "left")
    return rows.select(
        F.col("doc_id").alias("ord"),
        F.trim(F.substring(F.regexp_extract("text", "^[^.\\n]*", 0), 1, 120)).alias("title"),
        F.concat(F.lit("https://news.example/"), (F.col("doc_id") % 900).cast("string")).alias("url"),
        "text",
        "source",
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")).alias("day"),
        F.element_at(F.array(*map(F.lit, TYPES)), (F.col("doc_id") % 8 + 1).cast("int")).alias("event_type"),
        (F.col("doc_id") % 11).cast("int").alias("score"),
        "region",
        F.when(F.col("doc_id") % 3 != 0, F.col("company_name")).alias("company"),
        "nationkey",
        F.element_at(F.array(*map(F.lit, TIERS)), suffix % 6 + 1).alias("tier"),
        F.when(F.col("doc_id") % 7 == 0, "official_ir").otherwise("media").alias("role"),
        (F.col("doc_id") % 3 != 0).alias("is_company"),
        (F.col("doc_id") % 13 == 0).alias("is_google"),
        (F.col("doc_id") % 6 == 0).alias("low_signal"),
        (F.col("doc_id") % 17 == 0).alias("needs_review"),
        (F.col("doc_id") % 5 != 0).alias("actionable"),
        F.when(F.col("doc_id") % 19 == 0, F.array(F.lit("health"))).alias("declared_industries"),
    )


#: The same view for the SQL oracles.
NEWS_SQL = """
news as (
  select d.doc_id as ord, trim(substring(regexp_extract(d.text, '^[^.\\n]*', 0), 1, 120)) as title,
    'https://news.example/' || cast(d.doc_id % 900 as varchar) as url, d.text, d.source,
    date '2024-01-01' + cast(d.doc_id % 60 as integer) as day,
    (['funding', 'ma', 'earnings', 'report', 'model', 'strategy', 'regional_policy', 'other'])[d.doc_id % 8 + 1] as event_type,
    cast(d.doc_id % 11 as integer) as score, r.r_name as region, case when d.doc_id % 3 <> 0 then c.c_name end as company, c.c_nationkey as nationkey,
    (['L1', 'L2', 'L3', 'L4-vertical', 'L5', 'L6'])[coalesce(try_cast(regexp_extract(d.source, '([0-9]+)$', 1) as integer), 0) % 6 + 1] as tier,
    case when d.doc_id % 7 = 0 then 'official_ir' else 'media' end as role, d.doc_id % 3 <> 0 as is_company, d.doc_id % 13 = 0 as is_google,
    d.doc_id % 6 = 0 as low_signal, d.doc_id % 17 = 0 as needs_review, d.doc_id % 5 <> 0 as actionable,
    case when d.doc_id % 19 = 0 then ['health'] end as declared_industries
  from documents d left join region r on r.r_regionkey = d.doc_id % 5 left join customer c on c.c_custkey = d.doc_id % 50 and c.c_custkey < 50)
"""


def sql_hit(text: str, terms) -> str:
    """The boundary matcher as DuckDB SQL over a lower-case expression."""
    return f"regexp_matches({text}, '(^|[^a-z0-9])({'|'.join(terms)})([^a-z0-9]|$)')"
