"""Similarity, alias, lineage and first-match joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.text import found_terms, jaccard


def similar_sets(df: DataFrame, id_col: str, set_col: str, least: float, day_col: str, days: int) -> DataFrame:
    """Pairs of different token sets with Jaccard at least ``least``, at most ``days`` apart.

    Rows of one day with equal sets are one class, named by its least id, so
    that copies give members and not pairs.  Candidates share a token of the
    prefix filter: with tokens in rising frequency, two sets that are similar
    enough share one of the first ``size - ceil(least * size) + 1`` tokens, so the
    joined keys are the rare ones.  Empty sets pair with nothing.
    """
    rows = df.select(F.col(id_col).alias("id"), F.array_sort(set_col).alias("items"), F.col(day_col).alias("day")).filter(F.size("items") > 0)
    classes = rows.groupBy("items", "day").agg(F.min("id").alias("head"), F.count("*").alias("members"))
    exploded = classes.select("head", "day", "items", F.explode("items").alias("item"))
    often = exploded.groupBy("item").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("head").orderBy("n", "item"))
    size = F.size("items")
    # The small slack keeps products like 0.72 * 25 from rounding above the integer.
    prefix = size - F.ceil(size * F.lit(least) - 1e-9) + 1
    keyed = exploded.join(often, "item").withColumn("rank", rank).filter(F.col("rank") <= prefix).select("head", "day", "items", "item")
    left = keyed.select("item", F.col("head").alias("a"), F.col("day").alias("day_a"), F.col("items").alias("set_a"))
    right = keyed.select("item", F.col("head").alias("b"), F.col("day").alias("day_b"), F.col("items").alias("set_b"))
    near = (F.abs(F.datediff("day_a", "day_b")) <= days) & (F.size("set_b") >= F.size("set_a") * least - 1e-9) & (F.size("set_a") >= F.size("set_b") * least - 1e-9)
    pairs = left.join(right, "item").filter((F.col("a") < F.col("b")) & near).dropDuplicates(["a", "b"])
    scored = pairs.withColumn("similarity", jaccard(F.col("set_a"), F.col("set_b"))).filter(F.col("similarity") >= least)
    members = classes.select("head", "members")
    scored = scored.join(members.toDF("a", "members_a"), "a").join(members.toDF("b", "members_b"), "b")
    return scored.select("a", "b", "similarity", "members_a", "members_b")


def alias_matches(texts: DataFrame, id_col: str, text_col: str, aliases: DataFrame, few: int = 2000) -> DataFrame:
    """(id, entity): texts in which an alias occurs as a phrase of whole words.

    ``aliases`` has entity and alias; case and signs do not matter.  Up to ``few``
    aliases are looked for in one pass over each text, and only what is found is
    joined with the entities.  With more, each word is joined with the aliases
    that begin with it, by a shuffle, and the phrase is compared in place.
    """

    def plain(column: str):
        return F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(column), F.lit(""))), "[^a-z0-9]+", " "))

    named = aliases.select("entity", plain("alias").alias("phrase")).filter("phrase <> ''").distinct()
    rows = texts.select(F.col(id_col).alias("id"), plain(text_col).alias("plain"))
    listed = [r["phrase"] for r in named.select("phrase").distinct().limit(few + 1).collect()]
    if len(listed) > few:
        words = F.split("plain", " ")
        named = named.withColumn("phrase", F.split("phrase", " ")).withColumn("word", F.element_at("phrase", 1))
        at = rows.select("id", words.alias("words")).select("id", "words", F.posexplode("words").alias("pos", "word"))
        found = at.join(named, "word").filter(F.slice("words", F.col("pos") + 1, F.size("phrase")) == F.col("phrase"))
        return found.select("id", "entity").distinct()
    # A phrase that is found stands for those that it begins with, too.
    implied = [(a, t) for a in listed for t in listed if a == t or a.startswith(f"{t} ")]
    stands = texts.sparkSession.createDataFrame(implied, "found string, phrase string")
    said = stands.join(named, "phrase").select("found", "entity").distinct()
    found = rows.select("id", F.explode(found_terms(F.col("plain"), listed)).alias("found"))
    return found.join(F.broadcast(said), "found").select("id", "entity").distinct()


def first_match(df: DataFrame, id_col: str, candidates: DataFrame, keys: list[tuple[str, str]], value: str) -> DataFrame:
    """The value of the first key (in order) by which a row finds a candidate; null if none does.

    ``keys`` pairs a column of ``df`` with a key column of ``candidates``.  Of several
    candidates for a key the least value counts.
    """
    out, names = df, []
    for i, (left, right) in enumerate(keys):
        lookup = candidates.filter(F.col(right).isNotNull()).groupBy(F.col(right).alias(f"_key{i}")).agg(F.min(value).alias(f"_value{i}"))
        out = out.join(lookup, F.col(left) == F.col(f"_key{i}"), "left").drop(f"_key{i}")
        names.append(f"_value{i}")
    return out.withColumn(value, F.coalesce(*names)).drop(*names)
