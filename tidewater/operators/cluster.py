"""Leader clustering: order-sensitive grouping of reports of one fact.

A row joins the first group (in order of creation) whose leader it matches, else
it leads a new group.  The rule is no equivalence, so order is part of it.  Rows
are cut into blocks that no match crosses.  A block of up to ``walk_rows`` rows is
walked in order by one task.  Larger ones are settled by rounds over the graph of
matches, without a block: a row follows as soon as an earlier match of it leads,
and leads as soon as all its earlier matches follow.  Matches by a company are
not listed as pairs: a company's rows of a day are one hub, of which the first
leader and the first open row say all that a later row needs to know.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.event_rules import fact_tokens
from tidewater.sources.scratch import written

ATOM_SCHEMA = "ord long, atom long"
_NEAR, _COMMON, _ALIKE = 2, 3, 0.35


def same_fact(tokens_a: set, companies_a: set, day_a, tokens_b: set, companies_b: set, day_b) -> bool:
    """At most two days apart (unknown days match), and a common company where both name one,
    else three common tokens and Jaccard 0.35."""
    if day_a is not None and day_b is not None and abs((day_a - day_b).days) > _NEAR:
        return False
    if companies_a and companies_b:
        return bool(companies_a & companies_b)
    common = len(tokens_a & tokens_b)
    return common >= _COMMON and common / len(tokens_a | tokens_b) >= _ALIKE


def lead(rows: list[tuple]) -> list[int]:
    """Leader of each (tokens, companies, day) row, as an index.

    Leaders are looked up by company and by token, so a row is compared only with those that share one.
    """
    by_company, by_token = defaultdict(list), (defaultdict(list), defaultdict(list))
    found = []
    for i, (words, companies, day) in enumerate(rows):
        # Rows that both name companies match by these alone.
        shared = {k for c in companies for k in by_company[c]}
        common = Counter(k for named in ([False] if companies else [False, True]) for w in words for k in by_token[named][w])
        shared.update(k for k, n in common.items() if n >= _COMMON)
        at = next((k for k in sorted(shared) if same_fact(words, companies, day, *rows[k])), None)
        if at is None:
            at = i
            for c in companies:
                by_company[c].append(i)
            for w in words:
                by_token[bool(companies)][w].append(i)
        found.append(at)
    return found


def _atoms(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("ord", ignore_index=True)
    day = [None if pd.isna(d) else d for d in block["day"]]
    rows = [(set(t), set(c), d) for t, c, d in zip(block["tokens"], block["companies"], day, strict=True)]
    return pd.DataFrame({"ord": block["ord"], "atom": block["ord"].to_numpy()[lead(rows)]})


def _token_pairs(rows: DataFrame) -> DataFrame:
    """(early, late): pairs that match by their tokens, one of which names no company.

    With tokens in rising frequency, two sets that are alike enough share one of
    the first ``size - least common + 1``, so only rare tokens are join keys.
    """
    # The small slack keeps products from rounding above the integer.
    least = F.greatest(F.ceil(F.size("tokens") * F.lit(_ALIKE) - 1e-9), F.lit(_COMMON))
    named = (F.size("companies") > 0).alias("named")
    sets = rows.filter(F.size("tokens") >= _COMMON).select("block", "ord", "day", "tokens", named, (F.size("tokens") - least + 1).alias("prefix"))
    exploded = sets.select("*", F.explode("tokens").alias("token"))
    often = exploded.groupBy("block", "token").agg(F.count("*").alias("n"))
    ranked = exploded.join(often, ["block", "token"]).withColumn("rank", F.row_number().over(Window.partitionBy("ord").orderBy("n", "token")))
    keyed = ranked.filter("rank <= prefix").select("block", "token", "ord", "day", "tokens", "named")
    left, right = (keyed.select("block", "token", *(F.col(c).alias(f"{c}_{x}") for c in ("ord", "day", "tokens", "named"))) for x in "ab")
    near = F.coalesce(F.abs(F.datediff("day_a", "day_b")) <= _NEAR, F.lit(True))
    pairs = left.join(right, ["block", "token"]).filter((F.col("ord_a") < F.col("ord_b")) & ~(F.col("named_a") & F.col("named_b")) & near)
    common = F.size(F.array_intersect("tokens_a", "tokens_b"))
    alike = (common >= _COMMON) & (common / (F.size("tokens_a") + F.size("tokens_b") - common) >= _ALIKE)
    return pairs.filter(alike).select(F.col("ord_a").alias("early"), F.col("ord_b").alias("late")).distinct()


def _hubs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ord, hub) that rows belong to, and that they look at: a company's days, its unknown day, and any day of it."""
    named = rows.select("ord", "block", "day", F.explode("companies").alias("company"))
    hub = lambda day: F.concat_ws("\x1f", F.col("block").cast("string"), "company", day)
    day = F.coalesce(F.col("day").cast("string"), F.lit("?"))
    member = named.select("ord", F.explode(F.array(hub(day), hub(F.lit("*")))).alias("hub"))
    days = F.transform(F.sequence(F.lit(-_NEAR), F.lit(_NEAR)), lambda k: F.date_add("day", k).cast("string"))
    seen = F.when(F.col("day").isNull(), F.array(F.lit("*"))).otherwise(F.concat(days, F.array(F.lit("?"))))
    looks = named.select("ord", "block", "company", F.explode(seen).alias("seen")).select("ord", hub(F.col("seen")).alias("hub"))
    return written(member, "hub-members"), written(looks, "hub-looks")


def settle(rows: DataFrame) -> DataFrame:
    """(ord, atom) of rows (ord, block, day, tokens, companies) by rounds; as many as the longest chain of undecided matches.

    What a round joins is what is still open: settled rows leave the looks and pairs.
    """
    rows = written(rows, "facts")
    pairs, (members, looks) = written(_token_pairs(rows), "fact-pairs"), _hubs(rows)
    open_looks, open_pairs = looks, pairs
    state = written(rows.select("ord", F.lit(None).cast("boolean").alias("leads")), "open")
    while state.filter("leads is null").limit(1).count():
        hubs = members.join(state.filter("leads is not false"), "ord").groupBy("hub")
        hubs = hubs.agg(F.min(F.when(F.col("leads"), F.col("ord"))).alias("leader"), F.min(F.when(F.col("leads").isNull(), F.col("ord"))).alias("open"))
        before = lambda c: F.coalesce(F.col(c) < F.col("ord"), F.lit(False))
        by_hub = open_looks.join(hubs, "hub").select("ord", before("leader").alias("follows"), before("open").alias("waits"))
        by_pair = open_pairs.join(state.withColumnRenamed("ord", "early"), "early").select(F.col("late").alias("ord"), F.coalesce("leads", F.lit(False)).alias("follows"), F.col("leads").isNull().alias("waits"))
        said = by_hub.unionByName(by_pair).groupBy("ord").agg(F.max("follows").alias("follows"), F.max("waits").alias("waits"))
        now = F.when(F.col("leads").isNotNull(), F.col("leads")).when(F.col("follows"), False).when(F.col("waits"), None).otherwise(True)
        state = written(state.join(said, "ord", "left").select("ord", now.alias("leads")), "round")
        still = state.filter("leads is null").select("ord")
        open_looks, open_pairs = written(open_looks.join(still, "ord", "left_semi"), "looks"), written(open_pairs.join(still.withColumnRenamed("ord", "late"), "late", "left_semi"), "pairs")
    leaders = state.filter("leads").select("ord")
    first = members.join(leaders, "ord").groupBy("hub").agg(F.min("ord").alias("leader"))
    options = looks.join(first, "hub").filter("leader < ord").select("ord", "leader").unionByName(pairs.join(leaders.withColumnRenamed("ord", "early"), "early").select(F.col("late").alias("ord"), F.col("early").alias("leader")))
    joined = options.groupBy("ord").agg(F.min("leader").alias("leader"))
    return state.join(joined, "ord", "left").select("ord", F.when(F.col("leads"), F.col("ord")).otherwise(F.col("leader")).alias("atom"))


def evidence_atoms(events: DataFrame, within: list[Column] | None = None, walk_rows: int = 50_000) -> DataFrame:
    """(ord, atom): atom is the ord of the leader that a row joined.

    ``events`` has ord, title, companies (array), event_type and day.  Groups never cross
    types, nor values of the columns ``within`` (rows are grouped in each apart).
    Matches need days at most two apart, so a type is cut into blocks
    wherever its days leave a gap of more than two; a type with unknown days stays one
    block, because those match any day.  Blocks of more than ``walk_rows`` rows are settled by rounds.
    """
    names = F.transform(F.array_compact(F.coalesce("companies", F.array().cast("array<string>"))), F.lower)
    kind = F.struct(F.coalesce("event_type", F.lit("other")).alias("type"), *(c.alias(f"within{i}") for i, c in enumerate(within or [])))
    rows = events.select("ord", kind.alias("kind"), "day", fact_tokens(F.col("title")).alias("tokens"), F.array_distinct(F.filter(names, lambda c: c != "")).alias("companies"))
    # The gaps of a type follow from its distinct days, a small table.
    days = rows.groupBy("kind", "day").agg(F.count("*").alias("n"))
    order = Window.partitionBy("kind").orderBy("day")
    gap = F.coalesce(F.datediff("day", F.lag("day").over(order)) > _NEAR, F.lit(False)).cast("int")
    open_type = F.max(F.col("day").isNull()).over(Window.partitionBy("kind"))
    runs = days.withColumns({"gap": gap, "open_type": open_type}).withColumn("run", F.when(F.col("open_type"), 0).otherwise(F.sum("gap").over(order)))
    runs = runs.withColumn("rows", F.sum("n").over(Window.partitionBy("kind", "run")))
    # One row for each day of a type; written, so that Spark knows its size.
    runs = written(runs.select(F.col("kind").alias("k"), F.col("day").alias("d"), F.struct("kind", "run").alias("block"), "rows"), "fact-blocks")
    placed = rows.join(runs, rows["kind"].eqNullSafe(runs["k"]) & rows["day"].eqNullSafe(runs["d"])).drop("k", "d", "kind")
    walked = placed.filter(F.col("rows") <= walk_rows).groupBy("block").applyInPandas(_atoms, ATOM_SCHEMA)
    if runs.filter(F.col("rows") > walk_rows).limit(1).count():
        return walked.unionByName(settle(placed.filter(F.col("rows") > walk_rows).drop("rows")))
    return walked


def independence(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct counts of the evidence of each key and whether it may be promoted.

    ``facts`` has ord, atom, event_type, companies, source, source_family, topic and day, one
    row a report.  An atom's topic is its leader's; blank names do not count.
    Evidence of one atom, or nearly all from one source on one company and day,
    is not promoted, nor is what has one of everything.
    """
    named = lambda c: F.nullif(F.col(c), F.lit(""))
    stats = facts.groupBy(*keys).agg(
        F.count("*").alias("reports"),
        F.countDistinct("atom").alias("atoms"),
        F.countDistinct(named("source")).alias("sources"),
        F.countDistinct(named("source_family")).alias("families"),
        F.countDistinct(F.coalesce("event_type", F.lit("other"))).alias("types"),
        F.countDistinct("day").alias("days"),
        F.countDistinct(F.when(F.col("ord") == F.col("atom"), named("topic"))).alias("topics"),
    )
    companies = facts.select(*keys, F.explode("companies").alias("company")).filter("company <> ''").groupBy(*keys).agg(F.countDistinct("company").alias("companies"))
    largest = facts.filter("source <> ''").groupBy(*keys, "source").agg(F.count("*").alias("n")).groupBy(*keys).agg(F.max("n").alias("largest"))
    stats = stats.join(companies, keys, "left").join(largest, keys, "left").withColumn("companies", F.coalesce("companies", F.lit(0)))
    single = (F.coalesce("largest", F.lit(0)) / F.col("reports") > 0.75) & (F.col("sources") < 2) & (F.col("companies") < 2) & (F.col("days") < 2)
    spread = F.greatest("companies", "families", "types", "topics", "days") >= 2
    return stats.withColumn("promotable", (F.col("atoms") >= 2) & ~single & spread).drop("largest")
