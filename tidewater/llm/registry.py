"""Queries over the corpus tables, each applying one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.bloom_lm import score_texts
from tidewater.llm.bm25_packing import pack_documents
from tidewater.llm.byte_shards import byte_shards
from tidewater.llm.cross_parse_langid import identify_language
from tidewater.llm.curriculum_mix import mix_sources
from tidewater.llm.exact_dedup import exact_dedup
from tidewater.llm.filter_replay import filter_interactions
from tidewater.llm.flat_graph_dedup import embedding_components
from tidewater.llm.fm_quality import score_quality
from tidewater.llm.pivot_negatives import hard_negatives, usable
from tidewater.llm.simhash_tiles import simhash_components
from tidewater.llm.toxic_lexicon import score_toxicity
from tidewater.llm.warc_fixity import fixity_audit, replica_layout, replica_store, warc_layout


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return fixity_audit(warc_layout(pages), replica_layout(replica_store(pages))).withColumnRenamed("id", "page_id")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_documents(spark, sf_dir))


def op4_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_documents(spark, sf_dir))


def op6_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(_documents(spark, sf_dir))


def op7_cross_parse_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_language(_documents(spark, sf_dir))


def op8_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_documents(spark, sf_dir))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_pivot_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").filter(usable("embedding"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    found = hard_negatives(rows.select("vec_id", label.alias("label"), steps.alias("embedding")))
    return found.withColumns({c: F.col(c).cast("long") for c in ("positive_score", "negative_score")})


def op13_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(_documents(spark, sf_dir))


OP1_SQL = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))
"""

OP2_SQL = """
with texts as (
  select page_id, coalesce(html, '') as body, chr(13) || chr(10) as eol, coalesce(url, '') as url from pages),
records as (
  select page_id, 'WARC/1.1' || eol || 'WARC-Type: resource' || eol || 'WARC-Target-URI: ' || url || eol
    || 'WARC-Date: 2024-01-01T00:00:00Z' || eol || 'WARC-Record-ID: <urn:page:' || cast(page_id as varchar) || '>' || eol
    || 'WARC-Block-Digest: sha1:' || sha1(body) || eol || 'Content-Type: text/html' || eol
    || 'Content-Length: ' || cast(strlen(body) as varchar) || eol || eol || body || eol || eol as record from texts),
ranked as (
  select page_id, sha256(record) as sha256, cast(strlen(record) as bigint) as length,
    case when page_id % 97 = 48 then sha256(left(record, len(record) - 1) || 'x') else sha256(record) end as aged,
    row_number() over (order by page_id, sha256(record)) - 1 as rank from records),
leaves as (
  select page_id, rank // 4096 as volume, rank % 4096 as slot, length, sha256, aged,
    cast(sum(length) over (partition by rank // 4096 order by rank) - length as bigint) as "offset" from ranked),
level1 as (
  select volume, slot // 16 as node, min("offset") as start, max("offset" + length) as stop,
    sha256(cast(min("offset") as varchar) || '-' || cast(max("offset" + length) as varchar) || ':' || string_agg(sha256, '' order by slot)) as one,
    sha256(cast(min("offset") as varchar) || '-' || cast(max("offset" + length) as varchar) || ':' || string_agg(aged, '' order by slot)) as two
  from leaves group by volume, slot // 16),
level2 as (
  select volume, node // 16 as node, min(start) as start, max(stop) as stop,
    sha256(cast(min(start) as varchar) || '-' || cast(max(stop) as varchar) || ':' || string_agg(one, '' order by node)) as one,
    sha256(cast(min(start) as varchar) || '-' || cast(max(stop) as varchar) || ':' || string_agg(two, '' order by node)) as two
  from level1 group by volume, node // 16),
roots as (
  select volume,
    sha256(cast(min(start) as varchar) || '-' || cast(max(stop) as varchar) || ':' || string_agg(one, '' order by node)) as root,
    sha256(cast(min(start) as varchar) || '-' || cast(max(stop) as varchar) || ':' || string_agg(two, '' order by node)) as replica_root
  from level2 group by volume)
select page_id, volume, slot, "offset", length, sha256, root, replica_root, sha256 = aged as intact
from leaves join roots using (volume)
"""

OP3_SQL = """
with rows as (
  select doc_id, source, md5(cast(doc_id as varchar)) as hash,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size,
         row_number() over (order by source nulls last) - 1 as place from rows group by source),
weighted as (
  select *, case place % 3 when 0 then 3 when 1 then 1 else 2 end as weight,
         case place % 3 when 0 then 0.5::double when 1 then 0.0::double else -0.5::double end as slope,
         cast(source_size * 2 as double) as cap from sources),
levels as (
  select *, (1.5::double * cast(sum(source_size) over () as double)
             - coalesce(sum(cap) over (order by cast(source_size as double) / weight, place rows between unbounded preceding and 1 preceding), 0))
            / cast(sum(weight) over (order by cast(source_size as double) / weight, place rows between current row and unbounded following) as double) as level
  from weighted),
targets as (
  select source, source_size, slope,
         case when level * weight < cap then max(case when level * weight < cap then level end) over () * weight else cap end as target
  from levels),
placed as (
  select r.doc_id, r.size, t.source_size, t.slope, t.target, cast(round(t.target) as bigint) as quota,
         cast(coalesce(sum(r.size) over (partition by r.source order by r.hash, r.doc_id, r.size
              rows between unbounded preceding and 1 preceding), 0) as bigint) as start
  from rows r join targets t on r.source is not distinct from t.source),
used as (
  select *, least(size, greatest(0, quota - start)) as once,
         least(size, greatest(0, quota - source_size - start)) as twice from placed)
select doc_id, size, source_size, target, cast(once + twice as bigint) as taken,
  case when once > 0 then case when slope = 0 then cast(start as double) / target else
    (sqrt((1 - slope) * (1 - slope) + 4 * slope * (cast(start as double) / target)) - (1 - slope)) / (2 * slope) end end as position,
  case when twice > 0 then case when slope = 0 then cast(start + source_size as double) / target else
    (sqrt((1 - slope) * (1 - slope) + 4 * slope * (cast(start + source_size as double) / target)) - (1 - slope)) / (2 * slope) end end as again
from used
"""

OP11_SQL = """
with rows as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
marks as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
failed as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
     100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text), regexp_matches(text, '[#$%&*|]'),
     coalesce(doc_id > min(doc_id) over (partition by text), false)] as fails
  from rows left join marks using (doc_id)),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter),
orders as (
  select [a.letter, b.letter, c.letter, d.letter, e.letter] as steps
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
replayed as (
  select part, good, toxic, array_to_string(steps, '') as filter_order, step, steps[step] as filter,
    fails[ascii(steps[step]) - 64] as failing,
    list_bool_or([false] || [fails[ascii(x) - 64] for x in steps[1:step - 1]]) as before,
    len([x for x in fails if x]) = 1 as alone
  from failed, orders, range(1, 6) as s(step)),
counted as (
  select part, filter_order, cast(step as integer) as step, any_value(filter) as filter,
    count(*) filter (not before and not failing) as kept, count(*) filter (failing and not before) as removed,
    count(*) filter (failing and before) as redundant, count(*) filter (failing and alone) as unique_fails,
    count(*) filter (failing and not before and good) as good_lost, count(*) filter (failing and not before and toxic) as toxic_lost
  from replayed group by part, filter_order, step)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  cast(sum(removed) over (partition by part, filter) as bigint) as shapley
from counted
"""

OP12_SQL = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * x::double) for x in embedding] as vec
  from embeddings
  where label is not null and embedding is not null
    and len(embedding) = len([x for x in embedding if x is not null and isfinite(x)])),
pairs as (
  select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same, cast(list_dot_product(a.vec, r.vec) as bigint) as score
  from rows a join rows r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.positive_id, cast(row_number() over w as integer) as rank, n.id as negative_id, p.positive_score, n.score as negative_score
from positives p join pairs n on n.anchor_id = p.anchor_id and not n.same
  and 80 * p.positive_score <= 100 * n.score and n.score <= p.positive_score
window w as (partition by p.anchor_id, p.positive_id order by n.score desc, n.id)
qualify row_number() over w <= 5
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op2_warc_fixity": OP2_SQL, "op3_mix_sources": OP3_SQL, "op11_filter_interactions": OP11_SQL, "op12_pivot_negatives": OP12_SQL}
