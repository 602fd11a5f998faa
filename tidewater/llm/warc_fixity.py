"""Fixity audit of WARC volumes by Merkle trees.

Pages become WARC records, ordered by id and laid out in volumes of a bounded
number of records; a running sum of record lengths gives each its byte offset.
A leaf is the SHA-256 of a record, a node the SHA-256 of its children's hex
digests in offset order.  A replica is audited by hashing every record of its
stored bytes.  Two replicas are compared at their volume roots; below a root
only the children of mismatching nodes are looked at, until the damaged records
are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.store import written

FANOUT = 16
LEVELS = 2  # node levels between leaf and root; a volume holds FANOUT ** (LEVELS + 1) records
VOLUME = FANOUT ** (LEVELS + 1)


def warc_record(page_id: Column, url: Column, body: Column, date: str = "2024-01-01T00:00:00Z") -> Column:
    """A WARC/1.1 resource record as text; null urls and bodies count as empty."""
    body, url = F.coalesce(body, F.lit("")), F.coalesce(url, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        url,
        F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Block-Digest: sha1:"),
        F.sha1(body.cast("binary")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n"))


def _placed(keys: DataFrame, rows_per_part: int) -> DataFrame:
    """(id, volume, slot, offset, length, sha256) of records (id, name, length, sha256) in order of id and name.

    Ids are ranked over range partitions (one total per partition gives its
    first rank), so no task orders all rows.
    """
    keys = written(keys, "records")
    parts = max(1, -(-keys.count() // rows_per_part))
    ranged = written(keys.repartitionByRange(parts, "id", "name").withColumn("part", F.spark_partition_id()), "ranges")
    firsts = ranged.groupBy("part").agg(F.count("*").alias("rows"))
    ahead = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = ranged.join(F.broadcast(firsts.select("part", ahead.alias("ahead"))), "part")
    ranked = ranked.withColumn("rank", F.col("ahead") + F.row_number().over(Window.partitionBy("part").orderBy("id", "name", "sha256")) - 1)
    placed = ranked.withColumns({"volume": F.expr(f"rank div {VOLUME}"), "slot": F.expr(f"rank % {VOLUME}")})
    run = F.sum("length").over(Window.partitionBy("volume").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return written(placed.select("id", "volume", "slot", (run - F.col("length")).alias("offset"), "length", "sha256"), "layout")


def warc_layout(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", *, rows_per_part: int = 20_000) -> DataFrame:
    """(id, record, volume, slot, offset, length, sha256) of every page, in id order.

    Null ids come first; repeated rows are records of their own, ordered by
    digest.  Very long bodies are hashed where they are read; only digests and lengths move.
    """
    record = warc_record(F.col(id_col), F.col(url_col), F.col(body_col))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), record.alias("record"))
    digest = F.sha2("record", 256)
    return _placed(rows.select("id", digest.alias("name"), digest.alias("sha256"), F.octet_length("record").cast("long").alias("length")), rows_per_part)


def merkle_tree(leaves: DataFrame) -> DataFrame:
    """(volume, level, node, start, stop, digest) from the leaves (level 0) to the root, written once.

    ``leaves`` has volume, slot, offset, length and sha256.  Node n's children
    are n*FANOUT and on; its digest covers its byte range and their digests.
    """
    stop = F.col("offset") + F.col("length")
    level = leaves.select("volume", F.col("slot").alias("node"), F.col("offset").alias("start"), stop.alias("stop"), F.col("sha256").alias("digest"))
    tree = level.withColumn("level", F.lit(0))
    for k in range(1, LEVELS + 2):
        # At most FANOUT children, in offset order.
        children = F.sort_array(F.collect_list(F.struct("node", "digest")))
        grouped = level.groupBy("volume", F.expr(f"node div {FANOUT}").alias("parent")).agg(F.min("start").alias("start"), F.max("stop").alias("stop"), children.alias("children"))
        digest = F.sha2(F.concat(F.col("start").cast("string"), F.lit("-"), F.col("stop").cast("string"), F.lit(":"), F.array_join("children.digest", "")), 256)
        level = grouped.select("volume", F.col("parent").alias("node"), "start", "stop", digest.alias("digest"))
        tree = tree.unionByName(level.withColumn("level", F.lit(k)))
    return written(tree, "merkle-tree", by="level")


def mismatches(first: DataFrame, second: DataFrame) -> DataFrame:
    """(volume, node) of the leaves that differ, descending only below nodes that differ.

    A leaf that only one replica has differs too.
    """
    suspects = None
    for k in range(LEVELS + 1, -1, -1):
        a = first.filter(F.col("level") == k).select("volume", "node", F.col("digest").alias("one"))
        b = second.filter(F.col("level") == k).select("volume", "node", F.col("digest").alias("two"))
        if suspects is not None:
            parent = F.expr(f"node div {FANOUT}")
            below = suspects.withColumnRenamed("node", "parent")
            a = a.withColumn("parent", parent).join(below, ["volume", "parent"], "left_semi").drop("parent")
            b = b.withColumn("parent", parent).join(below, ["volume", "parent"], "left_semi").drop("parent")
        both = a.join(b, ["volume", "node"], "full_outer")
        suspects = written(both.filter(~F.col("one").eqNullSafe(F.col("two"))).select("volume", "node"), "suspects")
    return suspects


def fixity_audit(layout: DataFrame, replica: DataFrame) -> DataFrame:
    """One row per record of ``layout``: its place, digest, root digests and whether it is intact.

    ``replica`` has volume, slot, offset, length and sha256 of the second copy.  A
    record that the replica lacks at its place is damaged; volumes that only the replica has
    are ignored; an empty layout gives an empty result.  Records that agree but lie at other
    offsets show in the roots, which cover the ranges, and not as damage.
    """
    ours, theirs = merkle_tree(layout), merkle_tree(replica)
    bad = mismatches(ours, theirs).select("volume", F.col("node").alias("slot"), F.lit(True).alias("bad"))
    top = F.col("level") == LEVELS + 1
    roots = ours.filter(top).select("volume", F.col("digest").alias("root")).join(theirs.filter(top).select("volume", F.col("digest").alias("replica_root")), "volume", "left")
    rows = layout.join(bad, ["volume", "slot"], "left").join(roots, "volume")
    return rows.select("id", "volume", "slot", "offset", "length", "sha256", "root", "replica_root", F.col("bad").isNull().alias("intact"))


def replica_store(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", *, one_in: int = 97) -> DataFrame:
    """(id, name, content): the records of a second store, written as bytes under the digest that they had on arrival.

    One record in ``one_in`` has lost its last character to another since: those
    with ids that leave ``one_in // 2`` when divided by ``one_in``.  This stands in for a
    second store, which the tables do not have.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), warc_record(F.col(id_col), F.col(url_col), F.col(body_col)).alias("record"))
    damaged = F.concat(F.expr("left(record, length(record) - 1)"), F.lit("x"))
    kept = F.when(F.col("id") % one_in == one_in // 2, damaged).otherwise(F.col("record"))
    return written(rows.select("id", F.sha2("record", 256).alias("name"), kept.cast("binary").alias("content")), "replica", compression="zstd")


def replica_layout(store: DataFrame, *, rows_per_part: int = 20_000) -> DataFrame:
    """(id, volume, slot, offset, length, sha256) of a store's records, by their own order, lengths and bytes.

    Nothing is taken from the first copy: a record that is missing, inserted or
    of another length moves all that follow it in its volume, and the audit finds the first place where
    the copies part.
    """
    hashed = store.select("id", "name", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("long").alias("length"))
    return _placed(hashed, rows_per_part)
