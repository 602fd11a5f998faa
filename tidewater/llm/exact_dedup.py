"""Exact deduplication over an extendible-hash index on shared files.

The directory over the leading bits of a 64-bit text hash is doubled until no
bucket is overfull; how often it may double follows from the bytes of the table.  Each bucket is a key range owned by one task, which chains
texts of equal hash and compares their bytes.  Copies are first merged inside
every input partition, so an owner sees a text at most once per partition part
however often it occurs.  The finished index is a table in the shared folder,
joined back to the skinny document rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.store import written

#: Rows of a bucket besides its text bytes.
_ENTRY_BYTES = 48
_PARTIAL = "bucket int, key long, content string, keep_id long, group_size long"
#: Bits of the finest counts; their table is summed up to the depth in use before it reaches the driver.
_FINEST = 24
_INDEX = "key long, chain int, text_sha256 string, keep_id long, group_size long"


def grow_directory(weights: np.ndarray, capacity: int) -> np.ndarray:
    """First prefix of each bucket, in key order, after doubling until no bucket is overfull.

    ``weights[p]`` are the bytes below prefix ``p`` of the deepest directory.  A
    bucket of one such prefix is not split further: its chain simply grows.
    """
    below = np.concatenate([[0], np.cumsum(weights)])
    done, level = [], [(0, len(weights))]
    while level:
        overfull = []
        for first, width in level:
            if width > 1 and below[first + width] - below[first] > capacity:
                overfull += [(first, width // 2), (first + width // 2, width // 2)]
            else:
                done.append(first)
        level = overfull
    return np.array(sorted(done), dtype=np.int64)


class _Chains:
    """Open buckets of a task: for each key the chain of different texts."""

    def __init__(self) -> None:
        self.by_key: dict[int, list[list]] = {}
        self.bytes = 0

    def add(self, key: int, text: str, keep_id: int, size: int) -> None:
        chain = self.by_key.setdefault(key, [])
        for entry in chain:
            if entry[0] == text:
                if keep_id is not None and (entry[1] is None or keep_id > entry[1]):
                    entry[1] = keep_id
                entry[2] += size
                return
        chain.append([text, keep_id, size])
        self.bytes += len(text) + _ENTRY_BYTES


def _partial(directory: np.ndarray, depth: int, part_bytes: int):
    """Merge the copies of an input partition, a bounded part of it at a time."""

    def drain(chains: _Chains) -> Iterator[pa.RecordBatch]:
        rows = [(key, *entry) for key, chain in chains.by_key.items() for entry in chain]
        keys = np.array([r[0] for r in rows], dtype=np.int64)
        prefix = (keys.view(np.uint64) >> np.uint64(64 - depth)).astype(np.int64) if depth else np.zeros(len(keys), np.int64)
        bucket = np.searchsorted(directory, prefix, side="right") - 1
        schema = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("content", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
        for at in range(0, len(rows), 1000):
            some = rows[at : at + 1000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[at : at + 1000], pa.int32()), pa.array(keys[at : at + 1000])]
                + [pa.array([r[i] for r in some], t) for i, t in ((1, pa.string()), (2, pa.int64()), (3, pa.int64()))],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chains = _Chains()
        for batch in batches:
            for key, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chains.add(key, text, doc_id, 1)
                if chains.bytes > part_bytes:
                    yield from drain(chains)
                    chains = _Chains()
        yield from drain(chains)

    return run


def _owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chain the sorted entries of a key range; one key's chain is held at a time."""
    schema = pa.schema([("key", pa.int64()), ("chain", pa.int32()), ("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
    out: list[tuple] = []

    def close(chains: _Chains) -> None:
        for key, chain in chains.by_key.items():
            digests = [hashlib.sha256(e[0].encode()).hexdigest() for e in chain]
            if len(set(digests)) < len(digests):
                raise ValueError("different texts of one hash bucket share a SHA-256 digest")
            out.extend((key, i, digest, e[1], e[2]) for i, (digest, e) in enumerate(zip(digests, chain, strict=True)))

    def batch() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)
        out.clear()
        return made

    open_key, chains = None, _Chains()
    for part in batches:
        for key, text, keep_id, size in zip(*(part.column(c).to_pylist() for c in ("key", "content", "keep_id", "group_size")), strict=True):
            if key != open_key:
                close(chains)
                open_key, chains = key, _Chains()
            chains.add(key, text, keep_id, size)
        if len(out) >= 5000:
            yield batch()
    close(chains)
    yield batch()


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, key_bits: int = 64, bucket_bytes: int = 8 << 20, max_buckets: int = 1 << 18, part_bytes: int = 32 << 20
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are compared unchanged; null counts as empty, and all empty texts are
    one group.  The largest id of a group stays; a null id stays only where a
    group has no other.  Of repeated rows with equal id and text one is kept.
    An empty table gives an empty result; further columns are ignored.

    ``bucket_bytes`` is the capacity at which a bucket is split.  It grows where the
    table would fill more than ``max_buckets``, to which the directory (and what
    the driver sees of it) stays in proportion; an owner holds one chain of its bucket at a time,
    whatever the capacity.  ``key_bits`` shortens the hash (tests use it to force collisions).
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.xxhash64(text)
    if key_bits < 64:
        key = F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)
    rows = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("id"), text.alias("content"))
    prefix = F.shiftrightunsigned("key", 64 - _FINEST)
    counts = written(rows.groupBy(prefix.alias("prefix")).agg(F.sum(F.octet_length("content") + _ENTRY_BYTES).alias("bytes")), "prefixes")
    total = counts.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(bucket_bytes, -(-total // max_buckets))
    # Two bits more than equal buckets need, so that an uneven spread is split too.
    depth = min(_FINEST, max(1, (total // capacity).bit_length() + 2))
    weights = np.zeros(1 << depth, dtype=np.int64)
    for r in counts.groupBy(F.shiftrightunsigned("prefix", _FINEST - depth).alias("prefix")).agg(F.sum("bytes").alias("bytes")).toLocalIterator():
        weights[r["prefix"]] = r["bytes"]
    directory = grow_directory(weights, capacity)
    partial = rows.mapInArrow(_partial(directory, depth, part_bytes), _PARTIAL)
    owned = partial.repartitionById(len(directory), F.col("bucket")).sortWithinPartitions("key")
    index = written(owned.mapInArrow(_owner, _INDEX), "hash-index")

    skinny = rows.select("id", "key", F.sha2(F.col("content"), 256).alias("text_sha256"))
    same = Window.partitionBy("id", "key", "text_sha256").orderBy("id")
    skinny = skinny.withColumn("nth", F.row_number().over(same))
    joined = skinny.join(index.drop("chain"), ["key", "text_sha256"])
    return joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256"
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are matched by id and digest; repeated rows with equal id and text
    leave one row.
    """
    keep = exact_dedup(docs, id_col, text_col).filter("kept").select(F.struct(F.col(id_col).alias("id"), F.col("text_sha256").alias("sha")).alias("key"))
    digest = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    # Rows travel as one struct, so that no name of theirs can clash.
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("id"), digest.alias("sha")).alias("key"), F.struct("*").alias("row"))
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    return rows.join(keep, "key", "left_semi").withColumn("nth", nth).filter("nth = 1").select("row.*")
