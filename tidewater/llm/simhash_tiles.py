"""SimHash near-duplicates by tiled exact comparison of fingerprints.

Different fingerprints are laid out by population count in blocks of a bounded
number of rows.  Two blocks are compared only if their ranges of population
counts come within the radius, which no linked pair can exceed.  A task
compares one pair of blocks tile by tile with numpy exclusive-or and bit counts
and returns a spanning forest of the links it saw, so a dense group costs as
many rows as it has members.  The forests are joined by connected components.

The removal of near-duplicates takes pairs within a wide radius as candidates
only and links those whose texts are alike by signatures of fixed size: some
shared shingles, and 0.8 or more of the longer text's words shared.  Since a
link needs equal shingle slots, only texts that share a slot are compared, or
two slots where many share one; a text that shares none meets no other.

The comparison of fingerprints alone is exact and therefore quadratic in the
number of different ones within reach; its input is 16 bytes a fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.components import connected_components
from tidewater.llm.store import written

SEED = 42
_ROWS, _COLUMNS, _PAIRS = 256, 8192, 65_536
#: Odd multipliers, each of which puts 64-bit hashes in another order: of shingles, then of words.
_SLOTS = np.random.default_rng(SEED).integers(0, 1 << 63, 144, np.uint64) * np.uint64(2) + np.uint64(1)
_SHINGLE_SLOTS, _WORD_SLOTS = _SLOTS[:16], _SLOTS[16:]
#: How many shingle slots two linked texts share at least.
_AGREE = 2
_LEAST_BLOCKS = 8
#: Up to so many texts of a slot's value are compared by that value alone; groups of up to ``_FEW`` texts are compared together.
_CROWD, _FEW, _UNIT_ROWS = 4096, 32, 16_384
_DATA = ("bits", "more", "signature")


def _shingles(text: str | None, width: int, seed: int) -> np.ndarray:
    """Hashes of the word shingles (ASCII case folded, repeats kept); fewer words than ``width`` make one."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, seed)], dtype=np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    return np.fromiter((digest(joined[s:e], seed) for s, e in zip(starts, ends[width - 1 :].tolist(), strict=True)), np.uint64, len(starts))


def _bits(hashes: np.ndarray) -> int:
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, width: int = 4, seed: int = SEED) -> int:
    """64-bit SimHash over word shingles (ASCII case folded, repeats counted) as an unsigned int.

    Fewer words than ``width`` make one shingle; no words give zero.
    """
    return _bits(_shingles(text, width, seed))


def _least(hashes: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The least hash in each order; all zero without hashes."""
    least = np.full(len(slots), -1 if len(hashes) else 0, np.int64).view(np.uint64)
    for at in range(0, len(hashes), 4096):
        least = np.minimum(least, (hashes[at : at + 4096, None] * slots).min(axis=0))
    return least


class _WordHashes(dict):
    """Word -> hash, remembered up to a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        made = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return made


def word_elements(hashes: np.ndarray) -> np.ndarray:
    """One hash for each occurrence of a word: the k-th of equal words is an element of its own."""
    x = np.sort(hashes)
    first = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)
    nth = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
    x = x + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def signature(text: str | None, shingles: np.ndarray, hashes: _WordHashes) -> bytes:
    """16 min-hashes of the shingles (32 bits each), 128 of the words (8 bits each) and the number of words."""
    words = (text or "").encode().lower().split()
    of_words = _least(word_elements(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))), _WORD_SLOTS)
    size = np.array([len(words)], "<u4")
    return (_least(shingles, _SHINGLE_SLOTS) >> np.uint64(32)).astype("<u4").tobytes() + (of_words >> np.uint64(20)).astype(np.uint8).tobytes() + size.tobytes()


class Signatures:
    """Signatures of the rows of a task, and which pairs of them are alike."""

    def __init__(self, packed: list[bytes], similarity: float) -> None:
        raw = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 196)
        self.shingles = np.ascontiguousarray(raw[:, :64]).view("<u4")
        self.words = np.ascontiguousarray(raw[:, 64:192])
        self.sizes = np.ascontiguousarray(raw[:, 192:]).view("<u4")[:, 0].astype(np.float64)
        self.similarity = similarity

    def alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs share shingles and, by estimate, ``similarity`` of the longer text's words."""
        total, least = self.sizes[a] + self.sizes[b], self.similarity * np.maximum(self.sizes[a], self.sizes[b])
        left = np.flatnonzero(total / 2 >= least)  # no estimate is above the mean of the sizes
        left = left[(self.shingles[a[left]] == self.shingles[b[left]]).sum(axis=1) >= _AGREE]
        agree = ((self.words[a[left]] == self.words[b[left]]).mean(axis=1) - 1 / 256) / (1 - 1 / 256)  # less those that agree by chance
        found = np.zeros(len(a), bool)
        found[left] = agree / (1 + agree) * total[left] >= least[left]
        return found


def _fingerprints(width: int, lanes: int, signed: bool):
    """Add fingerprints (and signatures) to the columns before the last, which is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            made, signatures = np.zeros((2, len(texts)), np.uint64), [None] * len(texts)
            for i, text in enumerate(texts):
                text = text.as_py()
                for k in range(lanes):
                    shingles = _shingles(text, width, SEED + k)
                    made[k, i] = _bits(shingles)
                    if signed and k == 0:
                        signatures[i] = signature(text, shingles, hashes)
            columns = [*batch.columns[:-1], *(pa.array(m.view(np.int64)) for m in made)]
            names = [*batch.schema.names[:-1], "bits", "more"]
            if signed:
                columns, names = [*columns, pa.array(signatures, pa.binary())], [*names, "signature"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


class Forest:
    """Groups of nodes 0..n-1; each node is labelled with a root."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the groups of a[i] and b[i] for all i, by minimum hooking and pointer jumping."""
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            pair = np.unique(np.maximum(x[apart], y[apart]) * len(self.root) + np.minimum(x[apart], y[apart]))
            np.minimum.at(self.root, pair // len(self.root), pair % len(self.root))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        nodes = np.flatnonzero(self.root != np.arange(len(self.root)))
        return nodes, self.root[nodes]


def link_blocks(left: np.ndarray, right: np.ndarray, radius: int, forest: Forest, left_at: np.ndarray, right_at: np.ndarray, signatures: Signatures | None = None) -> None:
    """Link in ``forest`` all pairs of rows (64-bit lanes as columns) that differ in at most ``radius`` bits.

    ``left_at`` and ``right_at`` are the rows' nodes in the forest.  With
    ``signatures`` of the forest's nodes, a pair must be alike by them too.
    """
    lanes = range(left.shape[1])
    low_left, low_right = left[:, 0].astype(np.uint32), right[:, 0].astype(np.uint32)
    for r in range(0, len(left), _ROWS):
        for c in range(r if right is left else 0, len(right), _COLUMNS):
            rows, columns = slice(r, r + _ROWS), slice(c, c + _COLUMNS)
            group = forest.root[left_at[r]]
            if (forest.root[right_at[columns]] == group).all() and (forest.root[left_at[rows]] == group).all():
                continue  # pairs of one group need no proof
            if len(lanes) == 1:  # half of the bits already rules out nearly every pair
                bits = np.bitwise_count(low_left[rows, None] ^ low_right[None, columns])
            else:
                bits = sum(np.bitwise_count(left[rows, None, k] ^ right[None, columns, k]) for k in lanes)
            i, j = np.divmod(np.flatnonzero(bits <= radius), bits.shape[1])
            i, j = i + r, j + c
            same = np.bitwise_count(left[i] ^ right[j]).sum(axis=1, dtype=np.int64) <= radius
            a, b = left_at[i[same]], right_at[j[same]]
            while signatures is not None and len(a):
                apart = forest.root[a] != forest.root[b]
                a, b = a[apart], b[apart]
                proven = signatures.alike(a[:_PAIRS], b[:_PAIRS])
                forest.link(a[:_PAIRS][proven], b[:_PAIRS][proven])
                a, b = a[_PAIRS:], b[_PAIRS:]
            forest.link(a, b)


def _compare(radius: int, lanes: int):
    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        order = np.argsort(side, kind="stable")
        bits = np.stack([table.column(c).to_numpy() for c in ("bits", "more")[:lanes]], axis=1).view(np.uint64)[order]
        nodes = table.column("node").to_numpy()[order]
        cut, at = int(np.searchsorted(side[order], 1)), np.arange(len(bits))
        forest = Forest(len(bits))
        if 0 < cut < len(bits):
            link_blocks(bits[:cut], bits[cut:], radius, forest, at[:cut], at[cut:])
        else:  # a block with itself
            link_blocks(bits, bits, radius, forest, at, at)
        a, b = forest.edges()
        return pa.table({"a": nodes[a], "b": nodes[b]})

    return run


def linked_groups(heads: DataFrame, radius: int, lanes: int, block_rows: int = 32_768) -> DataFrame:
    """(node, component) of every row of ``heads`` (node, bits, more) that links to another.

    A block holds about ``block_rows`` neighbours in order of population count
    (and of hash inside one count), whatever the counts' sizes are.  Smaller tables
    make ``_LEAST_BLOCKS`` blocks too, which spreads their comparison over tasks.
    """
    carried = ["node", "bits", "more"]
    ones = F.bit_count("bits") + F.bit_count("more")
    heads = heads.select(*carried, ones.alias("ones"))
    # At most 129 population counts, so the window and the broadcast are bounded.
    before = F.coalesce(F.sum("rows").over(Window.orderBy("ones").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = F.greatest(F.lit(1), F.least(F.lit(block_rows), F.ceil(F.sum("rows").over(Window.partitionBy()) / _LEAST_BLOCKS)))
    bands = written(heads.groupBy("ones").agg(F.count("*").alias("rows")).withColumns({"before": before, "per": per}), "bands")
    share = F.pmod(F.xxhash64("node"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    block = F.floor((F.col("before") + share * F.col("rows")) / F.col("per"))
    blocks = heads.join(F.broadcast(bands), "ones").select(*carried, block.alias("block"))
    spans = bands.select("ones", F.explode(F.sequence(F.floor(F.col("before") / F.col("per")), F.floor((F.col("before") + F.col("rows") - 1) / F.col("per")))).alias("block"))
    spans = written(spans.groupBy("block").agg(F.min("ones").alias("low"), F.max("ones").alias("high")), "blocks")
    # Blocks follow population counts, so a later block is in reach if its least count is.
    first = spans.select("block", F.explode(F.sequence(F.col("low"), F.col("high") + radius)).alias("low"))
    second = spans.select(F.col("block").alias("other"), "low")
    pairs = first.join(second, "low").filter("other >= block").select("block", "other")
    sides = pairs.select("block", "other", F.lit(0).alias("side"), F.col("block").alias("of")).unionByName(
        pairs.filter("other > block").select("block", "other", F.lit(1).alias("side"), F.col("other").alias("of"))
    )
    dealt = blocks.withColumnRenamed("block", "of").join(sides, "of").drop("of")
    links = dealt.groupBy("block", "other").applyInArrow(_compare(radius, lanes), "a long, b long")
    return connected_components(links, "a", "b")


def _slot_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) for each shingle slot of the rows (node, signature)."""
    for batch in batches:
        slots = Signatures(batch.column(1).to_pylist(), 0).shingles.astype(np.int64)
        places = np.arange(slots.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array((places << 32 | slots).ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), len(places)))], names=["key", "node"])


def _lanes(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.stack([table.column(c).to_numpy() for c in ("bits", "more")], axis=1).view(np.uint64)


def _linked_pairs(radius: int, similarity: float):
    """The pairs (a, b) of rows (a, b, bits, more, signature, and the same of b) that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.select(["a", *_DATA]), batch.select(["b", *(f"{c}_b" for c in _DATA)]).rename_columns(["b", *_DATA])
            signatures = Signatures([*a.column("signature").to_pylist(), *b.column("signature").to_pylist()], similarity)
            near = np.flatnonzero(np.bitwise_count(_lanes(a) ^ _lanes(b)).sum(axis=1, dtype=np.int64) <= radius)
            near = near[signatures.alike(near, near + batch.num_rows)]
            yield batch.select(["a", "b"]).take(pa.array(near))

    return run


def _compare_units(radius: int, similarity: float):
    """Links between components, as pairs of them, of units: rows of one (key, other, one, two), side 0 with side 1 or, without that, with itself."""

    def run(table: pa.Table) -> pa.Table:
        component, side = (table.column(c).to_numpy() for c in ("component", "side"))
        unit = [table.column(c).to_numpy() for c in ("two", "one", "other", "key")]
        order = np.lexsort((component, side, *unit))
        nodes, first, at = np.unique(table.column("node").to_numpy()[order], return_index=True, return_inverse=True)
        some = table.take(pa.array(order[first]))
        bits, signatures, component = _lanes(some), Signatures(some.column("signature").to_pylist(), similarity), component[order[first]]
        forest = Forest(len(nodes))
        _, head, of = np.unique(component, return_index=True, return_inverse=True)
        forest.link(np.arange(len(nodes)), head[of])
        side = side[order]
        fresh = np.any([x[order][1:] != x[order][:-1] for x in unit], axis=0)
        starts = np.concatenate([[0], np.flatnonzero(fresh) + 1, [len(side)]])
        sizes = np.diff(starts)
        few = (sizes <= _FEW) & (np.maximum.reduceat(side, starts[:-1]) == 0)
        nth = (np.arange(len(side)) - np.repeat(starts[:-1], sizes))[np.repeat(few, sizes)]
        rows = np.flatnonzero(np.repeat(few, sizes))
        for i in range(0, len(rows), _PAIRS):  # each row with those before it in its unit
            row, before = rows[i : i + _PAIRS], nth[i : i + _PAIRS]
            b = np.repeat(row, before)
            a = b - 1 - (np.arange(len(b)) - np.repeat(np.cumsum(before) - before, before))
            a, b = at[a], at[b]
            near = forest.root[a] != forest.root[b]
            near[near] = np.bitwise_count(bits[a[near]] ^ bits[b[near]]).sum(axis=1, dtype=np.int64) <= radius
            near[near] = signatures.alike(a[near], b[near])
            forest.link(a[near], b[near])
        for start, stop in zip(starts[:-1][~few].tolist(), starts[1:][~few].tolist(), strict=True):
            cut = start + int(np.searchsorted(side[start:stop], 1))
            left, right = at[start:cut], at[cut:stop]
            if len(left) and len(right):
                link_blocks(bits[left], bits[right], radius, forest, left, right, signatures)
            else:  # a block with itself
                left = at[start:stop]
                link_blocks(own := bits[left], own, radius, forest, left, left, signatures)
        a = np.flatnonzero(component != component[forest.root])
        return pa.table({"a": component[a], "b": component[forest.root[a]]})

    return run


def alike_groups(texts: DataFrame, radius: int, similarity: float, block_rows: int = 32_768, crowd: int = _CROWD) -> DataFrame:
    """(node, component) of every row of ``texts`` (node, bits, more, signature) that links to another.

    Two texts that link have ``_AGREE`` equal shingle slots.  Each text is first
    compared with the least of those that share a slot with it.  Then all pairs
    are compared that share a slot, as long as components do not connect
    them yet: under the slot's value, or under two values where more than
    ``crowd`` texts have each.  A unit of work has two blocks of about
    ``block_rows`` texts at most.
    """
    keys = texts.select("node", "signature").mapInArrow(_slot_keys, "key long, node long")
    shared = keys.groupBy("key").agg(F.count("*").alias("rows"), F.min("node").alias("head")).filter("rows > 1")
    members = written(keys.join(shared, "key"), "members")
    pairs = members.filter("node > head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    one = texts.select(F.col("node").alias("a"), *_DATA)
    two = texts.select(F.col("node").alias("b"), *(F.col(c).alias(f"{c}_b") for c in _DATA))
    first = written(connected_components(pairs.join(one, "a").join(two, "b").mapInArrow(_linked_pairs(radius, similarity), "a long, b long"), "a", "b"), "first")

    named = members.filter("rows > 2").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sparse = named.filter(F.col("rows") <= crowd).select("key", F.lit(-1).cast("long").alias("other"), "node", "component")
    crowded = named.filter(F.col("rows") > crowd).groupBy("node", "component").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # sixteen at most
    twos = F.expr("flatten(transform(keys, (x, i) -> transform(slice(keys, i + 2, 16), y -> struct(x as key, y as other))))")
    crowded = crowded.select("node", "component", F.explode(twos).alias("pair")).select("pair.key", "pair.other", "node", "component")
    groups = written(sparse.unionByName(crowded), "groups")
    apart = groups.groupBy("key", "other").agg(F.count("*").alias("rows"), F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    apart = written(apart.select("key", "other", F.ceil(F.col("rows") / block_rows).alias("blocks"), "rows"), "apart")
    rows = apart.agg(F.sum(F.col("rows") * F.col("blocks"))).first()[0]
    if not rows:
        return first
    own, met = F.pmod(F.xxhash64("node"), "blocks"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = groups.join(apart.drop("rows"), ["key", "other"]).withColumn("own", own).withColumn("met", met)
    dealt = dealt.select("key", "other", F.least("own", "met").alias("one"), F.greatest("own", "met").alias("two"), (F.col("own") > F.col("met")).cast("int").alias("side"), "node", "component")
    unit = F.pmod(F.xxhash64("key", "other", "one", "two"), F.lit(max(_LEAST_BLOCKS, -(-rows // _UNIT_ROWS))))
    dealt = dealt.withColumn("unit", unit).join(texts.select("node", *_DATA), "node")
    second = connected_components(dealt.groupBy("unit").applyInArrow(_compare_units(radius, similarity), "a long, b long"), "a", "b")
    late = second.select(F.col("node").alias("component"), F.col("component").alias("least"))
    every = first.unionByName(late.join(first, "component", "left_anti").select(F.col("component").alias("node"), "component"))
    return every.join(late, "component", "left").select("node", F.coalesce("least", "component").alias("component"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 4, radius: int = 4, block_rows: int = 32_768) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits) and component_id.

    component_id is the least id reachable over links of at most ``radius``
    differing bits.  Null and empty texts, and texts without words, have
    fingerprint zero and link like any other; repeated rows keep their own row
    in the component of their id; null ids get the component of their
    fingerprint; an empty table gives an empty result.  ``block_rows`` is about
    the number of fingerprints of one block; it does not change the result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("content"))
    prints = written(rows.mapInArrow(_fingerprints(width, 1, False), "id long, bits long, more long"), "fingerprints")
    heads = written(prints.groupBy("bits", "more").agg(F.min("id").alias("node")).filter("node is not null"), "heads")
    groups = linked_groups(heads, radius, 1, block_rows=block_rows)
    named = heads.join(groups, "node", "left").select("bits", F.coalesce("component", "node").alias("component_id"))
    out = prints.join(named, "bits", "left")
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def near_duplicate_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5, similarity: float = 0.8, radius: int = 42, block_rows: int = 32_768) -> DataFrame:
    """(id, sha, component): one row per input row; equal components are near-duplicates of each other.

    Two different texts link if at most ``radius`` of the 128 bits of their
    fingerprints over shingles of ``width`` words differ (two thirds agree), if they
    share shingles (2 of 16 min-hashes), and if both have at least ``similarity`` of
    the longer one's words, by 128 min-hashes of the words with their repeats.
    The fingerprints find candidates; alone they would also link unrelated
    texts, short ones above all, and texts with one long passage in common.
    Texts without words link with each other only.
    """
    content = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.sha2(content, 256).alias("sha"), content.alias("content"))
    prints = written(rows.mapInArrow(_fingerprints(width, 2, True), "id long, sha string, bits long, more long, signature binary"), "fingerprints")
    texts = prints.groupBy("sha").agg(*(F.first(c).alias(c) for c in ("bits", "more", "signature")))  # equal for equal texts
    texts = written(texts.withColumn("node", F.monotonically_increasing_id()), "texts")
    groups = alike_groups(texts, radius, similarity, block_rows, min(_CROWD, block_rows))
    named = texts.select("sha", "node").join(groups, "node", "left").select("sha", F.coalesce("component", "node").alias("component"))
    return prints.select("id", "sha").join(named, "sha")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of near-duplicates the one with its least id.

    Rows are matched by id and text, so unlike texts of one id, or without an
    id, stay apart.  A null id stays only where its group has no other; of equal ids the lesser
    digest stays, and repeated rows with equal id and text leave one row.  An empty table gives an empty result.
    """
    found = near_duplicate_texts(docs, id_col, text_col, width=width, similarity=similarity)
    least = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "sha")).alias("first")
    keep = found.groupBy("component").agg(least).select(F.struct("first.id", "first.sha").alias("key"))
    digest = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    # Rows travel as one struct, so that no name of theirs can clash.
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("id"), digest.alias("sha")).alias("key"), F.struct("*").alias("row"))
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    return rows.join(keep, "key", "left_semi").withColumn("nth", nth).filter("nth = 1").select("row.*")
