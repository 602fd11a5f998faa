"""Embedding near-duplicates through a robust-pruned flat graph.

Equal vectors are merged first.  Each label's vectors are cut into shards around
centroids, and a vector is a member of its nearest few, so that shards overlap.  In a
shard every member gets a short list of neighbours, pruned so that none is
reached better through another; the lists that a vector got in its shards are
united.  Every vector then searches the shards nearest to it, more than it is a
member of: from the shard's medoid greedily towards itself, and on through every
vector found within a range wider than a link.  What is found is verified by
cosine in double precision.  Recall is audited against brute force on a bounded
sample, and the search is widened until it holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.components import connected_components
from tidewater.llm.sampling import hash_limit
from tidewater.llm.simhash_tiles import Forest
from tidewater.llm.store import written

_SPACE = ["label", "dim"]
#: Neighbours kept of each vector, of so many nearest and so many drawn; how much nearer a kept neighbour must be to prune another.
_DEGREE, _NEAREST, _DRAWN, _ALPHA = 20, 48, 12, 1.2
#: Nodes that a search keeps in view, how many of them it opens at once, and how far below a link it goes on.
_BEAM, _OPENED, _RANGE = 12, 4, 0.12


def _unit_vectors(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else pc.list_flatten(column.combine_chunks()).to_numpy(zero_copy_only=False)
    x = flat.reshape(len(column), -1)
    # Scaling by the largest component first keeps the norm of extreme vectors finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _centroids(table: pa.Table) -> pa.Table:
    """Spherical k-means on the sample of one label."""
    x = _unit_vectors(table.column("vec"))
    k = min(int(table.column("shards")[0].as_py()), len(x))
    centre = x[:k].copy()
    for _ in range(6):
        mine = (x @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, mine, x)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centre = np.where(size > 0, total / np.where(size > 0, size, 1), centre)
    label, dim = table.column("label")[0].as_py(), table.column("dim")[0].as_py()
    return pa.table({"label": pa.array([label] * k, pa.string()), "dim": pa.array([dim] * k, pa.int32()), "centre": pa.array(list(centre), pa.list_(pa.float64()))})


def _nearest(centres: dict, most: int):
    """Give each vector the numbers of its nearest shards, best first (0 where its label has but one)."""

    def run(batches):
        for batch in batches:
            cells: list = [[0]] * batch.num_rows
            rows: dict = {}
            for i, s in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
                if s in centres:
                    rows.setdefault(s, []).append(i)
            for s, mine in rows.items():
                similar = _unit_vectors(batch.column("vec").take(pa.array(mine))) @ centres[s].T
                for i, row in zip(mine, np.argsort(-similar, axis=1, kind="stable")[:, :most], strict=True):
                    cells[i] = row.tolist()
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("dim"), batch.column("head"), pa.array(cells, pa.list_(pa.int32()))], names=["label", "dim", "head", "cells"])

    return run


def pruned(x: np.ndarray) -> list[np.ndarray]:
    """Neighbours of each of the unit vectors: the nearest first, none that a nearer one leads to.

    Of the nearest and some drawn ones (which make long steps possible), the best that is left
    is kept again and again, and those are struck out that lie closer to it, by the
    factor ``_ALPHA``, than to the vector itself.
    """
    n = len(x)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * (x @ x.T)))
    np.fill_diagonal(apart, np.inf)
    near = np.argpartition(apart, min(_NEAREST, n - 1) - 1, axis=1)[:, : min(_NEAREST, n - 1)] if n > 1 else np.zeros((n, 0), int)
    # Drawn by place, so that reruns agree.
    drawn = (np.arange(n)[:, None] + np.random.default_rng(n).integers(1, max(2, n), (n, _DRAWN))) % n if n > 1 else near
    options = np.concatenate([near, drawn], axis=1)
    rows = np.arange(n)
    far = np.take_along_axis(apart, options, 1)
    options = np.take_along_axis(options, np.argsort(far, axis=1, kind="stable"), 1)
    far = np.take_along_axis(apart, options, 1)
    left = np.isfinite(far)
    kept: list[list[int]] = [[] for _ in range(n)]
    for _ in range(_DEGREE):
        has = left.any(axis=1)
        if not has.any():
            break
        pick = options[rows, left.argmax(axis=1)]
        for i in np.flatnonzero(has).tolist():
            kept[i].append(int(pick[i]))
        between = apart[pick[:, None], options]
        between[options == pick[:, None]] = 0.0
        left &= ~(_ALPHA * between <= far) & has[:, None]
    return [np.array(k, int) for k in kept]


def _build(table: pa.Table) -> pa.Table:
    heads = table.column("head").to_numpy()
    order = np.argsort(heads, kind="stable")
    heads, x = heads[order], _unit_vectors(table.column("vec").take(pa.array(order)))
    return pa.table({"head": heads, "near": pa.array([heads[k] for k in pruned(x)], pa.list_(pa.int64()))})


def _distinct(values: np.ndarray) -> np.ndarray:
    """The different values in order; sorting is what costs least here."""
    ordered = np.sort(values)
    return ordered[np.concatenate([[True], ordered[1:] != ordered[:-1]])] if len(ordered) else ordered


class Graph:
    """Neighbours among the members, in both directions; all are reached from ``start``."""

    def __init__(self, heads: np.ndarray, lists: pa.ListArray, x: np.ndarray, start: int) -> None:
        owner, other = pc.list_parent_indices(lists).to_numpy(), pc.list_flatten(lists).to_numpy()
        place = np.minimum(np.searchsorted(heads, other), len(heads) - 1)
        here = heads[place] == other
        self.x, self.start = x, start
        self._link(owner[here], place[here], np.zeros(0, np.int64))
        while True:
            reached, front = np.zeros(len(x), bool), np.array([start])
            while len(front):
                reached[front] = True
                front = _distinct(self.of(front)[1])
                front = front[~reached[front]]
            lost, known = np.flatnonzero(~reached), np.flatnonzero(reached)
            if not len(lost):
                return
            # Each that is not reached hangs on the most similar that is.
            self._link(known[(x[lost] @ x[known].T).argmax(axis=1)], lost, self.pairs)

    def _link(self, a: np.ndarray, b: np.ndarray, more: np.ndarray) -> None:
        n = len(self.x)
        self.pairs = _distinct(np.concatenate([a * n + b, b * n + a, more]))
        self.other = self.pairs % n
        self.at = np.concatenate([[0], np.cumsum(np.bincount(self.pairs // n, minlength=n))])

    def of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``nodes``, neighbour) of all neighbours of the nodes."""
        first, sizes = self.at[nodes], self.at[nodes + 1] - self.at[nodes]
        spot = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.repeat(np.arange(len(nodes)), sizes), self.other[spot]


def search(graph: Graph, q: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, member) pairs of cosine ``least`` or more that searches from the graph's start come by.

    Every query keeps a beam of the best nodes it has met and opens the best of
    them that are not open, until none is left; besides, it opens whatever lies within range.
    """
    x, n = graph.x, len(graph.x)
    seen, opened = np.zeros((len(q), n), bool), np.zeros((len(q), n), bool)
    seen[:, graph.start] = True
    rows = np.arange(len(q))
    first = q @ x[graph.start]
    node, score = np.full((len(q), _BEAM), graph.start), np.full((len(q), _BEAM), -np.inf)
    score[:, 0] = first
    hit = first >= least - _RANGE
    near_i, near_j = rows[hit], np.full(int(hit.sum()), graph.start)
    found_i, found_j = [rows[first >= least]], [np.full(int((first >= least).sum()), graph.start)]
    while True:
        # Greedy: the best of the beam that are not opened; range: what was met within reach.
        ahead = np.where(opened[rows[:, None], node], -np.inf, score)
        best = np.argpartition(-ahead, _OPENED - 1, axis=1)[:, :_OPENED]
        valid = np.take_along_axis(ahead, best, 1) > -np.inf
        i, j = np.repeat(rows, _OPENED)[valid.ravel()], np.take_along_axis(node, best, 1).ravel()[valid.ravel()]
        todo = np.concatenate([i * n + j, near_i * n + near_j])
        todo = _distinct(todo[~opened.ravel()[todo]])
        if not len(todo):
            break
        opened.ravel()[todo] = True
        met: list[np.ndarray] = []
        degree = max(1, len(graph.other) // n)
        for at in range(0, len(todo), max(1, (1 << 21) // degree)):
            part = todo[at : at + max(1, (1 << 21) // degree)]
            of, other = graph.of(part % n)
            key = (part // n)[of] * n + other
            key = _distinct(key[~seen.ravel()[key]])
            seen.ravel()[key] = True
            met.append(key)
        key = np.sort(np.concatenate(met))
        i, j = key // n, key % n
        close = np.concatenate([np.einsum("ij,ij->i", q[i[a : a + (1 << 16)]], x[j[a : a + (1 << 16)]]) for a in range(0, len(i), 1 << 16)]) if len(i) else np.zeros(0)
        reach = close >= least - _RANGE
        near_i, near_j = i[reach], j[reach]
        found_i.append(i[close >= least])
        found_j.append(j[close >= least])
        # The beam takes in the best of what was met, as many of a query as it has places.
        order = np.lexsort((-close, i))
        i, j, close = i[order], j[order], close[order]
        nth = np.arange(len(i)) - np.searchsorted(i, i)
        some = nth < _BEAM
        fresh_node, fresh = np.zeros_like(node), np.full_like(score, -np.inf)
        fresh_node[i[some], nth[some]], fresh[i[some], nth[some]] = j[some], close[some]
        both_node, both = np.concatenate([node, fresh_node], axis=1), np.concatenate([score, fresh], axis=1)
        keep = np.argpartition(-both, _BEAM - 1, axis=1)[:, :_BEAM]
        node, score = np.take_along_axis(both_node, keep, 1), np.take_along_axis(both, keep, 1)
    return np.concatenate(found_i), np.concatenate(found_j)


def _padded(column, width: int) -> np.ndarray:
    made = np.full((len(column), width), -1)
    for row, cells in zip(made, column.to_pylist(), strict=True):
        row[: len(cells)] = cells
    return made


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least number that rows of both have, or a large one."""
    shared = (a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]
    return np.where(shared.any(axis=2), a, 1 << 40).min(axis=1, initial=1 << 40)


def _find(least: float, member: int):
    """Search one shard: link counts of both ends of what is found, and a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table.column("head").to_numpy(), kind="stable")))
        heads, copies, cell = table.column("head").to_numpy(), table.column("copies").to_numpy(), table.column("cell")[0].as_py()
        x, asked = _unit_vectors(table.column("vec")), _padded(table.column("cells"), max(1, max(map(len, table.column("cells").to_pylist()))))
        own = asked[:, :member]
        mine = np.flatnonzero(table.column("is_member").to_numpy(zero_copy_only=False))
        forest, total = Forest(len(heads)), np.zeros(len(heads), np.int64)
        if len(mine):
            inside = x[mine]
            start = int((inside @ inside.mean(axis=0)).argmax())
            graph = Graph(heads[mine], table.column("near").combine_chunks().take(pa.array(mine)), inside, start)
            step = max(1, (1 << 22) // len(mine))
            pairs = []
            for at in range(0, len(heads), step):
                i, j = search(graph, x[at : at + step], least)
                i, j = i + at, mine[j]
                forest.link(i, j)
                pairs.append(_distinct(np.minimum(i, j) * len(heads) + np.maximum(i, j)))
            a, b = np.divmod(_distinct(np.concatenate(pairs)), len(heads))
            for part in range(0, len(a), 1 << 16):
                i, j = a[part : part + (1 << 16)], b[part : part + (1 << 16)]
                # A pair that several shards may find counts in the least of them only.
                counts = (i != j) & (np.minimum(_common(asked[i], own[j]), _common(asked[j], own[i])) == cell)
                for c, d in ((i[counts], j[counts]), (j[counts], i[counts])):
                    total += np.bincount(c, weights=copies[d], minlength=len(heads)).astype(np.int64)
        return pa.table({"head": heads, "links": total, "root": heads[forest.root]})

    return run


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, dim, vec) of all rows; label, dim and vec are null unless the row may link.

    It may if it has an id and a label, and its vector is finite and not zero.
    """
    vec = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), vec.alias("vec"))
    usable = F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))) & F.exists("vec", lambda v: v != 0)
    may = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & usable, F.lit(False))
    return rows.select("id", *(F.when(may, c).alias(name) for name, c in (("label", F.col("label")), ("dim", F.size("vec")), ("vec", F.col("vec")))))


def comparable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, dim, vec) of the rows that may link."""
    return prepared(vectors, id_col, vector_col, label_col).filter("vec is not null")


def _found(heads: DataFrame, near: DataFrame, united: DataFrame, crowd: DataFrame, least: float, overlap: int, probes: int) -> DataFrame:
    """(head, links, root) of searches in the ``probes`` nearest shards of every vector."""
    cells = near.withColumn("cells", F.slice("cells", 1, probes))
    placed = heads.join(cells.select("head", "cells"), "head").join(united, "head", "left").select("*", F.posexplode("cells").alias("nth", "cell"))
    placed = placed.join(crowd, [*_SPACE, "cell"]).withColumns({"own": F.pmod(F.xxhash64("head"), F.col("parts")), "part": F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))})
    placed = placed.withColumn("is_member", (F.col("nth") < overlap) & (F.col("part") == F.col("own")))
    rows = placed.select(*_SPACE, "cell", "part", "head", "copies", "vec", "cells", "is_member", F.when(F.col("is_member"), F.coalesce("near", F.array().cast("array<long>"))).alias("near"))
    return written(rows.groupBy(*_SPACE, "cell", "part").applyInArrow(_find(least, overlap), "head long, links long, root long"), "searched")


def _sampled_recall(heads: DataFrame, found: DataFrame, least: float, rows: int) -> float:
    """Found links over true links of some ``rows`` vectors by hash, against all vectors by brute force."""
    size = heads.count()
    asked = heads.filter(F.xxhash64("head") <= hash_limit(rows, size)).orderBy(F.xxhash64("head")).limit(rows).select(*_SPACE, "head", "vec").toArrow()  # bounded by ``rows``
    if not asked.num_rows:
        return 1.0
    queries: dict = {}
    for n, s in enumerate(zip(asked.column("label").to_pylist(), asked.column("dim").to_pylist(), strict=True)):
        queries.setdefault(s, []).append(n)
    vectors = {s: _unit_vectors(asked.column("vec").take(pa.array(at))) for s, at in queries.items()}
    ids = asked.column("head").to_numpy()

    def true(batches):
        for batch in batches:
            total = np.zeros(len(ids), np.int64)
            rows_of: dict = {}
            for i, s in enumerate(zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
                if s in queries:
                    rows_of.setdefault(s, []).append(i)
            heads_, copies = batch.column("head").to_numpy(), batch.column("copies").to_numpy()
            for s, mine in rows_of.items():
                linked = vectors[s] @ _unit_vectors(batch.column("vec").take(pa.array(mine))).T >= least
                linked &= ids[queries[s]][:, None] != heads_[mine][None]
                total[queries[s]] += linked @ copies[mine]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["head", "links"])

    wanted = heads.select(*_SPACE, "head", "copies", "vec").mapInArrow(true, "head long, links long").agg(F.sum("links")).first()[0] or 0
    got = found.join(F.broadcast(heads.sparkSession.createDataFrame([(int(i),) for i in ids], "head long")), "head").agg(F.sum("links")).first()[0] or 0
    return got / wanted if wanted else 1.0


def embedding_components(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    *,
    least: float = 0.93,
    shard_rows: int = 400,
    max_centroids: int = 16_384,
    sample_rows: int = 8192,
    overlap: int = 3,
    probes: int = 4,
    recall: float = 0.995,
    audit_rows: int = 500,
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Rows of one label link at cosine ``least`` or more, in double precision.
    Null, empty and zero vectors, vectors with null or non-finite components,
    null labels and null ids link with nothing (their component is their own
    id); vectors of different length do not link.  Repeated rows are vectors of
    their own: they count as links of each other and share ``kept``; rows of one
    id are told apart by label and vector.  An empty table gives an empty result.

    ``sample_rows`` per label fit at most ``max_centroids`` centroids (which are
    broadcast), about one for ``shard_rows`` vectors.  A vector is a member of its
    ``overlap`` nearest shards and searches its ``probes`` nearest, twice as many
    while the audit of ``audit_rows`` vectors finds less than ``recall`` of their
    links, up to all.  A shard of more than four times ``overlap * shard_rows`` members is searched in parts.
    Every link that is returned is verified; some may be missed.
    """
    everything = prepared(vectors, id_col, vector_col, label_col)
    usable = everything.filter("vec is not null")
    heads = written(usable.groupBy(*_SPACE, "vec").agg(F.min("id").alias("first"), F.count("*").alias("copies")).withColumn("head", F.monotonically_increasing_id()), "vectors")

    total = heads.count()
    per_shard = max(shard_rows, -(-total // max_centroids))
    sizes = heads.groupBy(*_SPACE).agg(F.ceil(F.count("*") / per_shard).cast("int").alias("shards"), F.count("*").alias("size")).filter("shards > 1")
    # Only hashes low enough to be among the sample are ranked, so the ranking task does not grow with its label.
    most = 2.0 * sample_rows + 1000
    limit = F.when(F.col("size") <= most, F.lit((1 << 63) - 1)).otherwise((F.lit(most) / F.col("size") * 2.0**64 - 2.0**63).cast("long"))
    low = heads.withColumn("hash", F.xxhash64("vec")).join(sizes, _SPACE).filter(F.col("hash") <= limit)
    ranked = low.withColumn("nth", F.row_number().over(Window.partitionBy(*_SPACE).orderBy("hash", "first")))
    fitted = ranked.filter(F.col("nth") <= sample_rows).groupBy(*_SPACE).applyInArrow(_centroids, "label string, dim int, centre array<double>")
    centres: dict = {}
    for r in fitted.collect():  # at most max_centroids + one per label with several shards
        centres.setdefault((r["label"], r["dim"]), []).append(r["centre"])
    centres = {k: np.array(v) for k, v in centres.items()}
    widest = max((len(c) for c in centres.values()), default=1)

    def nearest(n: int) -> DataFrame:
        return written(heads.select(*_SPACE, "head", "vec").mapInArrow(_nearest(centres, n), "label string, dim int, head long, cells array<int>"), "cells")

    near = nearest(probes)
    members = near.select(*_SPACE, "head", F.explode(F.slice("cells", 1, overlap)).alias("cell"))
    crowd = members.groupBy(*_SPACE, "cell").agg(F.ceil(F.count("*") / (4 * overlap * shard_rows)).alias("parts"))
    crowd = written(crowd, "crowd")
    placed = members.join(crowd, [*_SPACE, "cell"]).withColumn("part", F.pmod(F.xxhash64("head"), "parts")).join(heads.select("head", "vec"), "head")
    lists = placed.groupBy(*_SPACE, "cell", "part").applyInArrow(_build, "head long, near array<long>")
    united = written(lists.groupBy("head").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")  # at most overlap * _DEGREE of a vector

    searched = _found(heads, near, united, crowd, least, overlap, probes)
    while probes < widest and _sampled_recall(heads, searched, least, audit_rows) < recall:
        probes *= 2
        searched = _found(heads, nearest(probes), united, crowd, least, overlap, probes)
    groups = connected_components(searched, "head", "root")

    links = searched.groupBy("head").agg(F.sum("links").alias("links"))
    of_head = heads.join(links, "head", "left").join(groups, F.col("head") == F.col("node"), "left").withColumn("group", F.coalesce("component", "head"))
    firsts = of_head.groupBy("group").agg(F.min("first").alias("component_id"))
    of_head = of_head.join(firsts, "group").select(*_SPACE, "vec", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = everything.join(of_head, [*_SPACE, "vec"], "left").select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def audit_recall(vectors: DataFrame, result: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, least: float = 0.93, every: int = 100) -> DataFrame:
    """One row: queries, true links and found links of every id divisible by ``every`` against all rows.

    The queries are compared with all rows by brute force, label by label.
    """
    usable = comparable(vectors, id_col, vector_col, label_col)
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v * v))
    usable = usable.withColumn("norm", norm)
    asked = usable.filter(F.col("id") % every == 0).select(*_SPACE, F.col("id").alias("query"), F.col("vec").alias("asked"), F.col("norm").alias("asked_norm"))
    dot = F.aggregate(F.zip_with("vec", "asked", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    true = usable.join(asked, _SPACE).filter((F.col("id") != F.col("query")) & (dot / F.col("norm") / F.col("asked_norm") >= least))
    true = true.groupBy("query").agg(F.count("*").alias("true_links"))
    got = asked.select("query").join(result.select(F.col(id_col).alias("query"), "n_links"), "query").join(true, "query", "left")
    return got.agg(F.count("*").alias("queries"), F.sum(F.coalesce("true_links", F.lit(0))).alias("true_links"), F.sum("n_links").alias("found_links"))
