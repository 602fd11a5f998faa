"""Hard negatives by inner product, found through a table of distances to pivots.

One more component, ``sqrt(M - |x|^2)`` with M the largest squared length, puts
all rows on a sphere, and zero is a query's: then ``|q - x|^2 = |q|^2 + M - 2 q.x``,
so a score is a Euclidean distance.  The distances of every row to a few pivots
are stored; by the triangle inequality they bracket the distance, and so the
score, of an anchor and a row.  Blocks hold rows of one class of labels that are
nearest to one pivot.  An anchor meets only blocks, and in a block scores
exactly only rows, whose bracket reaches the scores that it asks for.

The work is anchors times rows where brackets part nothing, as for vectors
without structure; its units, a bounded block against a bounded chunk of
anchors, do not grow.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.sampling import hash_limit
from tidewater.llm.store import written

_CLASSES, _BLOCKS = 16, 8192
_TABLE = "id long, label long, vec binary, dist array<double>, cell int"
_FOUND = "anchor_id long, positive_id long, id long, positive_score double, score double"


def usable(vec: str) -> Column:
    """Whether a vector is there, with neither null nor infinite components nor NaN."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.col(vec).isNotNull() & F.forall(vec, finite)


def _matrix(column, dims: int) -> np.ndarray:
    """Vectors of one row each, short ones filled with zeros."""
    vectors = column.to_pylist()
    made = np.zeros((len(vectors), dims))
    for row, x in zip(made, vectors, strict=True):
        row[: len(x)] = x
    return made


def _packed(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dims)


def _lists(column) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(len(column), -1)


def choose_pivots(sample: np.ndarray, most: float, pivots: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the sample each as far as can be from those before it, and their added components."""
    extra = np.sqrt(np.maximum(0.0, most - (sample * sample).sum(1)))
    chosen, far = [0], np.full(len(sample), np.inf)
    while len(chosen) < min(pivots, len(sample)):
        last = chosen[-1]
        far = np.minimum(far, np.maximum(0.0, 2 * most - 2 * (sample @ sample[last] + extra * extra[last])))
        chosen.append(int(far.argmax()))
    return sample[chosen], extra[chosen]


class Space:
    """The sphere of radius sqrt(most) and the pivots on it."""

    def __init__(self, pivots: np.ndarray, extra: np.ndarray, most: float) -> None:
        self.pivots, self.extra, self.most = pivots, extra, most
        self.slack = 1e-6 * np.sqrt(most) + 1e-12  # more than rounding can move a distance

    def of_rows(self, x: np.ndarray) -> np.ndarray:
        added = np.sqrt(np.maximum(0.0, self.most - (x * x).sum(1)))
        return np.sqrt(np.maximum(0.0, 2 * self.most - 2 * (x @ self.pivots.T + added[:, None] * self.extra)))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, (q * q).sum(1)[:, None] + self.most - 2 * (q @ self.pivots.T)))

    def distance(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance at which a row has the score; scores beyond reach are at 0."""
        return np.sqrt(np.maximum(0.0, (q * q).sum(1) + self.most - 2 * score))

    def score(self, q: np.ndarray, distance: np.ndarray) -> np.ndarray:
        return ((q * q).sum(1).reshape(-1, *[1] * (distance.ndim - 1)) + self.most - distance * distance) / 2


def alive(space: Space, q: np.ndarray, dq: np.ndarray, dx: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which rows may score from ``least`` to ``most``, by every pivot."""
    far, near = space.distance(q, least) + space.slack, space.distance(q, most) - space.slack
    far[least == -np.inf] = np.inf
    found = np.ones((len(q), len(dx)), bool)
    for p in range(dx.shape[1]):
        found &= np.abs(dq[:, p, None] - dx[None, :, p]) <= far[:, None]
        found &= dq[:, p, None] + dx[None, :, p] >= near[:, None]
    return found


def _scores(q: np.ndarray, x: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Exact scores where they are asked for, and minus infinity."""
    made = np.full(asked.shape, -np.inf)
    if asked.mean() > 0.1:
        np.copyto(made, q @ x.T, where=asked)
        return made
    i, j = np.nonzero(asked)
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        made[i[part], j[part]] = np.einsum("ij,ij->i", q[i[part]], x[j[part]])
    return made


def best(scores: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``count`` highest finite scores of each row; of equal ones the smaller ids."""
    if not scores.size:
        return np.zeros(0, int), np.zeros(0, int)
    if scores.shape[1] > count:
        bar = np.partition(scores, -count, axis=1)[:, -count]
        i, j = np.nonzero((scores >= bar[:, None]) & (scores > -np.inf))
    else:
        i, j = np.nonzero(scores > -np.inf)
    order = np.lexsort((ids[j], -scores[i, j], i))
    i, j = i[order], j[order]
    nth = np.arange(len(i)) - np.searchsorted(i, i)
    return i[nth < count], j[nth < count]


def _tile(dims: int, space: Space, visit: Callable):
    """Run ``visit`` on a block of rows and chunk after chunk of its anchors."""

    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        made: list[tuple] = []
        if rows.num_rows and anchors.num_rows:
            x, dx = _packed(rows.column("vec"), dims), _lists(rows.column("dist"))
            ids, labels = (rows.column(c).to_numpy() for c in ("id", "label"))
            step = max(1, (1 << 21) // len(x))
            for at in range(0, anchors.num_rows, step):
                part = anchors.slice(at, step)
                q = _packed(part.column("vec"), dims)
                made += visit(x, dx, ids, labels, q, space.of_queries(q), part)
        names = [c.split()[0] for c in _FOUND.split(", ")]
        columns = list(zip(*made, strict=True)) if made else [()] * len(names)
        types = [pa.int64()] * 3 + [pa.float64()] * 2
        return pa.table({name: pa.array(c, t) for name, c, t in zip(names, columns, types, strict=True)})

    return run


def _positives(space: Space, count: int):
    def visit(x, dx, ids, labels, q, dq, part) -> list[tuple]:
        anchor, label, least = (part.column(c).to_numpy() for c in ("id", "label", "least"))
        wanted = (labels[None, :] == label[:, None]) & (ids[None, :] != anchor[:, None])
        # As many rows as are wanted have at least the count-th highest lower end of all brackets.
        if len(x) > count:
            high = np.full(wanted.shape, np.inf)
            for p in range(dx.shape[1]):
                np.minimum(high, dq[:, p, None] + dx[None, :, p], out=high)
            low = np.where(wanted, space.score(q, high + space.slack), -np.inf)
            least = np.maximum(least, np.partition(low, -count, axis=1)[:, -count])
        scores = _scores(q, x, wanted & alive(space, q, dq, dx, least, np.full(len(q), np.inf)))
        i, j = best(scores, ids, count)
        return list(zip(anchor[i].tolist(), ids[j].tolist(), ids[j].tolist(), scores[i, j].tolist(), scores[i, j].tolist(), strict=True))

    return visit


def _negatives(space: Space, count: int, low: int, high: int):
    def visit(x, dx, ids, labels, q, dq, part) -> list[tuple]:
        anchor, label, least, most = (part.column(c).to_numpy() for c in ("id", "label", "least", "most"))
        positives, made = part.column("positives").to_pylist(), []
        scores = _scores(q, x, (labels[None, :] != label[:, None]) & alive(space, q, dq, dx, least, most))
        for n in range(max(map(len, positives))):
            mine = np.array([i for i, p in enumerate(positives) if len(p) > n])
            bar = np.array([positives[i][n]["score"] for i in mine])[:, None]
            held = scores[mine]
            held[(100 * held < low * bar) | (100 * held > high * bar)] = -np.inf
            i, j = best(held, ids, count)
            made += zip(anchor[mine[i]].tolist(), [positives[k][n]["id"] for k in mine[i]], ids[j].tolist(), bar[i, 0].tolist(), held[i, j].tolist(), strict=True)
        return made

    return visit


def _aim(dims: int, space: Space, blocks: dict[str, np.ndarray], count: int, same: bool, chunks: int):
    """Each anchor once for every block that its brackets reach."""

    def run(batches):
        for batch in batches:
            q = _packed(batch.column("vec"), dims)
            if not len(q):
                continue
            dq, label = space.of_queries(q), batch.column("label").to_numpy()
            near = np.maximum(dq[:, None] - blocks["high"][None], blocks["low"][None] - dq[:, None]).max(2, initial=0)
            far = (dq[:, None] + blocks["high"][None]).min(2)
            low, high = space.score(q, far + space.slack), space.score(q, np.maximum(0, near - space.slack))
            pure = (blocks["least"] == blocks["most"])[None] & (blocks["least"][None] == label[:, None])
            if same:
                # Blocks of the label alone, best lower end first, until they hold enough rows besides the anchor.
                sure = np.where(pure, low, -np.inf)
                order = np.argsort(-sure, axis=1, kind="stable")
                enough = np.cumsum(np.where(np.take_along_axis(pure, order, 1), blocks["rows"][order], 0), axis=1) > count
                at = np.where(enough.any(1), enough.argmax(1), 0)
                least = np.where(enough.any(1), np.take_along_axis(sure, np.take_along_axis(order, at[:, None], 1), 1)[:, 0], -np.inf)
                aimed = (blocks["least"][None] <= label[:, None]) & (label[:, None] <= blocks["most"][None]) & (high >= least[:, None])
            else:
                least, most = (batch.column(c).to_numpy() for c in ("least", "most"))
                aimed = ~pure & (high >= least[:, None]) & (low <= most[:, None])
            i, b = np.nonzero(aimed)
            made = batch.take(pa.array(i))
            if same:
                made = made.append_column("least", pa.array(least[i]))
            made = made.append_column("block", pa.array(b.astype(np.int32))).append_column("chunk", pa.array((made.column("id").to_numpy() // 7 % chunks).astype(np.int32)))
            yield made

    return run


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    *,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    low_percent: int = 80,
    high_percent: int = 100,
    pivots: int = 16,
    block_rows: int = 8192,
    anchor_rows: int = 16_384,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; an anchor's positives
    are its ``positives`` best other rows of the same label.  For each positive the
    ``negatives`` best rows of other labels are returned that score from
    ``low_percent`` to ``high_percent`` of the positive (so none where it is below 0).
    Scores are inner products in double precision; equal ones are in order of the id.

    Rows with a null id, label or vector, or a component that is null or not
    finite, take no part.  Of rows with one id the one of the least label, then of
    the least vector, does.  Short vectors count as filled with zeros, whatever
    the length of the longest.  Anchors without a positive, and an empty table, give
    no rows.  Other columns are not read.
    """
    clean = vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(vec_col))
    row = F.struct(F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    single = clean.select(F.col(id_col).cast("long").alias("id"), row.alias("row")).groupBy("id").agg(F.min("row").alias("row"))
    rows = written(single.select("id", "row.label", "row.vec"), "vectors")
    squared = F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x)
    size = rows.agg(F.count("*").alias("rows"), F.max(squared).alias("most"), F.max(F.size("vec")).alias("dims"), F.count(F.when(F.col("id") % every == 0, 1)).alias("anchors")).first()
    dims, most = max(1, size["dims"] or 1), (size["most"] or 0.0) * (1 + 1e-12)
    # Some two thousand rows by hash, at any size of the table.
    sample = rows.filter(F.xxhash64("id") <= hash_limit(500, size["rows"])).orderBy(F.xxhash64("id"), "id").toArrow() if size["rows"] else None
    space = Space(*choose_pivots(_matrix(sample.column("vec"), dims), most, pivots), most) if sample is not None and sample.num_rows else Space(np.zeros((1, dims)), np.zeros(1), most)
    count = len(space.pivots)

    def place(batches):
        for batch in batches:
            x = _matrix(batch.column("vec"), dims)
            dist = space.of_rows(x)
            cell = batch.column("label").to_numpy() % _CLASSES * count + dist.argmin(1) if len(x) else np.zeros(0)
            columns = [batch.column("id"), batch.column("label"), pa.array([v.tobytes() for v in x.astype("<f8")], pa.binary()), pa.array(list(dist), pa.list_(pa.float64())), pa.array(cell.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _TABLE.split(", ")])

    table = written(rows.mapInArrow(place, _TABLE), "pivot-table")
    # At most _CLASSES * pivots rows, and then _BLOCKS more.
    per_block = max(block_rows, -(-size["rows"] // _BLOCKS))
    cells = {r["cell"]: -(-r["count"] // per_block) for r in table.groupBy("cell").count().collect()}
    starts = dict(zip(sorted(cells), np.cumsum([0, *(cells[c] for c in sorted(cells))]).tolist(), strict=False))
    layout = table.sparkSession.createDataFrame([(c, starts[c], cells[c]) for c in sorted(cells)], "cell int, start int, parts int")
    table = table.join(F.broadcast(layout), "cell").withColumn("block", (F.col("start") + F.pmod(F.xxhash64("id"), "parts")).cast("int")).drop("cell", "start", "parts")
    ends = [f(F.element_at("dist", k + 1)).alias(f"{name}{k}") for name, f in (("low", F.min), ("high", F.max)) for k in range(count)]
    summary = table.groupBy("block").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count("*").alias("rows"), *ends).orderBy("block").toArrow()
    known = dict(zip(summary.column("block").to_pylist(), range(summary.num_rows), strict=True))
    blocks = {c: summary.column(c).to_numpy() for c in ("least", "most", "rows")} | {c: np.stack([summary.column(f"{c}{k}").to_numpy() for k in range(count)], 1) for c in ("low", "high")}
    number = table.sparkSession.createDataFrame(sorted(known.items()), "block int, number int")  # a block of no rows has no number
    table = table.join(F.broadcast(number), "block").drop("block").withColumnRenamed("number", "block")

    chunks = max(1, -(-size["anchors"] // anchor_rows))
    dealt = table.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))) if chunks > 1 else table.withColumn("chunk", F.lit(0))
    anchors = table.filter(F.col("id") % every == 0).select("id", "label", "vec")
    carried = "id long, label long, vec binary"
    aimed = anchors.mapInArrow(_aim(dims, space, blocks, positives, True, chunks), f"{carried}, least double, block int, chunk int")
    meet = lambda asking, visit: dealt.groupBy("block", "chunk").cogroup(asking.groupBy("block", "chunk")).applyInArrow(_tile(dims, space, visit), _FOUND)
    first = lambda keys, n: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id")) <= n
    near = written(meet(aimed, _positives(space, positives)), "positives")
    ranked = near.withColumn("first", first(["anchor_id"], positives)).filter("first")
    # At most ``positives`` of an anchor.
    asked = ranked.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("id", "score")).alias("positives"), F.min("score").alias("worst"), F.max("score").alias("best"))
    asked = asked.filter("best >= 0").withColumns({"least": F.greatest("worst", F.lit(0.0)) * low_percent / 100, "most": F.col("best") * high_percent / 100}).drop("worst", "best")
    asked = written(anchors.join(asked, "id"), "asked")
    aimed = asked.mapInArrow(_aim(dims, space, blocks, negatives, False, chunks), f"{carried}, positives array<struct<id long, score double>>, least double, most double, block int, chunk int")
    found = written(meet(aimed, _negatives(space, negatives, low_percent, high_percent)), "negatives")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
