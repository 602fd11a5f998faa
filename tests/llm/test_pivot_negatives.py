"""Hard negatives against all pairs."""

import numpy as np
import pytest

from tidewater.llm.pivot_negatives import Space, alive, best, choose_pivots, hard_negatives


def brute(rows, every=100, positives=5, negatives=5, low=80, high=100):
    kept = {}
    for i, v, c in rows:
        if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept[i] = min(kept.get(i, (c, list(v))), (c, list(v)))
    dims = max((len(v) for _, v in kept.values()), default=0)
    x = {i: np.array([*v, *[0.0] * (dims - len(v))]) for i, (_, v) in kept.items()}
    found = []
    for a in kept:
        if a % every:
            continue
        ranked = sorted((-float(x[a] @ x[i]), i) for i in kept if i != a)
        chosen = [(i, -s) for s, i in ranked if kept[i][0] == kept[a][0]][:positives]
        for p, s in chosen:
            fits = [(i, -t) for t, i in ranked if kept[i][0] != kept[a][0] and low * s <= -100 * t <= high * s]
            found += [(a, p, n + 1, i, s, t) for n, (i, t) in enumerate(fits[:negatives])]
    return sorted(found)


def made(rng, n, dims, labels, spread, groups):
    centres = rng.normal(size=(groups, dims))
    group = rng.integers(0, groups, n)
    x = np.floor(40 * (centres[group] + spread * rng.normal(size=(n, dims))))
    return [(int(i), v.tolist(), int(c)) for i, v, c in zip(rng.permutation(3 * n)[:n], x, (group + (rng.random(n) < 0.3) * rng.integers(1, 9, n)) % labels, strict=True)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, embedding array<double>, label int, id int, row string, score double")


@pytest.mark.parametrize(("labels", "spread", "groups", "limits"), [(10, 0.3, 30, {}), (40, 1.0, 5, {"block_rows": 50, "anchor_rows": 4, "every": 20}), (2, 0.05, 100, {"pivots": 3, "every": 10}), (1, 0.3, 9, {})])
def test_equals_all_pairs(spark, labels, spread, groups, limits):
    rng = np.random.default_rng(labels)
    rows = made(rng, 900, 12, labels, spread, groups)
    got = sorted(map(tuple, hard_negatives(frame(spark, rows), **limits).collect()))
    want = brute(rows, limits.get("every", 100))
    assert got == want and (labels == 1) == (not want)


def test_ties_repeats_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100 * k, [3.0, 4.0], k % 2) for k in range(4)]
    rows += [(k, [3.0, 4.0], k % 3) for k in range(1, 40)] + [(k, [3.0, 4.0], k % 3) for k in range(1, 40)] + [(50, [3.0, 3.0], 1), (50, [3.0, 4.0], 0), (50, [2.0, 4.0], 0)]
    rows += [(60, None, 1), (61, [nan, 1.0], 1), (62, [inf, 1.0], 1), (63, [None, 1.0], 1), (64, [1.0, 1.0], None), (None, [9.0, 9.0], 1), (65, [5.0], 1), (66, [], 0), (67, [0.0, 0.0, 0.0], 1), (700, [-3.0, -4.0], 5), (701, [3.0, 4.0], 5), (800, [0.0, 0.0], 5)]
    assert sorted(map(tuple, hard_negatives(frame(spark, rows)).collect())) == brute(rows)
    assert hard_negatives(frame(spark, rows).limit(0)).count() == 0
    assert hard_negatives(frame(spark, rows).filter("label is null")).count() == 0


def test_brackets_keep_every_row_that_fits_and_part_clusters():
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(20, 8)) * 10, 50, 0) + rng.normal(size=(1000, 8)) * 0.1
    most = float((x * x).sum(1).max())
    space = Space(*choose_pivots(x[::7], most, 16), most)
    scores, q = x[:40] @ x.T, x[:40]
    low, high = np.quantile(scores, 0.9, axis=1), np.quantile(scores, 0.98, axis=1)
    kept = alive(space, q, space.of_queries(q), space.of_rows(x), low, high)
    fits = (scores >= low[:, None]) & (scores <= high[:, None])
    assert kept[fits].all() and kept.mean() < 0.7


def test_best_prefers_small_ids_among_equals():
    i, j = best(np.array([[1.0, 2.0, 2.0, 2.0, -np.inf], [-np.inf] * 5]), np.array([5, 9, 3, 7, 1]), 2)
    assert i.tolist() == [0, 0] and j.tolist() == [2, 3]
