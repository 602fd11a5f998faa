from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests_support import near_links, plain_fingerprint, roots
from tidewater.llm.components import connected_components
from tidewater.llm import flat_graph_dedup
from tidewater.llm.flat_graph_dedup import audit_recall, embedding_components
from tidewater.llm.simhash_tiles import drop_near_duplicates, fingerprint, near_duplicate_texts, simhash_components


def test_components_of_random_links(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(300, 340)]
    want = roots(341, links)
    rows = connected_components(spark.createDataFrame([*links, (5, 5), (None, 3)], "a long, b long"), "a", "b").collect()
    got = {r["node"]: r["component"] for r in rows}
    assert len(rows) == len(got) == len({x for link in links if link[0] != link[1] for x in link})
    assert all(want[n] == c for n, c in got.items())


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_simhash_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "One"), (9005, "oNE"), (9006, "É é x"), (9007, "a b c d"), (9007, "a b c d"), (9008, "word " * 30_000)]
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()] + extra
    frame = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, fingerprint string, bits int")
    prints = [plain_fingerprint(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4 or rows[i][0] == rows[j][0]]
    ids = [i for i, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: ids[i])
    place = {i: p for p, i in enumerate(order)}
    want = roots(len(rows), [(place[a], place[b]) for a, b in links])
    for block_rows in (32_768, 7):
        got = sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_components(frame, block_rows=block_rows).collect())
        assert got == sorted((ids[i], f"{prints[i]:016x}", ids[order[want[place[i]]]]) for i in range(len(rows)))


def test_simhash_empty_table(spark):
    assert simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_fingerprint_repeats_and_ties():
    assert fingerprint("a b c d a b c d a b c d") == plain_fingerprint("a b c d a b c d a b c d")
    assert fingerprint("x") == plain_fingerprint("x")


def test_near_duplicates_leave_one(spark):
    base = " ".join(f"w{i}" for i in range(400))
    edited = base.replace("w200", "other").replace("w17 ", "new ")
    rows = [(1, base, 7), (2, edited, 7), (3, " ".join(f"v{i}" for i in range(300)), 7), (3, "again", 8), (4, None, 9), (5, "", 9)]
    rows += [(None, "of no id", 1), (None, "nor this one", 1), (None, "nor this one", 1), (None, base + " end", 1), (6, "kept but once", 1), (6, "kept but once", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, _nth int")
    got = drop_near_duplicates(frame)
    assert got.columns == frame.columns
    # Unlike texts of one id, or without one, all stay.
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([(1, base), (3, rows[2][1]), (3, "again"), (4, None), (None, "of no id"), (None, "nor this one"), (6, "kept but once")])
    assert drop_near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("block_rows", [32_768, 5])
def test_near_duplicates_match_brute_force(spark, block_rows):
    rng = np.random.default_rng(8)
    texts = []
    for k in range(12):  # groups of edited copies, and texts that share one passage only
        words = [f"w{x}" for x in rng.integers(0, 4000, 40 + 20 * k)]
        passage = [f"p{x}" for x in range(60)]
        for _ in range(4):
            edit = [f"e{rng.integers(9999)}" if rng.random() < 0.04 * (k % 4) else w for w in words]
            texts.append(" ".join(edit))
        texts.append(" ".join(passage + words[:20]))
    texts += ["", "A  b", "a b", "x " * 30_000, "x " * 29_000]
    found = near_duplicate_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), block_rows=block_rows).collect()
    want = roots(len(texts), near_links(texts))
    place = defaultdict(set)
    for r in found:
        place[r["component"]].add(r["id"])
    groups = defaultdict(set)
    for i, root in enumerate(want):
        groups[root].add(i)
    assert sorted(map(sorted, place.values())) == sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("block_rows", [32_768, 40, 3])
def test_near_duplicates_of_crowded_shingles_match_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    passage, base = [f"p{x}" for x in range(40)], [f"b{x}" for x in range(60)]
    texts = []
    for k in range(60):  # texts that have a passage in common, more or less of each, and a large group of edited copies
        texts.append(" ".join(passage + [f"w{x}" for x in rng.integers(0, 1 << 40, 1 + k % 30)]))
        texts.append(" ".join(f"e{rng.integers(99)}" if rng.random() < 0.03 * (k % 5) else w for w in base))
    links = near_links(texts)
    want = roots(len(texts), links)
    assert len(set(want)) > 20 and 300 < len(links) < len(texts) * (len(texts) - 1) / 4
    found = near_duplicate_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), block_rows=block_rows).collect()
    component = {r["id"]: r["component"] for r in found}
    assert len({(want[i], component[i]) for i in range(len(texts))}) == len(set(want)) == len(set(component.values()))


def test_texts_without_a_shared_shingle_are_not_compared(spark, monkeypatch):
    """The rows that are dealt out for comparison do not grow with the square of the texts."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 30)) for _ in range(1500)]
    texts += [f"{t} {k}" for t in texts[:10] for k in range(3)]
    dealt, grouped = [], type(spark.range(1).groupBy("id"))
    apply = grouped.applyInArrow
    monkeypatch.setattr(grouped, "applyInArrow", lambda self, *a: (dealt.append(self._df.count()), apply(self, *a))[1])
    got = near_duplicate_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), block_rows=50)
    assert len({r["component"] for r in got.collect()}) == 1500
    assert sum(dealt) <= len(texts)


def test_unrelated_short_texts_stay(spark):
    rng = np.random.default_rng(5)
    # Ties leave few bits set in texts of six or eight words, so many are within 25 bits of the empty text.
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 6 + 2 * (i % 2))) for i in range(400)]
    rows = [*enumerate(texts, 1), (0, ""), (900, None), (901, texts[5].upper()), (902, texts[7])]
    got = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(401))


def brute_links(rows, least=0.93):
    usable = {i: (label, np.array(v, dtype=float)) for i, v, label in rows if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    found = {i: set() for i, _, _ in rows}
    for i, (a, x) in usable.items():
        for j, (b, y) in usable.items():
            if i != j and a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                found[i].add(j)
    return found


def test_embedding_links_match_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    rng = np.random.default_rng(2)
    at = 10_000
    for _ in range(6):  # groups of near copies, exact copies among them
        centre = rng.normal(size=64)
        for k in range(40):
            rows.append((at, (centre + 0.12 * rng.normal(size=64) * (k % 4 > 0)).tolist(), 3))
            at += 1
    rows += [(20_001, None, 3), (20_002, [0.0] * 64, 3), (20_003, [float("nan")] * 64, 3), (20_004, [1.0, None] + [0.0] * 62, 3), (20_005, [1.0] + [0.0] * 63, None), (20_006, [1.0] * 3, 3), (20_007, [2.0] * 3, 3), (20_008, [], 3), (20_009, [float("inf")] * 64, 3)]
    frame = spark.createDataFrame([(i, v, label, "clash") for i, v, label in rows], "vec_id long, embedding array<double>, label int, units string")
    truth = brute_links(rows)
    ids = sorted(i for i, _, _ in rows)
    place = {v: k for k, v in enumerate(ids)}
    want = roots(len(ids), [(place[a], place[b]) for a, found in truth.items() for b in found])
    result = embedding_components(frame, shard_rows=30)
    got = {r["vec_id"]: r for r in result.collect()}
    assert set(got) == set(ids)
    links, found = sum(map(len, truth.values())), sum(r["n_links"] for r in got.values())
    assert 0.97 * links <= found <= links
    assert sum(got[i]["component_id"] == ids[want[place[i]]] for i in ids) >= 0.98 * len(ids)
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) and got[i]["n_links"] <= len(truth[i]) for i in ids)
    audit = audit_recall(frame, result).first()
    assert audit["found_links"] >= 0.9 * audit["true_links"]


@pytest.mark.parametrize("dim", [3, 6, 24])
def test_embedding_links_are_all_found_across_cells(spark, dim):
    rng = np.random.default_rng(4)
    # No groups: links at the bound everywhere, ids without a common divisor, more rows than one shard of default size.
    x = np.repeat(rng.normal(size=(700, dim)), 2, axis=0)
    x += 0.25 * rng.normal(size=x.shape)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = [20 * i + 1 for i in range(len(x))]
    linked = x @ x.T >= 0.93
    np.fill_diagonal(linked, False)
    want = roots(len(x), np.argwhere(linked).tolist())
    frame = spark.createDataFrame(list(zip(ids, x.tolist(), strict=True)), "vec_id long, embedding array<double>").selectExpr("*", "1 as label")
    for found in (embedding_components(frame), embedding_components(frame, shard_rows=40)):
        got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()}
        assert got == {i: (int(n), ids[w]) for i, n, w in zip(ids, linked.sum(axis=1), want, strict=True)}


def test_embeddings_one_row_out_per_row_in(spark):
    rows = [(5, [1.0, 0.0], 1), (5, None, 1), (None, [1.0, 0.0], 1), (None, None, None), (6, [1.0, 0.01], 1), (7, [1.0, 0.0], 2), (8, [0.0], 1), (8, [0.0, 2.0], 1)]
    got = embedding_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    want = [(5, 1, 5), (5, 0, 5), (None, 0, None), (None, 0, None), (6, 1, 5), (7, 0, 7), (8, 0, 8), (8, 0, 8)]
    assert Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == Counter(want)


def test_embeddings_empty_table(spark):
    assert embedding_components(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


@pytest.mark.parametrize("copies", [1, 3000])
def test_one_common_vector(spark, copies):
    frame = spark.range(copies).selectExpr("id as vec_id", "array(1.0, 2.0) as embedding", "1 as label")
    rows = embedding_components(frame).groupBy("n_links", "component_id").count().collect()
    assert [(r["n_links"], r["component_id"], r["count"]) for r in rows] == [(copies - 1, 0, copies)]


def diffuse(n, dim, rng):
    """Pairs at a cosine of 0.93 to 0.96, without any other structure."""
    x = rng.normal(size=(n // 2, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.9301, 0.96, (n // 2, 1))
    return np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * side])


def test_links_between_shards_of_diffuse_vectors_are_found(spark):
    x = diffuse(4000, 48, np.random.default_rng(9))
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    linked = x @ x.T >= 0.93
    np.fill_diagonal(linked, False)
    got = {r["vec_id"]: r["n_links"] for r in embedding_components(frame, shard_rows=100, probes=4).collect()}
    assert all(got[i] <= n for i, n in enumerate(linked.sum(axis=1)))
    assert sum(got.values()) >= 0.99 * linked.sum()


def test_pruned_lists_are_short_and_lead_everywhere():
    x = diffuse(600, 16, np.random.default_rng(2))
    lists = flat_graph_dedup.pruned(x)
    assert max(map(len, lists)) <= 20
    similar = x @ x.T
    for i in range(0, 600, 50):  # no kept neighbour is reached better through an earlier one
        for n, b in enumerate(lists[i]):
            assert all(1.2 * np.sqrt(2 - 2 * similar[a, b]) > np.sqrt(2 - 2 * similar[i, b]) for a in lists[i][:n])
    graph = flat_graph_dedup.Graph(np.arange(600), pa.array([[]] * 600, pa.list_(pa.int64())), x, 7)
    reached, front = {7}, {7}
    while front := set(graph.of(np.array(sorted(front)))[1].tolist()) - reached:
        reached |= front
    assert len(reached) == 600
    assert [len(p) for p in flat_graph_dedup.pruned(x[:1])] == [0]
