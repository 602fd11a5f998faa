import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewater.llm.byte_shards import byte_shards
from tidewater.llm.curriculum_mix import draw_mixture, mix_sources
from tidewater.llm.exact_dedup import drop_exact_duplicates, exact_dedup, grow_directory
from tidewater.llm.warc_fixity import VOLUME, fixity_audit, replica_layout, replica_store, warc_layout

ROWS = [(1, "a", "s1"), (2, "a", "s1"), (3, None, None), (4, "", "s2"), (5, "A", "s1"), (6, "x " * 40_000, "s2"), (6, "x " * 40_000, "s2"), (7, " a", None), (7, "b", "s3"), (None, "b", "s3"), (None, "only", "s1"), (9, "é" * 50, "s1")]
SCHEMA = "doc_id long, text string, source string, key int, size string, row long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 1, "clash", 2) for r in ROWS], SCHEMA)


def expected_groups():
    groups = defaultdict(list)
    for i, t, _ in ROWS:
        groups[t or ""].append(i)
    return groups


@pytest.mark.parametrize(("key_bits", "bucket_bytes"), [(64, 8 << 20), (64, 1), (1, 100), (0, 1)])
def test_exact_dedup(docs, key_bits, bucket_bytes):
    if key_bits == 0:
        docs, key_bits = docs.repartition(5), 3
    got = exact_dedup(docs, key_bits=key_bits, bucket_bytes=bucket_bytes, part_bytes=50).collect()
    assert len(got) == len(ROWS)
    groups = expected_groups()
    digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in got:
        ids = digest[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == max((i for i in ids if i is not None), default=None)
        kept[r["text_sha256"]] += r["kept"]
    assert all(kept[d] == 1 for d in digest)


def test_drop_exact_duplicates(docs):
    got = drop_exact_duplicates(docs)
    assert got.columns == docs.columns
    assert Counter(r["text"] or "" for r in got.collect()) == Counter(expected_groups().keys())
    assert got.select("size").distinct().collect()[0][0] == "clash"


def test_directory_doubles_only_overfull_buckets():
    weights = np.array([1, 1, 1, 1, 50, 1, 1, 1])
    assert grow_directory(weights, 100).tolist() == [0]
    assert grow_directory(weights, 5).tolist() == [0, 4, 5, 6]
    assert grow_directory(np.zeros(8, int), 5).tolist() == [0]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(empty).count() == byte_shards(empty).count() == mix_sources(empty).count() == draw_mixture(empty).count() == drop_exact_duplicates(empty).count() == 0


@pytest.mark.parametrize("slice_rows", [4000, 1])
def test_mix(spark, sf_dir, docs, slice_rows):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    rows = [*ROWS, *(tuple(r) for r in table.collect())]
    frame = docs.select("doc_id", "text", "source").unionByName(table)
    got = mix_sources(frame, slice_rows=slice_rows, with_source=True).collect()
    assert len(got) == len(rows)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += words(t)
    names = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_names, target = 1.5 * sum(sizes.values()), list(names), {}
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in open_names) for s in open_names}
        over = [s for s in open_names if share[s] > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_names.remove(s)
    target |= share
    taken = Counter()
    for r in got:
        s = r["source"]
        assert r["source_size"] == sizes[s]
        assert math.isclose(r["target"], target[s], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert (r["position"] is not None) == (r["taken"] > 0)
        assert r["position"] is None or 0 <= r["position"] <= (r["again"] or 1) <= 1
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in names)
    places = [r["position"] for r in got if r["position"] is not None]
    assert places == sorted(places)
    # By time t a source has given the integral of its weight schedule.
    for k, s in enumerate(names):
        if target[s] > 20_000:
            slope = (0.5, 0.0, -0.5)[k % 3]
            mine = [r for r in got if r["source"] == s]
            early = sum(min(r["taken"], r["size"]) for r in mine if r["position"] is not None and r["position"] <= 0.5) + sum(r["taken"] - r["size"] for r in mine if r["again"] is not None and r["again"] <= 0.5)
            assert abs(early - target[s] * ((1 - slope) / 2 + slope / 4)) <= max(r["size"] for r in mine)


def test_draw_mixture(docs):
    got = draw_mixture(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    uses = Counter((r["doc_id"], r["text"], r["source"]) for r in rows)
    copies = Counter(ROWS)
    assert all(n <= 2 * copies[k] for k, n in uses.items())
    assert all(uses[k] >= 1 for k in copies if not (k[1] or "").strip())


def test_byte_shards(spark, sf_dir, docs):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    frame = docs.select("doc_id", "text").unionByName(table)
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    for per_part in (20_000, 9):
        got = byte_shards(frame, rows_per_part=per_part).collect()
        want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows), key=lambda x: (x[0] is not None, x[0] or 0, x[2], x[1]))
        total, at, slots, expected = sum(w[1] for w in want), 0, Counter(), []
        for i, size, crc in want:
            shard = at * 16 // total
            expected.append((i, size, crc, "bytes", shard, slots[shard], None, at))
            slots[shard] += 1
            at += size
        assert sorted(map(tuple, got), key=lambda r: r[7]) == expected


def test_fixity(spark):
    rows = [(i, f"http://h/{i}", f"<p>é{i}</p>" * (i % 5)) for i in range(VOLUME + 300)] + [(7, None, None), (7, None, None), (None, "u", "")]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, slot int, record string")
    layout = warc_layout(pages, rows_per_part=700)
    assert layout.count() == len(rows)
    store = replica_store(pages, one_in=1 << 40)
    clean = fixity_audit(layout, replica_layout(store, rows_per_part=900))
    assert clean.filter("not intact or root <> replica_root").count() == 0
    content = {(r["id"], r["name"]): bytes(r["content"]) for r in store.collect()}
    places = {(r["volume"], r["slot"]): r for r in layout.collect()}
    at = 0
    for (volume, slot), r in sorted(places.items()):  # records lie one behind the other in their volume
        at = at if slot else 0
        assert (r["offset"], r["length"]) == (at, len(content[r["id"], r["sha256"]])) and content[r["id"], r["sha256"]].startswith(b"WARC/1.1")
        at += r["length"]

    def audited(records):
        found = fixity_audit(layout, replica_layout(spark.createDataFrame(records, "id long, name string, content binary"))).collect()
        return {(r["volume"], r["slot"]) for r in found if not r["intact"]}, {r["volume"] for r in found if r["root"] != r["replica_root"]}

    whole = [(r["id"], r["name"], bytes(r["content"])) for r in store.collect()]
    slots = {v: sum(p[0] == v for p in places) for v in (0, 1)}
    # Bytes that changed in place are found one by one.
    hurt = [(0, 5), (0, 4000), (1, 17)]
    wrong = {places[p]["id"] for p in hurt}
    flipped = [(i, n, bytes(b ^ (k == 30) for k, b in enumerate(c)) if i in wrong else c) for i, n, c in whole]
    assert audited(flipped) == (set(hurt), {0, 1})
    # One of two equal records is hurt: one of their places is found, next to each other.
    twice = next(k for k, r in enumerate(whole) if r[0] == 7 and sum(x[:2] == r[:2] for x in whole) == 2)
    damaged, _ = audited([*whole[:twice], (*whole[twice][:2], b"hurt"), *whole[twice + 1 :]])
    assert len(damaged) == 1 and {places[p]["id"] for p in damaged} == {7}
    # A record that got longer shifts the ranges behind it, which the roots show; the records are intact.
    longer = [(i, n, c + b"x") if i == places[1, 17]["id"] else (i, n, c) for i, n, c in whole]
    assert audited(longer) == ({(1, 17)}, {1})
    # A lost record moves all behind it, also in the volumes behind.
    lost = places[0, 4000]["id"]
    assert audited([r for r in whole if r[0] != lost]) == ({(0, k) for k in range(4000, slots[0])} | {(1, k) for k in range(slots[1])}, {0, 1})
    # An inserted one does so from its place on.
    extra = (places[1, 100]["id"], "", b"inserted")
    assert audited([*whole, extra]) == ({(1, k) for k in range(100, slots[1])}, {1})
    # Two records that stand in each other's place are both found.
    a, b = (next(k for k, r in enumerate(whole) if r[0] == places[p]["id"]) for p in ((0, 900), (1, 200)))
    swapped = [*whole]
    swapped[a], swapped[b] = (*whole[a][:2], whole[b][2]), (*whole[b][:2], whole[a][2])
    assert audited(swapped) == ({(0, 900), (1, 200)}, {0, 1})
    assert fixity_audit(layout.limit(0), replica_layout(store)).count() == 0
    assert fixity_audit(layout, replica_layout(store.limit(0))).filter("intact").count() == 0
