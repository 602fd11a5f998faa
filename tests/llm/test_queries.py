"""The registered queries against brute-force versions and DuckDB on the small tables."""

import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

from tests_support import plain_fingerprint, roots
from tidewater.llm import registry


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, sf_dir, tables, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    want = tables.sql(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    plain = lambda df: sorted(tuple("" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))
    assert plain(got) == plain(want)


def test_op5(spark, sf_dir, tables):
    rows = sorted(tables.sql("select doc_id, text from documents").fetchall())
    prints = [plain_fingerprint(t) for _, t in rows]
    root = roots(len(rows), [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4])
    got = sorted(tuple(r) for r in registry.op5_simhash_dedup(spark, sf_dir).select("doc_id", "fingerprint", "component_id").collect())
    assert got == [(i, f"{p:016x}", rows[k][0]) for (i, _), p, k in zip(rows, prints, root, strict=True)]


def test_op6(spark, sf_dir, tables):
    rows = sorted(tables.sql("select doc_id, text from documents").fetchall())
    total, at, slots, want = sum(len((t or "").encode()) + 1 for _, t in rows), 0, {}, []
    for i, t in rows:
        size, shard = len((t or "").encode()) + 1, at * 16 // total
        want.append((i, size, zlib.crc32((t or "").encode()), "bytes", shard, slots.get(shard, 0), None))
        slots[shard] = slots.get(shard, 0) + 1
        at += size
    got = registry.op6_byte_shards(spark, sf_dir).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()
    assert sorted(map(tuple, got)) == want


def test_op9(spark, sf_dir, tables):
    rows = sorted(tables.sql("select vec_id, embedding, label from embeddings").fetchall())
    x = np.array([v for _, v, _ in rows], dtype=float)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    label = np.array([c for _, _, c in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    root = roots(len(rows), list(zip(*np.nonzero(near), strict=True)))
    got = sorted(tuple(r) for r in registry.op9_embedding_dedup(spark, sf_dir).collect())
    assert got == [(i, int(n.sum()), rows[k][0], rows[k][0] == i) for (i, _, _), n, k in zip(rows, near, root, strict=True)]
