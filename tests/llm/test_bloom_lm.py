"""Language-model scores against a version with exact counts of words and bigrams."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import bloom_lm
from tidewater.llm.bloom_lm import Filter, bloom, count_of, level_of, score_texts, word_hashes

AWKWARD = [(90_001, None), (90_002, ""), (90_003, " \n\t\x0b"), (90_004, "É É é A a\x0bb\x85c x\xa0y"), (90_005, "long " * 300_000), (90_006, "x" * 3_000_000), (90_007, "twin one"), (90_007, "twin one"), (None, "no id")]


def tokens_of(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def plain(rows, folds=7, held=2):
    """(id, held out, tokens, known, N, base, model) with exact counts in place of the filter."""
    held_out = lambda i: zlib.crc32(str("" if i is None else i).encode()) % folds == held
    words, pairs = Counter(), Counter()
    for i, t in rows:
        if not held_out(i):
            x = tokens_of(t)
            words.update(x)
            pairs.update(zip([0, *x[:-1]], x, strict=True))
    n, v = sum(words.values()), len(words)
    starts = sum(c for (a, _), c in pairs.items() if a == 0)
    base = lambda w: math.log10((words[w] + 1) / (n + v + 1))
    middle = lambda c: math.sqrt(2 ** (c.bit_length() - 1) * (2 ** c.bit_length() - 1)) if c else 0
    levels = Counter(), Counter()
    for c in words.values():
        levels[0][c.bit_length()] += 1
        levels[1][c.bit_length()] += c
    low, high = 0.0, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (p, high) if sum(k * (levels[1][q] / k) ** p for q, k in levels[0].items()) < len(pairs) else (low, p)
    found = []
    for i, t in rows:
        x, model = tokens_of(t), 0.0
        for a, w in zip([0, *x[:-1]], x, strict=True):
            c1, c2 = middle(starts if a == 0 else words[a]), middle(pairs[a, w])
            t = c1**low if c1 else 1.0
            model += math.log10(min(1.0, c2 / (c1 + t))) if c2 else base(w) + (math.log10(t / (c1 + t)) if c1 else 0.0)
        found.append((i, held_out(i), len(x), sum(words[w] > 0 for w in x), n, sum(map(base, x)), model))
    return found


def check(got, want, share=0.0, slack=1e-9):
    key = lambda r: (r[0] is None, r[0] or 0)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    a, b = np.array([r[6] for r in got]), np.array([r[6] for r in want])
    assert np.mean(np.abs(a - b) > slack * np.abs(b) + 1e-9) <= share
    assert (a <= 1e-12).all()
    return a, b


@pytest.mark.parametrize("limits", [{}, {"broadcast_words": 50}, {"filter_bytes": 20_000, "broadcast_words": 1000}, {"filter_bytes": 20_000, "broadcast_words": 0}])
def test_equals_exact_counts(spark, sf_dir, limits, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + AWKWARD
    frame = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, id string, hash int, row int")
    # One absent entry in 256 is taken for present, so texts are a little off, and short ones rarely.
    a, b = check(score_texts(frame, **limits).collect(), plain(rows), share=1.0)
    assert np.abs(a - b).sum() <= 0.02 * np.abs(b).sum()
    assert a.sum() > sum(r[5] for r in plain(rows))


def test_texts_without_a_false_positive_are_exact(spark):
    rows = [(i, " ".join(f"w{(i * k) % 7}" for k in range(1, i % 9 + 2))) for i in range(40)]
    check(score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect(), plain(rows), share=0.3)


def test_groups_of_the_filter_read_each_token_once(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    read, frame, width = [], type(docs), {"tokens": 2, "hashes": 8}
    apply = frame.mapInArrow

    def counted(self, *args):
        read.extend(self.agg(F.sum(F.octet_length(c)) / width[c]).first()[0] or 0 for c in self.columns if c in width)
        return apply(self, *args)

    monkeypatch.setattr(frame, "mapInArrow", counted)
    tokens = score_texts(docs, filter_bytes=20_000).agg(F.sum("n_tokens")).first()[0]
    assert len(read) > 4 and sum(read) == tokens


def test_nothing_to_learn_from(spark):
    rows = [(i, "a b") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r)[1:] for r in score_texts(frame).collect()} == {(True, 3, 0, 0, 0.0, 0.0)}
    assert score_texts(frame.limit(0)).count() == 0


def test_word_hashes_part_texts_and_fold_case():
    texts = [b"One two", b"", b"TWO  one\x0bthree", b" \n", b"x" * 5000, b"xx"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    hashes, counts = word_hashes(data, np.cumsum([0, *map(len, texts)]))
    assert counts.tolist() == [2, 0, 3, 0, 1, 1] and len(set(hashes.tolist())) == 5
    assert hashes[0] == hashes[3] and hashes[1] == hashes[2]
    whole = np.frombuffer(b"ab " * 900_000 + b"y" * 1_500_000 + b" ab", np.uint8)
    assert (bloom_lm._long_hashes(whole) == word_hashes(whole, np.array([0, len(whole)]))[0]).all()


def test_filter_finds_every_level_and_few_others():
    rng = np.random.default_rng(1)
    keys, counts = rng.integers(1, 1 << 60, 20_000, np.uint64), rng.integers(1, 1000, 20_000)
    bits, size = bloom(keys, level_of(counts))
    held = Filter(bits, np.zeros((3, 1), np.int64), np.full((3, 1), size, np.uint64))
    found = held.levels(1, np.zeros(20_000, np.int64), keys)
    assert (found >= level_of(counts)).all() and np.mean(found > level_of(counts)) < 0.01
    assert np.mean(held.levels(1, np.zeros(20_000, np.int64), keys + np.uint64(1)) > 0) < 0.01
    middle = count_of(level_of(counts))
    assert (middle >= counts / 2).all() and (middle <= counts * 2).all()
