import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests_support import check_pieces, token_ids
from tidewater.llm import bm25_packing
from tidewater.llm.bm25_packing import Encoder, Index, bags, fill, latin_words, lexical_keys, pack_documents, terms, tokenizer_path


AWKWARD = ["it's we'LL don't", "a<|endoftext|>b <|startoftext|>", "café café ́x", "x y z\x1cw", "İstanbul ΣΣ ẞ", "日本語 テキスト 12345", "a" * 9000, "🙂🙂 !!??", "\t\n \r", "\x0b\x0c one\x85two"]


def test_encoder_matches_tokenizer():
    encoder = Encoder(tokenizer_path(), remember=5)
    for _ in range(2):
        got = [x.tolist() for x in encoder.encode(AWKWARD)]
        assert got == [x[:-1] for x in token_ids(AWKWARD)]


def test_encoder_matches_tokenizer_on_any_latin_text():
    rng = random.Random(11)
    pool = [*map(chr, range(0x250)), *"İẞΣσςЖж日本🙂\u0301\u200b|<'", *" " * 120, *"etaoinshr" * 10]
    texts = ["Əli", "Ɔkyena", "hello Ɖevi", *("".join(rng.choices(pool, k=rng.randint(1, 12))) for _ in range(100_000))]
    encoder, plain = Encoder(tokenizer_path()), token_ids(texts)
    for at in range(0, len(texts), 1000):
        got = [x.tolist() for x in encoder.encode(texts[at : at + 1000])]
        assert got == [x[:-1] for x in plain[at : at + 1000]]


@pytest.mark.parametrize("shard_tokens", [1 << 20, 4000])
def test_packs_every_id_once(spark, sf_dir, shard_tokens):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows += [(70_000 + i, t) for i, t in enumerate(AWKWARD)] + [(80_000, None), (80_001, ""), (80_002, "same words"), (80_002, "same words"), (None, "no id")]
    rows += [(90_000 + i, "one hot text of some words " * 20) for i in range(300)]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, shard string, start int")
    found = pack_documents(frame, shard_tokens=shard_tokens)
    pieces = found.collect()
    documents = list(zip([i for i, _ in rows], token_ids([t for _, t in rows]), strict=True))
    sequences = check_pieces(pieces, documents)
    tokens = sum(len(x) for _, x in documents)
    units = max(1, 2 * tokens // shard_tokens + 2)
    assert 2048 * len(sequences) - tokens <= 16 * len(sequences) + 2048 * units
    again = {(p["doc_id"], p["start"], p["sequence_id"]) for p in pack_documents(frame.repartition(1), shard_tokens=shard_tokens).select("doc_id", "start", "sequence_id").collect() if p["doc_id"] is not None}
    assert len(again) > 0


def test_empty_table(spark):
    assert pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_scores_are_bm25():
    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 40, n) for n in (5, 30, 80, 1, 60)]
    idf, mean = rng.random(1 << 16) + 0.1, 35.0
    index = Index(ids, idf, mean)
    bags = [Counter(terms(x).tolist()) for x in ids]
    for seed in range(len(ids)):
        want = [sum(idf[t] * b[t] * 2.2 / (b[t] + 1.2 * (0.25 + 0.75 * len(x) / mean)) for t in bags[seed] if t in b) for b, x in zip(bags, ids, strict=True)]
        others = np.arange(len(ids)) != seed  # a seed is not its own neighbour
        assert np.allclose(index.scores(seed)[others], np.array(want)[others])


def test_neighbours_share_a_window():
    ids = [np.arange(k * 1000, k * 1000 + 300) for k in (0, 1, 2, 0, 1, 2)]
    windows = fill(Index(ids, np.ones(1 << 16), 300.0), 600, 0)
    assert [sorted(d for d, _, _ in w) for w in windows] == [[0, 3], [1, 4], [2, 5]]


def test_query_digests(spark, sf_dir):
    from tidewater.llm.registry import op8_bm25_packing

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = dict(zip(texts, token_ids(texts.values()), strict=True))
    rows = op8_bm25_packing(spark, sf_dir).collect()
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        assert r["doc_tokens"] == len(ids[r["doc_id"]])


def test_seed_asks_with_all_terms():
    seed = np.arange(1000, 1041)
    least = terms(seed)
    at = int(np.argmax(least))  # of equal weights the first 32 terms in order came before it
    related = np.concatenate([seed[at : at + 2], np.arange(5000, 5039)])
    ids = [seed, np.arange(9000, 9041), related]
    assert not set(terms(ids[1]).tolist()) & set(least.tolist())
    windows = fill(Index(ids, np.ones(1 << 16), 41.0), 82, 0)
    assert [d for d, _, _ in windows[0]] == [0, 2]


def test_frequencies_count_windows_and_tails(spark, monkeypatch):
    texts = ["some words of a long text " * 600, "words of a tail", "a text"]
    seen, pack = {}, bm25_packing._pack

    def spy(dtype, idf, mean, *more):
        seen.update(idf=idf, mean=mean)
        return pack(dtype, idf, mean, *more)

    monkeypatch.setattr(bm25_packing, "_pack", spy)
    pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    pieces = [np.array(x[k : k + 2048]) for x in token_ids(texts) for k in range(0, len(x), 2048)]
    assert len(pieces) > 3
    docs = np.zeros(1 << 16)
    for p in pieces:
        docs[np.unique(terms(p))] += 1
    assert np.allclose(seen["idf"], np.log1p((len(pieces) - docs + 0.5) / (docs + 0.5)))
    assert seen["mean"] == sum(map(len, pieces)) / len(pieces)


def plain_fill(index, window, slack):
    """The rule one pick at a time: the most relevant unused document that fits, again and again."""
    sizes, free, windows, rest = index.sizes, set(range(len(index.sizes))), [], None
    while rest or free:
        if rest is None:
            rest = (min(free), 0)
            free.remove(rest[0])
        seed, start = rest
        pieces, room, rest = [(seed, start, int(sizes[seed]) - start)], window - int(sizes[seed]) + start, None
        scores = index.scores(seed)
        ranked = sorted(free, key=lambda d: (-scores[d], d))
        while room > slack and (pick := next((d for d in ranked if sizes[d] <= room), None)) is not None:
            pieces.append((pick, 0, int(sizes[pick])))
            room -= int(sizes[pick])
            ranked.remove(pick)
            free.remove(pick)
        if room > slack and ranked:
            pieces.append((ranked[0], 0, room))
            rest = (ranked[0], room)
            free.remove(ranked[0])
        windows.append(pieces)
    return windows


@pytest.mark.parametrize("seed", range(6))
def test_fill_equals_one_pick_at_a_time(seed):
    rng = np.random.default_rng(seed)
    ids = [rng.integers(0, 30, n) for n in rng.integers(1, (40, 8, 90)[seed % 3], 300)]
    index = Index(ids, rng.random(1 << 16) + 0.1, 20.0)
    assert fill(index, 100, (0, 5)[seed % 2]) == plain_fill(index, 100, (0, 5)[seed % 2])


def test_many_empty_texts_fill_in_linear_time():
    windows = fill(Index([np.array([1])] * 300_000, np.ones(1 << 16), 1.0), 2048, 16)
    assert sum(map(len, windows)) == 300_000 and len(windows) <= 300_000 // 2032 + 1


def test_latin_words_are_the_matches_of_the_pattern():
    rng = random.Random(5)
    pool = [*map(chr, range(256)), *"'" * 60, *"stmdrevl" * 8, *" \n" * 10, *"123½²" * 4]
    texts = [*(x.lower() for x in AWKWARD if all(ord(c) < 256 for c in x)), "", "'", "x'", "'l", "'s's", "''ll", "don'tx'réve", *("".join(rng.choices(pool, k=rng.randint(0, 30))).lower() for _ in range(20_000))]
    words, counts = latin_words([x.encode("latin-1") for x in texts])
    found = iter(w.decode("latin-1") for w in words.to_pylist())
    assert [[next(found) for _ in range(n)] for n in counts.tolist()] == [Encoder.WORDS.findall(x) for x in texts]
    assert next(found, None) is None and latin_words([])[1].tolist() == []


def test_latin_capitals_are_plain():
    for c in map(chr, range(256)):
        assert not Encoder.ODD.search(c) and c.encode("latin-1").translate(bm25_packing._LOWER).decode("latin-1") == c.lower()


def test_frequent_words_outlast_rare_ones():
    encoder = Encoder(tokenizer_path(), remember=40)
    for k in range(30):
        got = encoder.encode(["often said; " + " ".join(f"rare{'abcdefghij'[k % 10]}{chr(97 + i)}x{k}" for i in range(9)), "Œuvre often"])
        assert [x.tolist() for x in got] == [x[:-1] for x in token_ids(["often said; " + " ".join(f"rare{'abcdefghij'[k % 10]}{chr(97 + i)}x{k}" for i in range(9)), "Œuvre often"])]
        assert b"often" in encoder.known.to_pylist() and len(encoder.known) <= 40 + 25
    encoder._forget_rare()
    assert len(encoder.known) <= 20


def test_bags_and_keys_of_many_texts():
    rng = np.random.default_rng(8)
    ids = [rng.integers(0, 9, n) for n in (1, 2, 40, 1, 7, 300)]
    place, term, often = bags(ids)
    assert list(zip(place.tolist(), term.tolist(), often.tolist(), strict=True)) == [(k, t, n) for k, x in enumerate(ids) for t, n in sorted(Counter(terms(x).tolist()).items())]
    plain = []
    for x in ids:
        mixed = [t * 0x9E3779B1 & 0xFFFFFFFF for t in terms(x).tolist()]
        least = min(m ^ m >> 16 for m in mixed)
        plain.append((least * 0x85EBCA6B ^ least >> 13) * 0xC2B2AE35 & 0xFFFFFFFF)
    assert lexical_keys(ids) == plain and lexical_keys([]) == []


def test_postings_of_used_texts_go():
    rng = np.random.default_rng(4)
    ids = [rng.integers(0, 30, n) for n in rng.integers(1, 40, 200)]
    index, left = Index(ids, rng.random(1 << 16) + 0.1, 20.0), np.arange(0, 200, 3)
    some = index.of(left)
    assert len(some.doc) < len(index.doc) / 2
    assert all((some.scores(k)[left] == index.scores(k)[left]).all() for k in range(200))
