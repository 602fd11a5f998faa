import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import cross_parse_langid as langid
from tidewater.llm.cross_parse_langid import identify_language
from tidewater.llm.fm_quality import BUCKETS, Model, _Buckets, row_features, score_quality
from tidewater.llm.sampling import hash_limit, labelled_sample
from tidewater.llm.toxic_lexicon import Lexicon, drop_toxic, features, fold, induce, score_toxicity

AWKWARD = [(90_001, None), (90_002, ""), (90_003, " \n\t"), (90_004, "12 34 !!"), (90_007, "½ ² ①"), (90_005, "word " * 60_000), (90_006, "twin"), (90_006, "twin"), (None, "no id")]


@pytest.fixture(scope="module")
def big(spark):
    return "/root/testdata/sf0.01"


def with_awkward(spark, docs):
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in AWKWARD], docs.schema)
    return docs.unionByName(more).selectExpr("*", "1 as score", "'x' as predicted", "'x' as id", "'x' as label")


def crc(i, modulus):
    return zlib.crc32(str("" if i is None else i).encode()) % modulus


def accuracy(rows, truth):
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 20
    return np.mean([r["predicted"] == truth[r["doc_id"]] for r in held])


@pytest.mark.parametrize(("name", "score", "modulus", "held", "threshold"), [("toxic", score_toxicity, 5, 0, 0.5), ("quality", score_quality, 4, 2, 0.7)])
def test_classifiers(spark, big, name, score, modulus, held, threshold):
    docs = with_awkward(spark, spark.read.parquet(f"{big}/documents.parquet"))
    labels = spark.read.parquet(f"{big}/labels.parquet")
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= threshold) and r["held_out"] == (crc(r["doc_id"], modulus) == held)
    truth = {r["doc_id"]: r[name] for r in labels.collect()}
    assert accuracy(rows, truth) >= 0.9
    # Held-out labels are not looked at.
    blind = labels.filter(f"crc32(cast(cast(doc_id as string) as binary)) % {modulus} <> {held}")
    assert sorted(map(str, rows)) == sorted(map(str, score(docs, blind).collect()))
    unlabelled = score(docs, labels.limit(0)).select("score").distinct().collect()
    assert len(unlabelled) == 1
    assert score(docs.limit(0), labels).count() == 0


def test_drop_toxic_keeps_clean(spark, big):
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    kept = drop_toxic(docs, labels)
    assert kept.schema == docs.schema
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    clean, toxic = [i for i, y in truth.items() if not y], [i for i, y in truth.items() if y]
    assert sum(i in ids for i in clean) >= 0.99 * len(clean)
    assert sum(i not in ids for i in toxic) >= 0.7 * len(toxic)  # four languages, some forty labelled examples


def test_folding():
    assert fold("ID10T 1d!ot іdіоt idïot") == "idiot idiot idiot idiot"
    assert fold("$cum $ 5 wow!") == "scum $ s wow!"
    assert fold("sc​um ＩＤＩＯＴ") == "scum idiot"


def test_lexicon_induction_stems_and_exceptions():
    rng = np.random.default_rng(0)
    plain = [f"w{i}x" for i in range(200)]
    say = lambda n: " ".join(rng.choice(plain, n))
    clean = [say(30) for _ in range(200)] + [say(10) + " trash can " + say(10) for _ in range(4)]
    toxic = [f"{say(20)} zorg{rng.integers(99)}q {say(5)} trash {say(9)}" for _ in range(60)]
    lexicon = induce(clean + toxic, [0] * len(clean) + [1] * len(toxic))
    assert any("zorg".startswith(t.strip()) or t.startswith("zorg") for t in lexicon.weights)
    automaton = lexicon.automaton()
    assert features(automaton, lexicon.exceptions, "a zorg77z here")[0] > 0
    assert features(automaton, lexicon.exceptions, "a trash can here")[0] == 0 < features(automaton, lexicon.exceptions, "what tr4sh here")[0]
    assert features(automaton, lexicon.exceptions, "untrash mezorg")[0] == 0
    assert induce([], []).weights == induce(["a"], [1]).weights == {}


def test_longest_entry_of_a_word_counts_once():
    lexicon = Lexicon({"stup": 1.0, "stupi": 2.0, "stupid ": 5.0})
    assert np.isclose(features(lexicon.automaton(), set(), "stupid")[0], np.log1p(5.0))
    assert np.isclose(features(lexicon.automaton(), set(), "stupider x stupefy")[0], np.log1p(2.0 + 1.0))


def test_pairwise_identity():
    rng = np.random.default_rng(1)
    d = BUCKETS + 16
    model = Model(0.3, rng.normal(size=d), rng.normal(size=(d, 3)), np.zeros(16), np.ones(16))
    rows = [row_features(t, None, _Buckets()) for t in ("some words | here", "")]
    x = model.inputs(rows).astype(float)
    for row, margin in zip(x, model.margin(x), strict=True):
        on = np.flatnonzero(row)
        pairs = sum(model.factors[i] @ model.factors[j] * row[i] * row[j] for k, i in enumerate(on) for j in on[k + 1 :])
        assert np.isclose(margin, 0.3 + row @ model.linear + pairs)


def test_automaton_accepts_exactly_the_substrings():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 3, 60)
    step = langid.suffix_automaton(text, 3)
    have = {tuple(text[i:j]) for i in range(60) for j in range(i, 61)}
    for _ in range(400):
        word = tuple(rng.integers(0, 3, rng.integers(1, 9)))
        state = 0
        for s in word:
            state = step[state, s] if state >= 0 else -1
        assert (state >= 0) == (word in have)


def test_costs_match_plain_parsing():
    texts = {"aa": "the cat sat on the mat. THE END" * 3, "bb": "ein hund saß auf der straße " * 3}
    model = langid.learn(texts)

    def plain(text, trained):
        codes = lambda t: "".join(map(chr, langid.squeeze(model.symbol[np.frombuffer(t.lower().encode(), np.uint8)])))
        known = codes(trained).replace(chr(0), "")
        text, phrases, open_phrase = codes(text), 1, ""
        for c in text:
            if c != chr(0) and open_phrase + c in known:
                open_phrase += c
            else:
                phrases, open_phrase = phrases + 1, c if c != chr(0) and c in known else ""
        return phrases / len(text)

    for text in ("the dog sat", "auf der matte", "čžš ß x", "Q"):
        assert np.allclose(model.costs([text])[0], [plain(text, texts[k]) for k in model.names])


def test_shares_and_symbols():
    assert langid.equal_shares(["aaaa", "b", "cccccc"], 7) == "aaa b ccc"
    assert langid.equal_shares(["aa", "b"], 100) == "aa b"
    assert langid.equal_shares([], 5) == ""
    # Every script keeps its letters, however many there are.
    scripts = {k: "".join(map(chr, range(at, at + 200))) for k, at in (("zh", 0x4E00), ("ar", 0x620), ("ka", 0x10D0), ("en", 0x61))}
    model = langid.learn(scripts)
    assert all((model.symbol[list(t.lower().encode())] > 0).all() for t in scripts.values())
    with pytest.raises(ValueError, match="lower sample_chars"):
        langid.merged({"a": langid.trained("some text")}, table_bytes=10)


@pytest.mark.parametrize(("text", "want"), [("½ ² ① Ⅷ", False), ("½ x", True), ("日", True), ("", False), ("12_", False)])
def test_letters(text, want):
    assert langid.has_letter(text) is want


def test_identify_language(spark, big):
    docs = with_awkward(spark, spark.read.parquet(f"{big}/documents.parquet"))
    rows = identify_language(docs).collect()
    assert len(rows) == docs.count()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.95
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (90_001, 90_002, 90_003, 90_004, 90_007))
    assert all(by_id[i]["lang_pred"] in {"en", "fr", "de", "es"} for i in (90_005, 90_006))
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in rows)
    none = identify_language(docs.withColumn("lang", docs["lang"].substr(1, 0)).filter("lang is null"))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert identify_language(docs.limit(0)).count() == 0


def test_hash_limit_keeps_the_least_hashes(spark):
    assert hash_limit(100, 1200) == (1 << 63) - 1
    ids = spark.range(50_000).toDF("doc_id")
    least = ids.orderBy(F.xxhash64("doc_id")).limit(100)
    labels = ids.select("doc_id", F.lit(1).alias("toxic"))
    assert ids.filter(F.xxhash64("doc_id") <= hash_limit(100, 50_000)).count() < 1600
    found = labelled_sample(ids.withColumn("text", F.col("doc_id").cast("string")), labels, "doc_id", "text", "toxic", 100)
    assert {int(r["text"]) for r in found.collect()} == {r["doc_id"] for r in least.collect()}


def test_labelled_sample_is_bounded_in_rows_and_bytes(spark):
    ids = spark.range(1, 301).withColumnRenamed("id", "doc_id")
    labels = ids.withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    copies = spark.range(50_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("copy "), F.col("id").cast("string")).alias("text"))
    docs = ids.select("doc_id", F.repeat(F.lit("x"), 100).alias("text")).unionByName(copies)
    found = labelled_sample(docs, labels, "doc_id", "text", "toxic", 200)
    rows = found.collect()
    assert len(rows) == 300 and sum(r["text"].startswith("copy") for r in rows) == 1
    short = labelled_sample(docs, labels, "doc_id", "text", "toxic", 200, bytes_per_class=1000).groupBy("label").agg(F.sum(F.length("text")).alias("n")).collect()
    assert len(short) == 2 and all(900 <= r["n"] <= 1000 for r in short)


def test_labels_of_one_id_that_differ_count_as_the_larger(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, None)], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, labelled_sample(docs, labels, "doc_id", "text", "toxic", 9).collect())) == [(0, ""), (1, "a")]


def test_drop_toxic_on_awkward_rows(spark, big):
    docs = spark.read.parquet(f"{big}/documents.parquet")
    labels = spark.read.parquet(f"{big}/labels.parquet")
    toxic = docs.join(labels.filter("toxic = 1").select("doc_id"), "doc_id").orderBy("doc_id").select(docs.columns).limit(3)
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in AWKWARD], docs.schema)
    twice = toxic.unionByName(toxic).withColumn("doc_id", F.lit(None).cast("long"))
    rows = more.unionByName(twice).selectExpr("*", "1 as score", "'x' as label", "2 as hash", "'y' as row")
    # The lexicon is learned from the given table, so the labelled rows come along.
    whole = docs.selectExpr("*", "1 as score", "'x' as label", "2 as hash", "'y' as row").unionByName(rows)
    kept = drop_toxic(whole, labels)
    assert kept.schema == whole.schema
    found = kept.filter("doc_id is null or doc_id > 90000").collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in found) == sorted((i or 0, t or "") for i, t in AWKWARD)
    assert drop_toxic(whole.limit(0), labels).count() == 0
    assert drop_toxic(rows, labels.limit(0)).count() == rows.count()
