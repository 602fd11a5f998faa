"""The pipeline against a brute-force version: every stage is judged on its own input."""

import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

import corpus_pipeline
from tests_support import check_pieces, near_links, plain_shingles, roots, token_ids, words_shared
from tidewater.llm.simhash_tiles import drop_near_duplicates
from tidewater.llm.store import written
from tidewater.llm.toxic_lexicon import features, induce
from tidewater.llm.sampling import remainder

ROWS_PER_CLASS = 6000


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(written(stage(spark, found[-1], sf_dir), name.replace(" ", "-")))
    return found


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_toxicity(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = dict(rows(stages[0]))
    train = {r["doc_id"]: r["toxic"] for r in labels.filter(remainder("doc_id", 5) != 0).collect()}
    pairs = sorted((train[i], t) for i, t in texts.items() if i in train)
    lexicon = induce([t for _, t in pairs], [y for y, _ in pairs])
    automaton = lexicon.automaton()
    a, b, c = lexicon.curve
    margin = {i: a + b * x + c * y for i, (x, y) in ((i, features(automaton, lexicon.exceptions, t)) for i, t in texts.items())}
    assert {i for i, _ in rows(stages[1])} == {i for i in texts if margin[i] < 0}


def test_exact(stages):
    last = {}
    for i, t in rows(stages[1]):
        last[t] = max(i, last.get(t, i))
    assert sorted(rows(stages[2])) == sorted((i, t) for t, i in last.items())


def test_near(stages):
    docs = sorted(rows(stages[2]))
    links = near_links([t for _, t in docs])
    root = roots(len(docs), links)
    assert sorted(i for i, _ in rows(stages[3])) == [docs[k][0] for k in range(len(docs)) if root[k] == k]
    texts = [t for _, t in docs]
    assert links and all(words_shared(texts[a], texts[b]) > 0.7 for a, b in links)  # nothing unlike is linked


def test_near_copies_are_found(spark):
    """Recall on planted near copies: at least 0.95 of those whose shingles have Jaccard 0.5 or more."""
    docs = sorted(rows(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")))
    texts = {t: i for i, t in docs}
    kept = {i for i, _ in rows(drop_near_duplicates(spark.createDataFrame([(i, t) for t, i in texts.items()], "doc_id long, text string")))}
    shingles = [(i, t, plain_shingles(t)) for t, i in texts.items()]
    owners = defaultdict(list)
    for k, (_, _, s) in enumerate(shingles):
        for x in s:
            owners[x].append(k)
    common = Counter(pair for ks in owners.values() for pair in combinations(ks, 2))
    near = [(a, b) for (a, b), n in common.items() if n / (len(shingles[a][2]) + len(shingles[b][2]) - n) >= 0.5]
    gone = [any(shingles[k][0] not in kept for k in pair) for pair in near]
    assert len(near) > 20 and sum(gone) >= 0.95 * len(gone)
    for i, t, _ in shingles:  # whatever goes is like another text
        if i not in kept:
            assert max(words_shared(t, u) for j, u, _ in shingles if j != i) > 0.7


def test_mix(stages):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    before, after = stages[3].collect(), stages[4].collect()
    sizes, drawn = Counter(), Counter()
    for r in before:
        sizes[r["source"]] += size(r["text"])
    for r in after:
        drawn[r["source"]] += size(r["text"])
    uses = Counter(r["doc_id"] for r in after)
    assert max(uses.values()) <= 2 and set(uses) <= {r["doc_id"] for r in before}
    total, capped = sum(sizes.values()), [s for s in sizes]
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes))}
    targets, left = {}, 1.5 * total
    while True:
        share = {s: left * weights[s] / sum(weights[x] for x in capped) for s in capped}
        over = [s for s in capped if share[s] > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            targets[s] = 2 * sizes[s]
            left -= targets[s]
            capped.remove(s)
    targets |= share
    longest = max(size(r["text"]) for r in before)
    assert all(abs(drawn[s] - targets[s]) <= longest for s in sizes)


def test_packing(stages):
    docs = rows(stages[4])
    check_pieces(stages[5].collect(), list(zip([i for i, _ in docs], token_ids([t for _, t in docs]), strict=True)))


def test_run(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    key = ("doc_id", "start", "length", "doc_tokens")
    assert Counter(tuple(r) for r in got.select(*key).collect()) == Counter(tuple(r) for r in stages[5].select(*key).collect())
