"""The replay of filters against a document-by-document version."""

import re
from collections import defaultdict
from itertools import permutations

from tidewater.llm.filter_replay import COUNTS, filter_interactions


def brute(rows, labels, least_words=200):
    good, toxic = ({i for i, *y in labels if y[k] == 1 and i is not None} for k in (0, 1))
    originals = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            originals[t or ""].append(i)
    out, shapley = defaultdict(lambda: [0] * 6), defaultdict(int)
    for i, t, part in rows:
        t, part = t or "", part or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < least_words,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and any(j < i for j in originals[t]),
        }
        for order in permutations("ABCDE"):
            gone = False
            for step, x in enumerate(order, 1):
                c = out[part, "".join(order), step]
                removed = fails[x] and not gone
                c[0] += not gone and not fails[x]
                c[1] += removed
                c[2] += fails[x] and gone
                c[3] += fails[x] and sum(fails.values()) == 1
                c[4] += removed and i in good
                c[5] += removed and i in toxic
                shapley[part, x] += removed
                gone |= removed
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def rows_of(df):
    assert df.columns == ["part", "filter_order", "step", *COUNTS, "shapley"]
    return sorted(map(tuple, df.collect()))


def test_replay_equals_brute_force_on_awkward_rows(spark):
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [
        (1, "a b c", "en"), (2, "a b c", "en"), (2, "a b c", "en"), (3, "a b c", None), (4, None, "en"), (5, "", ""), (6, " \t\n\x0b", "en"),
        (7, "A B C", "de"), (8, "x # y", "de"), (9, "la la la la", "fr"), (10, long, "fr"), (11, long, "de"), (None, "a b c", "en"), (None, None, None),
        (12, "ÄÖÜ é A", "de"), (13, "a b a b", "de"), (14, "one|two", "x'y"), (-5, "x # y", "de"),
    ]
    labels = [(1, 1, 0), (1, 0, None), (2, 1, 1), (7, 0, 1), (9, None, 1), (None, 1, 1), (99, 1, 1)]
    docs = spark.createDataFrame([(i, t, p, "x", 1, 2) for i, t, p in rows], "doc_id long, text string, lang string, part string, step int, fails int")
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert rows_of(filter_interactions(docs, frame, least_words=3)) == brute(rows, labels, 3)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_interactions(docs.limit(0), labels).count() == 0
    assert rows_of(filter_interactions(docs, labels)) == brute([(1, "a", "en")], [])


def test_one_text_held_by_most_rows(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 = 0, concat('own ', id), 'shared text') as text", "'en' as lang")
    found = {(r["filter_order"], r["step"]): r for r in filter_interactions(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"), least_words=0).collect()}
    shared = 5000 - 1667
    assert found["ABCDE", 5]["removed"] == found["EABCD", 1]["removed"] == shared - 1
    assert found["ABCDE", 5]["unique_fails"] == shared - 1 and found["ABCDE", 5]["shapley"] == 120 * (shared - 1)
