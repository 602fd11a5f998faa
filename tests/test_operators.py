import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions import dates, text
from tidewater.functions.lexicon import Lexicon
from tidewater.operators import cluster, gates, joins, reports, score, state, windows


def one(spark, column, **values):
    kinds = {str: "string", int: "int", float: "double", bool: "boolean", dt.date: "date", list: "array<string>"}
    row = spark.range(1).select(*(F.lit(None).cast("string").alias(k) if v is None else F.lit(v).cast(kinds[type(v)]).alias(k) if not isinstance(v, list) else F.array(*map(F.lit, v)).alias(k) for k, v in values.items()))
    return row.select(column).first()[0]


@pytest.mark.parametrize(("body", "terms", "hit"), [("an ai chip", ["ai"], True), ("maize", ["ai"], False), ("c++ and go", ["c++"], True), ("50% up", ["%"], True), ("新聞发布", ["发布"], True), (None, ["a"], False), ("ai", [], False), ("q1-4 x", ["q1-4"], True)])
def test_has_any(spark, body, terms, hit):
    assert one(spark, text.has_any(F.col("t"), terms), t=body) is hit


def test_text_functions(spark):
    assert one(spark, text.normalized(F.col("t")), t="A&B's “New” — Deal!") == "a and bs new deal"
    assert one(spark, text.title_key(F.col("t")), t="Ab-C 9é") == "abc9"
    assert one(spark, text.tokens(F.col("t"), ["the"]), t="The big, big cat of it") == ["big", "cat"]
    assert one(spark, text.strip_publisher(F.col("t")), t="Deal - more | Wire") == "Deal"
    assert one(spark, text.strip_publisher(F.col("t")), t="No publisher") == "No publisher"
    assert one(spark, text.publisher_of(F.col("t")), t="Deal closes | Wire") == "Wire"
    assert one(spark, text.normalized_url(F.col("t")), t="HTTPS://www.Ex.com/a/b/?q=1#f") == "https://ex.com/a/b"
    assert one(spark, text.job_id(F.col("t")), t="https://x.com/jobs/1234567-data") == "1234567"
    assert one(spark, text.job_id(F.col("t")), t="https://x.com/jobs/lead/") == "lead"
    assert one(spark, text.shortened(F.col("t"), 5), t="abc  defg") == "abc d..."
    assert one(spark, text.has_cjk(F.col("t")), t="x新") is True
    assert one(spark, text.html_escaped(F.col("t")), t="<a href=\"x\">&'") == "&lt;a href=&quot;x&quot;&gt;&amp;&#x27;"
    assert one(spark, text.amount_millions(F.col("t")), t="raises $1.5B now") == 1500.0
    assert one(spark, text.amount_millions(F.col("t")), t="gets €20 million") == 20.0
    assert one(spark, text.amount_millions(F.col("t")), t="no money") is None
    assert one(spark, text.jaccard(F.array(), F.array()), t="") == 0.0


def test_dates(spark):
    day = dt.date(2024, 2, 29)
    assert one(spark, dates.strict_date(F.col("t")), t="2024-02-29T10:00") == day
    assert one(spark, dates.strict_date(F.col("t")), t="2024-2-9") is None
    assert one(spark, dates.strict_date(F.col("t")), t="2023-02-29") is None
    for url in ("https://a/2024/2/29/x", "https://a/x-2024-02-29", "https://a/x_20240229.html"):
        assert one(spark, dates.date_in_url(F.col("t")), t=url) == day
    assert one(spark, dates.date_in_url(F.col("t")), t="https://a/x") is None
    for words in ("on 2024-02-29", "Feb 29, 2024", "29 February 2024"):
        assert one(spark, dates.date_in_text(F.col("t")), t=words) == day
    assert one(spark, dates.iso_week(F.col("d")), d=dt.date(2027, 1, 1)) == "2026-W53"
    assert one(spark, dates.close(F.col("a"), F.col("b"), 2, True), a=day, b=None) is True
    times = spark.sql("select timestamp '2024-03-05 00:00:00' p, timestamp '2024-03-01 00:00:00' o").select(dates.publication(F.col("p"), F.col("o")).alias("x")).first()["x"]
    assert times["published_at"] is None and times["scheduled_at"] is not None and times["bucket"] == dt.date(2024, 3, 1) and times["basis"] == "observed_at"


def test_lexicon(spark):
    table = spark.createDataFrame([("b", 2, "beta"), ("a", 1, "alpha"), ("a", 3, "al")], "class string, ord int, term string")
    lexicon = Lexicon.of(table)
    assert lexicon.classes == (("a", ("alpha", "al")), ("b", ("beta",)))
    assert one(spark, lexicon.labels(F.col("t")), t="beta alpha") == ["a", "b"]
    assert one(spark, lexicon.first(F.col("t"), F.lit("z")), t="none") == "z"
    assert one(spark, lexicon.most(F.col("t"), "z"), t="beta") == "b"
    assert one(spark, lexicon.most(F.col("t"), "z"), t="gone") == "z"
    assert one(spark, lexicon.most(F.col("t"), "z"), t="beta al") == "a"  # of ties the first


PRODUCT = Lexicon((("policy", ("regulator",)), ("structural", ("market entry",)), ("digital", ("platform",)), ("industry_change", ("consolidation",)), ("action", ("launches",)), ("quantified", ("users",)), ("editorial", ("opinion",)), ("core", ("app",)), ("adjacent", ("telecom",)), ("edge", ("chip",)), ("out", ("mining",)), ("hard_out", ("missile",))))
SECTORS = Lexicon((("payments", ("payment",)), ("retail", ("shop",))))


@pytest.mark.parametrize(
    ("title", "more", "status", "reason", "layer"),
    [
        ("Payment firm launches wallet", {}, "qualified", "direct_industry_change", "company_action"),
        ("Payment consolidation", {"is_company": False}, "qualified", "direct_industry_change", "industry_change"),
        ("Regulator fines payment firm", {}, "qualified", "direct_industry_change", "regional_policy"),
        ("Payment firm", {}, "candidate", "no_explicit_change", None),
        ("Opinion: payment consolidation", {}, "candidate", "editorial_title", None),
        ("Weather report", {}, "filtered", "no_target_industry", None),
        ("Regulator reviews platform", {}, "qualified", "policy_without_industry", "regional_policy"),
        ("Market entry of a platform", {"region": "ASIA"}, "qualified", "structural_without_industry", "industry_change"),
        ("Launches something", {"declared": ["retail"], "tier": "L1"}, "qualified", "direct_industry_change", "company_action"),
        ("Launches something", {"declared": ["retail"], "is_company": False, "tier": "L5", "role": "media"}, "filtered", "no_target_industry", None),
        ("Anything", {"kind": "regional_policy"}, "qualified", "policy_without_industry", "regional_policy"),
    ],
)
def test_scope_branches(spark, title, more, status, reason, layer):
    row = (title, "", more.get("declared"), more.get("kind", "other"), more.get("tier"), more.get("role"), more.get("region"), more.get("is_company", True))
    frame = spark.createDataFrame([row], "title string, text string, declared_industries array<string>, event_type string, tier string, role string, region string, is_company boolean")
    got = gates.assess_scope(frame, PRODUCT, SECTORS).first()
    assert (got["scope_status"], got["scope_reason"], got["scope_layer"]) == (status, reason, layer)


@pytest.mark.parametrize(("body", "value"), [("missile app", 0), ("app", 3), ("app mining", 2), ("telecom", 2), ("chip", 1), ("mining", 0), ("", 1)])
def test_relevance(spark, body, value):
    assert one(spark, gates.relevance(F.col("t"), PRODUCT), t=body) == value


def test_scores(spark):
    assert [one(spark, score.amount_score(F.lit(x)), t="") for x in (1000.0, 500.0, 100.0, 20.0, 5.0, 4.9)] == [5, 4, 3, 2, 1, 0]
    top = score.base_score(F.lit(2000.0), F.lit("ma"), F.lit("regional_policy"), F.lit(1), F.lit(True), F.lit(True), F.lit("AFRICA"))
    assert one(spark, top, t="") == 10
    low = score.base_score(F.lit(None).cast("double"), F.lit("other"), F.lit(None).cast("string"), F.lit(0), F.lit(False), F.lit(False), F.lit("EUROPE"))
    assert one(spark, low, t="") == 1
    assert one(spark, score.authority(F.lit(1.0), F.lit("L1")), t="") == 8.0
    assert one(spark, score.authority(F.lit(None).cast("double"), F.lit("L1")), t="") == 33.0
    shut = score.change_score(F.lit(False), F.lit(True), F.lit(True), F.lit("policy"), F.lit(True), F.lit(3))
    assert one(spark, shut["blocked"], t="") == "out_of_target_industry"
    assert one(spark, score.change_score(F.lit(True), F.lit(True), F.lit(True), F.lit("policy"), F.lit(True), F.lit(3))["score"], t="") == 94
    assert [one(spark, score.grade(F.lit(x)), t="") for x in (80, 65, 50, 49)] == list("ABCD")


def test_priority_and_view(spark):
    names = "scope_status string, actionable boolean, event_type string, score int, tier string, is_company boolean, is_google boolean, low_signal boolean, needs_review boolean, attention int, confidence int, relevance int"
    cases = [
        (("filtered", True, "ma", 9, "L1", True, False, False, False, 90, 90, 3), "watch", "filtered", "out_of_scope_industry"),
        (("qualified", False, "funding", 9, "L1", True, False, False, False, 90, 90, 3), "watch", "review", "capital_only_low_actionability"),
        (("qualified", True, "report", 0, "L2", True, False, False, False, 70, 65, 3), "high", "main", "main"),
        (("qualified", True, "report", 0, "L2", True, False, False, False, 40, 45, 3), "watch", "review", "weak_signal"),
        (("qualified", True, "report", 0, "L2", True, False, False, True, 90, 90, 3), "watch", "filtered", "quality_review"),
        (("qualified", True, "other", 4, "L1", True, False, False, False, 0, 0, 3), "mid", "filtered", "other_type"),
        (("qualified", True, "ma", 5, "L1", False, False, False, False, 0, 0, 2), "high", "main", "main"),
        (("qualified", True, "ma", 5, "L2", False, True, False, False, 0, 0, 2), "mid", "review", "google_not_main"),
        (("qualified", True, "ma", 5, "L2", False, True, True, False, 0, 0, 2), "watch", "filtered", "google_not_main"),
        (("qualified", True, "strategy", 1, "L2", False, False, False, False, 0, 0, 2), "watch", "filtered", "weak_signal"),
        (("qualified", True, "strategy", 9, "L2", False, False, False, False, 0, 0, 1), "high", "filtered", "weak_signal"),
    ]
    frame = spark.createDataFrame([c[0] for c in cases], names)
    got = gates.view_gates(frame.withColumn("bd_priority", gates.bd_priority())).collect()
    assert [(r["bd_priority"], r["view_status"], r["drop_reason"]) for r in got] == [c[1:] for c in cases]


def test_leader_clusters_match_the_model(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)]
    rows = []
    for i in range(160):
        day = None if rng.random() < 0.03 and i > 80 else dt.date(2024, 1, 1) + dt.timedelta(days=rng.choice((0, 1, 2, 3, 9, 10, 20)))
        rows.append((i, " ".join(rng.sample(words, 5)), rng.choice((["x"], ["y", "x"], ["z"], None)), rng.choice("ab") if day else "a", day))
    rng.shuffle(rows)
    want = {}
    for kind in "ab":
        mine = sorted((r for r in rows if r[3] == kind), key=lambda r: r[0])
        leaders, facts = [], [({w for w in r[1].split()}, set(r[2] or []), r[4]) for r in mine]
        for i, fact in enumerate(facts):
            leaders.append(next((k for k in range(i) if leaders[k] == k and cluster.same_fact(*fact, *facts[k])), i))
        assert cluster.lead(facts) == leaders
        want |= {r[0]: mine[k][0] for r, k in zip(mine, leaders, strict=True)}
    frame = spark.createDataFrame(rows, "ord long, title string, companies array<string>, event_type string, day date")
    assert {r["ord"]: r["atom"] for r in cluster.evidence_atoms(frame).collect()} == want
    # The same by rounds over the graph of matches.
    assert {r["ord"]: r["atom"] for r in cluster.evidence_atoms(frame, walk_rows=0).collect()} == want


def test_similar_sets_against_all_pairs(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        base = [f"t{rng.randrange(15)}" for _ in range(rng.randrange(7))]
        rows.append((i, sorted(set(base)), dt.date(2024, 1, 1 + rng.randrange(8))))
    frame = spark.createDataFrame(rows, "id long, s array<string>, day date")
    for least in (0.5, 0.72, 1.0):
        got = {(r["a"], r["b"]): r["similarity"] for r in joins.similar_sets(frame, "id", "s", least, "day", 3).collect()}
        heads = {}
        for i, s, d in rows:
            heads.setdefault((tuple(s), d), i)
        found = list(heads.items())
        want = {(min(i, j), max(i, j)) for (s, d), i in found for (t, e), j in found if i != j and s and t and abs((d - e).days) <= 3 and len(set(s) & set(t)) / len(set(s) | set(t)) >= least}
        assert set(got) == want


def test_alias_matches(spark):
    texts = spark.createDataFrame([(1, "The New-York times; ai"), (2, "new x york maize"), (3, None)], "id long, text string")
    aliases = spark.createDataFrame([(10, "new york"), (11, "AI"), (12, ""), (12, "york times ai")], "entity int, alias string")
    for most in (100, 0):
        assert sorted(map(tuple, joins.alias_matches(texts, "id", "text", aliases, most).collect())) == [(1, 10), (1, 11), (1, 12)]


def test_run_alerts(spark):
    rows = [("down", r, 5 if r < 3 else 0, int(r > 5)) for r in range(8)] + [("quiet", r, 9 if r < 3 else 0, 0) for r in range(8)] + [("never", r, 0, 1) for r in range(8)] + [("up", r, 1, 0) for r in range(8)]
    got = windows.run_alerts(spark.createDataFrame(rows, "source string, run int, items int, failed int")).collect()
    assert sorted((r["source"], r["kind"], r["last_alive"]) for r in got) == [("down", "fetch_failure", 2), ("quiet", "supply_drop", 2)]


def test_change_windows(spark):
    end = dt.date(2024, 1, 28)
    rows = []
    for key, counts in {"up": (9, 3, 3, 3), "down": (3, 8, 8, 8), "flat": (4, 3, 3, 3), "fresh": (5, 0, 0, 0)}.items():
        for back, n in enumerate(counts):
            rows += [(key, end - dt.timedelta(days=7 * back + k % 7)) for k in range(n)]
    got = {r["k"]: r for r in windows.change_windows(spark.createDataFrame(rows, "k string, day date"), "k", "day", "2024-01-22", "2024-01-28").collect()}
    assert got["up"]["correction"] == got["down"]["correction"] == 0.75
    assert {k: r["trend"] for k, r in got.items()} == {"up": "rising", "down": "falling", "flat": "steady", "fresh": "rising"}
    alone = windows.change_windows(spark.createDataFrame([r for r in rows if r[1] > end - dt.timedelta(days=7)], "k string, day date"), "k", "day", "2024-01-22", "2024-01-28")
    assert {r["trend"] for r in alone.collect()} == {"new"}


def test_quota_and_first_seen(spark):
    frame = spark.createDataFrame([(i, "r" if i % 2 else "s", i % 3) for i in range(40)], "ord long, region string, score int")
    got = windows.running_quota(frame, "region", [F.col("score").desc(), F.col("ord")], 5, 8, spark.createDataFrame([("r", 3)], "region string, reserved int")).collect()
    assert len(got) == 7 and sum(r["region"] == "r" for r in got) == 2 and all(r["score"] == 2 for r in got)
    assert sorted(r["ord"] for r in windows.first_seen(frame, ["region", "score"], ["ord"]).collect()) == [0, 1, 2, 3, 4, 5]


def test_snapshots_and_candidates(spark):
    schema = "e int, j int, tag string"
    old = spark.createDataFrame([(1, j, "a") for j in range(12)] + [(2, j, "a") for j in range(3)], schema)
    new = spark.createDataFrame([(1, j, "a") for j in range(20, 32)] + [(2, j, "a") for j in range(7)], schema)
    diff = state.snapshot_diff(old, new, ["e", "j", "tag"])
    sizes = spark.createDataFrame([(1, 12, 12), (2, 3, 7), (3, 1, 1)], "e int, previous int, current int")
    assert {r["e"]: (r["added"], r["removed"], r["status"]) for r in state.diff_summary(diff, "e", sizes, "tag").collect()} == {1: (12, 12, "rejected"), 2: (4, 0, "qualified"), 3: (0, 0, "none")}
    seen = spark.createDataFrame([("p", 1, "accumulating", 2), ("p", 2, "qualified", 3), ("p", 3, "rejected", 9), ("q", 1, "rejected", 1), ("q", 2, "accumulating", 1)], "k string, o int, status string, refs int")
    pool = {r["k"]: (r["first_seen"], r["last_seen"], r["refs"], r["status"]) for r in state.merge_candidates(seen, "k", "o").collect()}
    assert pool == {"p": (1, 2, 5, "promoted"), "q": (1, 2, 2, "accumulating")}
    runs = spark.createDataFrame([(i, 0) for i in range(40)], "run int, raw int")
    kept = state.retain_runs(runs, spark.createDataFrame([(39, 7), (40, 8)], "run int, raw int"), "run", "run").collect()
    assert len(kept) == 30 and {r["run"]: r["raw"] for r in kept}[39] == 7


def test_decisions(spark):
    life = [(0, 0, 0, 0, 1, 0, 0), (1, 0, 0, 0, 0, 0, 0), (4, 2, 9, 1, 0, 0, 0), (1, 1, 5, 0, 0, 1, 0)]
    frame = spark.createDataFrame(life, "a long, b long, c long, d long, e long, f long, g long")
    assert [r[0] for r in frame.select(reports.lifecycle(*map(F.col, "abcdefg"))).collect()] == ["failed", "zero-hit", "stable", "partial"]
    acts = [(True, 0, 0, 0, 0, 0), (False, 9, 50, 1, 0, 0), (False, 9, 20, 0, 1, 0), (False, 90, 30, 20, 8, 0), (False, 90, 30, 30, 10, 0), (False, 9, 9, 5, 0, 0), (False, 0, 0, 0, 0, 0), (False, 90, 40, 4, 1, 36), (False, 9, 3, 2, 1, 1)]
    frame = spark.createDataFrame(acts, "a boolean, b int, c int, d int, e int, f int")
    want = ["keep_as_gap_fill", "audit_raw_signal_quality", "instrument_candidate_loss", "promote_weight", "keep_core", "downgrade_or_reclassify", "pause", "audit_conversion_loss", "observe"]
    assert [r[0] for r in frame.select(reports.governance_action(*map(F.col, "abcdef"))).collect()] == want
    points = [(1, "pending"), (2, "pending"), (2, "failed"), (3, "active"), (3, "failed"), (4, "active"), (4, "quiet"), (5, "changed_below_threshold"), (6, "quiet")]
    got = reports.observed_status(spark.createDataFrame(points, "entity int, status string"))
    assert {r["entity"]: r["entity_status"] for r in got.collect()} == {1: "pending", 2: "failed", 3: "partial", 4: "active", 5: "changed", 6: "quiet"}


REPORTS = "ord long, url string, title string, event_types array<string>, company string, companies array<string>, is_company boolean, aliases array<string>, day date"


def _reports(spark, rows):
    """Rows as the walks read them: (title, types, company, day, url) and more."""
    from tidewater.operators.dedupe import prepared

    made = [(i, r.get("url"), r["title"], r.get("types"), r.get("company"), None, r.get("own", False), r.get("aliases"), r.get("day") and dt.date(2024, 1, r["day"])) for i, r in enumerate(rows)]
    found = prepared(spark.createDataFrame(made, REPORTS), [], ["globex", "line"]).orderBy("ord").collect()
    return [{**r.asDict(), "tokens": set(r["tokens"])} for r in found]


SAME = [  # title, title, types, company of both, days, whether they are one event
    ("Acme posts Q1 revenue and profit up sharply on cloud", "Acme posts Q1 revenue and profit down sharply on cloud", ["earnings"], "Acme", (1, 1), False),
    ("Acme Q1 results beat", "Acme Q1 results slump", ["earnings"], "Acme", (1, 1), False),
    ("Acme secures seed round", "Acme bags new backing, valuation rises", ["funding"], "Acme", (1, 2), True),
    ("Acme buys Foo", "Foo purchase by Acme completed", ["ma"], "Acme", (1, 1), True),
    ("Acme wins prize", "Acme raises cash", ["funding"], "Acme", (1, 1), False),
    ("Acme raises cash", "Acme raises cash", ["funding"], "Acme", (1, 9), False),
    ("Acme raises cash", "Money for Acme in series b", ["funding", "earnings"], "Acme", (1, None), True),
    ("Acme opens new store today", "Acme opens new store", ["strategy"], "Acme", (1, 1), True),
    ("Acme opens new store downtown", "Acme hires engineers abroad", ["strategy"], "Acme", (1, 1), False),
    ("Acme raises cash for growth plans", "Acme raises money: investors in Paris join round", ["funding"], None, (1, 1), False),
    ("Acme raises cash for growth plans", "Acme raises cash for growth abroad", ["funding"], None, (1, 1), True),
    ("Funding for Globex Corp grows", "Globex raised again", ["funding"], None, (1, 1), True),
    ("one two three four", "one two three four", None, None, (1, 1), True),
    ("12 34", "12 34", None, None, (1, 1), False),
]


def test_same_event_rules(spark):
    from tidewater.operators.dedupe import same_event

    rows = [{"title": t, "types": types, "company": company, "day": d} for *titles, types, company, days, _ in SAME for t, d in zip(titles, days, strict=True)]
    found = _reports(spark, rows)
    assert [same_event(found[2 * i], found[2 * i + 1]) for i in range(len(SAME))] == [s[-1] for s in SAME]
    assert [same_event(found[2 * i + 1], found[2 * i]) for i in range(len(SAME))] == [s[-1] for s in SAME]
    linked = _reports(spark, [{"title": "a", "url": "u", "day": 1}, {"title": "b", "url": "u", "day": 20}])
    assert same_event(*linked)


def test_report_rules(spark):
    from tidewater.functions import event_rules

    own = {"company": "Foo Bar", "own": True}
    found = _reports(spark, [{"title": "FooBar opens", **own}, {"title": "Quux opens", **own}, {"title": "Quux opens", **own, "aliases": ["quux"]}, {"title": "Quux opens", "company": "Foo Bar"}, {"title": "Foo Bar price target raised", **own}, {"title": "Foo Bar price target raised"}])
    assert [r["alias_missing"] for r in found] == [False, True, False, False, False, False]
    assert [r["low_signal"] for r in found] == [False] * 4 + [True, False]
    assert [r["entity_source"] for r in _reports(spark, [{"title": "x", "company": "Foo Inc"}, {"title": "globex up"}, {"title": "Acme raises cash"}, {"title": "a line of news"}])] == ["company", "alias", "title", "none"]
    frame = spark.createDataFrame([("OpenAI plans", False), ("openai plans", True), ("reopenais", False), ("see x.example", False), (None, None)], "title string, official boolean")
    assert [r[0] for r in frame.select(event_rules.names_excluded(F.col("title"), ["OpenAI"], ["x.example"], F.col("official"))).collect()] == [True, False, False, True, False]
    frame = spark.createDataFrame([("HSBC cuts", None, None, False), ("Kakao and HSBC", None, None, False), ("x", "hsbc", None, False), ("HSBC", None, None, True), (None, None, "HSBC", None)], "t string, c string, p string, own boolean")
    assert [r[0] for r in frame.select(event_rules.bank_report(*map(F.col, ("t", "c", "p", "own")), ["HSBC"], ["Kakao"])).collect()] == [True, False, True, False, True]


def test_daily_and_display_dedupe_match_the_walk(spark):
    from tidewater.operators import dedupe

    rng = random.Random(6)
    words = ["raises", "series", "alpha", "beta", "gamma", "delta", "q1", "profit", "store", "opens", "losses", "zacks", "acme"]
    rows = []
    for i in range(240):
        company = rng.choice([None, "acme", "beta co"])
        rows.append((i, rng.choice([None, f"u{rng.randrange(60)}"]), " ".join(rng.sample(words, rng.randrange(2, 6))), [rng.choice(["funding", "earnings", "strategy", "other"])], company, None, bool(company) and rng.random() < 0.8, None, rng.choice([None, *(dt.date(2024, 1, d) for d in range(1, 6))])))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, REPORTS)
    taken = lambda display: [{**r.asDict(), "tokens": set(r["tokens"])} for r in dedupe.prepared(frame, [], display=display).orderBy("ord").collect()]

    want, plain = {}, taken(False)
    for day in {r["day"] for r in plain}:
        kept, count = [], {}
        for r in (x for x in plain if x["day"] == day):
            twin = next((k["ord"] for k in kept if dedupe.same_event(r, k)), None)
            fate = "alias" if r["alias_missing"] else "low_signal" if r["low_signal"] else "repeat" if twin is not None else "cap" if r["capped"] and count.get(r["capped"], 0) == 3 else "kept"
            want[r["ord"]] = (fate, twin if fate == "repeat" else None)
            if fate == "kept":
                kept.append(r)
                count[r["capped"]] = count.get(r["capped"], 0) + 1
    assert len({f for f, _ in want.values()}) == 5
    assert {r["ord"]: (r["fate"], r["twin"]) for r in dedupe.dedupe_daily(frame, []).collect()} == want

    first, left, want = {}, [], {}
    for r in taken(True):
        if r["key"] in first:
            want[r["ord"]] = ("repeat", first[r["key"]])
        else:
            first[r["key"]] = r["ord"]
            left.append(r)
    want |= {r["ord"]: f for r, f in zip(left, dedupe.walk_display(left), strict=True)}
    assert {r["ord"]: (r["fate"], r["twin"]) for r in dedupe.dedupe_display(frame).collect()} == want


def test_coherent_clusters():
    from tidewater.operators.narrative import pick_coherent

    rows = [{"names": ["a"], "region": "x", "theme": "m"}, {"names": ["a", "b"], "region": "x", "theme": "m"}, {"names": ["c"], "region": "y", "theme": "n"}, {"names": [], "region": "y", "theme": "m"}, {"names": ["d"], "region": "x", "theme": "z"}, {"names": ["e"], "region": "x", "theme": "z"}]
    assert pick_coherent(rows) == [0, 3, 4]
    assert pick_coherent([]) == []


def test_first_kept_row_is_found_as_by_meeting_all():
    """Random rows, put, replaced and dropped: the index names the row that a walk over all kept rows names first."""
    from tidewater.operators import dedupe

    rng = random.Random(4)
    words = ["raises", "seed", "profit", "q1", "store", "opens", "alpha", "beta", "losses", "acquires", "rival", "model"]
    days = [None, *(dt.date(2024, 1, d) for d in range(1, 12))]

    def row():
        kind = rng.choice(["funding", "earnings", "strategy", "other"])
        entity, source = rng.choice([("acme", "company"), ("acme", "title"), ("globex", "alias"), ("", "none")])
        tokens = set(rng.sample(words, rng.randrange(0, 8)))
        return {"url": rng.choice(["", "", "", *(f"u{i}" for i in range(30))]), "type": kind, "entity": entity, "entity_source": source, "tokens": tokens, "anchored": rng.random() < 0.7, "loss": rng.random() < 0.3, "day": rng.choice(days)}

    rows = [row() for _ in range(1500)]
    kept, found = dedupe.Kept(rows[:700]), 0
    for i, r in enumerate(rows):
        want = next((k for k in sorted(kept.rows) if dedupe.same_event(r, kept.rows[k])), None)
        assert kept.first(r) == want
        found += want is not None
        if want is None or i % 3 == 0:
            kept.put(rng.randrange(100_000) if i % 2 else i, r)
        elif i % 7 == 0:
            kept.drop(want)
    assert 300 < found < 1500


def test_a_row_meets_few_of_many_kept_rows(monkeypatch):
    """A day of 6,000 reports of 6,000 companies, of which none repeats another: before, each met all that were kept."""
    from tidewater.operators import dedupe

    rows = [{"ord": i, "url": f"u{i}", "type": "other", "entity": f"firm{i}", "entity_source": "company", "tokens": {f"firm{i}", "opens", "store", f"city{i % 50}"}, "anchored": True, "loss": False, "day": None, "alias_missing": False, "low_signal": False, "capped": ""} for i in range(6000)]
    met, rule = [], dedupe.same_event
    monkeypatch.setattr(dedupe, "same_event", lambda a, b: met.append(1) or rule(a, b))
    assert {f for f, _ in dedupe.walk_day(rows)} == {"kept"}
    assert len(met) < 100 * len(rows)


def test_substrings_are_found_by_one_pattern(spark):
    """All signs are literal; before, each term was a search of its own."""
    terms = ("a.b", "$", "/investor$", "Ab", "(x", "财报", "series ", "q|w")
    texts = ["a.b", "axb", "1$", "/investor", "/investor$s", "cab", "f(x)", "x财报", "series", "series a", "q|w", "q", "", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumns({"one": text.has_substring(F.col("t"), terms), "none": text.has_substring(F.col("t"), ()), "any": text.has_substring(F.col("t"), ("",))})
    assert [(r["one"], r["none"], r["any"]) for r in rows.collect()] == [(any(w.lower() in (t or "") for w in terms), False, True) for t in texts]
    assert rows.select("one")._jdf.queryExecution().optimizedPlan().toString().count("Contains") == 0


def test_first_seen_of_the_rows_that_hold(spark):
    frame = spark.createDataFrame([("a", 1, None), ("a", 3, 2), ("a", 2, 2), ("b", 1, None), (None, 5, 0)], "k string, ord int, rank int")
    found = windows.first_seen(frame, ["k"], ["rank", "ord"], F.col("rank").isNotNull())
    assert sorted(map(tuple, found.collect()), key=str) == [("a", 2, 2), (None, 5, 0)]


@pytest.mark.parametrize(("name", "most"), [("feed_priority_union", 2), ("rolling_7d_clusters", 3), ("weekly_narratives", 2)])
def test_conditions_on_the_contract_do_not_copy_the_match(spark, sf_dir, name, most):
    from tidewater import catalog

    plan = catalog.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") <= most
