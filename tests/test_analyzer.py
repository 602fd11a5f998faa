from tidewater.operators import analyzer


def test_recovers_fenced_and_wrapped_json():
    assert analyzer.recovered_json('```json\n[{"url": "a"}]\n```') == [{"url": "a"}]
    assert analyzer.recovered_json('Sure: [{"url": "a"}, 3] done') == [{"url": "a"}]
    assert analyzer.recovered_json('{"url": "b"}') == [{"url": "b"}]
    assert analyzer.recovered_json("no json") == analyzer.recovered_json(None) == analyzer.recovered_json("[broken") == []


def events(spark):
    rows = [(f"u{i}", f"title {i}", "acme" if i % 2 else None, "other" if i % 3 == 0 else "ma", "ASIA") for i in range(20)]
    return spark.createDataFrame(rows, "url string, title string, company string, event_type string, region string")


def test_analysis_fails_open(spark):
    def picky(batch):
        """Fails on batches with u5 unless asked alone, answers in fenced JSON, and invents a url."""
        import json

        if len(batch) > 1 and any(r["url"] == "u5" for r in batch):
            raise RuntimeError("too long")
        if any(r["url"] == "u7" for r in batch):
            return "garbage"
        return "```json\n" + json.dumps([{"url": r["url"], "summary_short": "S " + r["url"], "reason": "", "score": "4"} for r in batch] + [{"url": "made up"}]) + "\n```"

    frame = events(spark).repartition(2)
    answers = analyzer.analyze(frame, picky, size=4)
    urls = {r["url"] for r in answers.collect()}
    assert "made up" not in urls and "u5" in urls and "u7" not in urls
    rows = {r["url"]: r for r in analyzer.enriched(frame, answers).collect()}
    assert len(rows) == 20
    assert rows["u7"]["analysis_source"] == "fallback" and rows["u7"]["summary_short"] == "title 7"
    assert rows["u5"]["analysis_source"] == "model" and rows["u5"]["summary_short"] == "S u5" and rows["u5"]["reason"].startswith("acme: ")


def test_judge_keeps_what_was_not_judged(spark):
    scores = spark.createDataFrame([("u0", 1), ("u3", 5), ("u1", 0)], "url string, score int")
    kept = {r["url"] for r in analyzer.judged(events(spark), scores).collect()}
    assert "u0" not in kept and {"u3", "u1", "u6"} <= kept


def test_upgrade(spark):
    schema = "url string, summary string, note string"
    old = spark.createDataFrame([("a", "old", "n"), ("b", "kept", None), ("c", None, "only")], schema)
    new = spark.createDataFrame([("a", "new", None), ("b", "richer", "x"), ("d", "fresh", None), ("c", "s", None)], schema)
    got = {r["url"]: (r["summary"], r["note"], r["merged"]) for r in analyzer.upgraded(old, new, ["summary", "note"]).collect()}
    assert got == {"a": ("old", "n", 2), "b": ("richer", "x", 2), "d": ("fresh", None, 1), "c": ("s", "only", 2)}
