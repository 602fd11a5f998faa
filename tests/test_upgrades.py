"""Cross-batch merges as keyed state: batches, restarts and the batch form agree."""

import datetime as dt
import random

from pyspark.sql import Row
from pyspark.sql import functions as F

from tidewater.streaming import upgrades

SCHEMA = (
    "ord long, title string, event_types array<string>, company string, companies array<string>, is_company boolean, aliases array<string>, day date, seen timestamp, "
    + ", ".join(f"{c} string" for c in upgrades.SHOWN if c != "title")
)


def made(spark, rows):
    """rows: (ord, title, type, company, day, seen day, more texts)."""
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    full = [(o, t, [k], c, None, False, None, d and dt.date(2024, 1, d), start + dt.timedelta(days=s), *(more.get(x) for x in upgrades.SHOWN if x != "title")) for o, t, k, c, d, s, more in rows]
    return spark.createDataFrame(full, SCHEMA)


def streamed(spark, tmp_path, batches, **options):
    """Each batch is a run of its own, so every one restarts from the checkpoint."""
    source, out = str(tmp_path / "source"), str(tmp_path / "out")
    for rows in batches:
        upgrades.reports(made(spark, rows)).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        upgrades.run_merge(spark, stream, out, str(tmp_path / "checkpoint"), **options)
    return upgrades.newest(spark, out)


def plain(df):
    return sorted((r["reach"], r["ord"], *(r[c] for c in upgrades.SHOWN), r["day"], r["richness"], tuple(r["merged"]), r["reports"], r["upgrades"]) for r in df.collect())


def test_a_richer_report_replaces_a_stored_one_days_later(spark, tmp_path):
    first = [(1, "Acme raises cash", "funding", "Acme", 1, 0, {"url": "a", "reason": "why"}), (2, "Globex opens shop", "strategy", "Globex", 1, 0, {"url": "g"})]
    poorer = [(3, "Acme raised", "funding", "Acme", 2, 1, {"url": "b"})]
    richer = [(4, "Acme secures seed funding from several investors", "funding", "Acme", 3, 2, {"url": "c", "overview": "x" * 100})]
    rows = {r["ord"]: r for r in streamed(spark, tmp_path, [first, poorer, richer]).collect()}
    assert set(rows) == {1, 2}
    acme = rows[1]
    assert (acme["title"], acme["url"], acme["reason"], acme["merged"]) == ("Acme secures seed funding from several investors", "c", "why", ["c"])
    assert (acme["day"], acme["reports"], acme["upgrades"]) == (dt.date(2024, 1, 1), 3, 1)
    assert rows[2]["reports"] == 1


def test_batches_with_restarts_equal_the_batch_form(spark, tmp_path):
    rng = random.Random(8)
    words = ["raises", "seed", "profit", "q1", "store", "opens", "alpha", "beta", "losses", "acquires"]
    rows = []
    for i in range(160):
        more = {"url": rng.choice(["", "u1", "u2", f"v{i}"]), "overview": "o" * rng.randrange(0, 90), "reason": rng.choice(["", "r"])}
        rows.append((i, "Acme " + " ".join(rng.sample(words, rng.randrange(2, 6))), rng.choice(["funding", "earnings", "strategy", "other"]), rng.choice(["Acme", "Globex", None]), rng.choice([None, *range(1, 9)]), i // 16, more))
    cuts = [0, 30, 31, 90, 160]
    batches = [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    found = plain(streamed(spark, tmp_path, batches, keep_days=60))
    assert found == plain(upgrades.merged_batch(upgrades.reports(made(spark, rows))))
    assert sum(r[-2] for r in found) == 160 and any(r[-1] > 1 for r in found) and len(found) < 120


def test_reports_that_were_not_seen_for_long_are_forgotten(spark, tmp_path):
    one = lambda o, seen: (o, "Acme raises cash", "funding", "Acme", None, seen, {"url": f"u{o}"})
    other = lambda o, seen: (o, "Globex raises cash", "funding", "Globex", None, seen, {"url": f"u{o}"})
    rows = streamed(spark, tmp_path, [[one(1, 0)], [other(2, 5)], [one(3, 6)], [other(4, 30)], [other(5, 31)], [one(6, 32)]], keep_days=7)
    assert {r["ord"]: r["reports"] for r in rows.collect() if "acme" in r["reach"]} == {1: 2, 6: 1}


def test_state_of_no_rows(spark, tmp_path):
    assert upgrades.merged_batch(upgrades.reports(made(spark, [])).filter(F.lit(True))).count() == 0


def test_every_headline_is_counted_once(spark, sf_dir):
    from tidewater.plans.streaming import stream_upgrades

    got = stream_upgrades(spark, sf_dir).agg(F.sum("reports"), F.count("*"), F.countDistinct("ord")).first()
    assert got[0] == spark.read.parquet(f"{sf_dir}/orders.parquet").count() and got[1] == got[2] < got[0]


def test_a_reach_is_read_and_written_once_and_has_one_timer():
    """Before, each of the 2,000 stored reports had a timer of its own that read all of them, and a write of its own."""
    calls, held = {"put": 0, "timer": []}, []

    class State:
        def get(self):
            return iter(list(held))

        def put(self, rows):
            calls["put"] += 1
            held[:] = rows

        def clear(self):
            held.clear()

    class Handle:
        def getListState(self, *_):  # noqa: N802
            return State()

        def registerTimer(self, at):  # noqa: N802
            calls["timer"].append(at)

    class Times:
        def getCurrentWatermarkInMs(self):  # noqa: N802
            return 1_000 * day + 7 * day

    day, start = 86_400_000, dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    row = {**dict.fromkeys(upgrades.SHOWN, ""), "reach": "other|acme", "type": "other", "entity": "acme", "entity_source": "company", "anchored": True, "loss": False, "richness": 1}
    rows = [Row(**row, ord=i, tokens=[f"t{i}", f"u{i}"], day=(start + dt.timedelta(i)).date(), seen=start + dt.timedelta(i)) for i in range(2000)]
    work = upgrades.Upgrades(7 * day)
    work.init(Handle())
    assert len(list(work.handleInputRows(("other|acme",), iter(rows), Times()))) == 2000
    assert (calls["put"], calls["timer"]) == (1, [7 * day])
    list(work.handleExpiredTimer(("other|acme",), Times(), None))
    assert (calls["put"], calls["timer"][1:]) == (2, [1_001 * day + 7 * day]) and len(held) == 999
