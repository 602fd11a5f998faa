"""Changes in independent facts against prior windows, by a version that walks the reports."""

import datetime as dt
import random
from collections import Counter

from tidewater.operators.changes import atom_changes
from tidewater.operators.cluster import independence, same_fact

SCHEMA = "ord long, title string, companies array<string>, event_type string, source string, source_family string, topic string, day date, key string"
ORIGIN = dt.date(2024, 1, 1)


def words(title):
    return {w for w in title.lower().split() if len(w) > 1}


def atoms_of(rows):
    """The leader of each report, by (type, companies, tokens, day) in order."""
    found = {}
    for i, r in enumerate(rows):
        facts = lambda x: (words(x[1]), {c.lower() for c in x[2] or []}, x[7])
        found[r[0]] = next((k[0] for k in rows[:i] if found[k[0]] == k[0] and k[3] == r[3] and same_fact(*facts(k), *facts(r))), r[0])
    return found


def promotable(rows, atoms):
    sources, companies = Counter(r[4] for r in rows if r[4]), {c for r in rows for c in r[2] or []}
    days, families, types = {r[7] for r in rows}, {r[5] for r in rows if r[5]}, {r[3] for r in rows}
    topics = {r[6] for r in rows if atoms[r[0]] == r[0] and r[6]}
    if len(set(atoms.values())) < 2:
        return False
    if max(sources.values(), default=0) / len(rows) > 0.75 and len(sources) < 2 and len(companies) < 2 and len(days) < 2:
        return False
    return max(map(len, (companies, families, types, topics, days))) >= 2


def brute(rows, span, priors=3):
    window = lambda r: (r[7] - ORIGIN).days // span
    totals = Counter(map(window, rows))
    groups = {}
    for r in rows:
        if r[8]:
            groups.setdefault((window(r), r[8]), []).append(r)
    counts = {k: len(set(atoms_of(v).values())) for k, v in groups.items()}
    found = {}
    for (w, key), mine in groups.items():
        weeks, n = {r[7].isocalendar()[:2] for r in mine}, counts[w, key]
        if len(weeks) < 2 or n < 3 or not promotable(mine, atoms_of(mine)):
            continue
        before = [(counts.get((v, key), 0), totals[v]) for v in range(w - priors, w) if totals[v]]
        if not before:
            found[w, key] = (n, len(weeks), 0.0, 1.0, "new", 4 * n + 3 * len(weeks) + n)
            continue
        base, mean = sum(c for c, _ in before) / len(before), sum(t for _, t in before) / len(before)
        ratio = totals[w] / mean
        adjusted = n * (min(max(mean / totals[w], 0.75), 1.3) if not 0.8 <= ratio <= 1.25 else 1.0)
        change = "rising" if adjusted >= base + 2 and (adjusted / base if base else 2) >= 1.25 else "falling" if adjusted <= base - 2 and (adjusted / base if base else 0) <= 0.75 else "steady"
        found[w, key] = (n, len(weeks), round(base, 9), round(ratio, 9), change, 4 * n + 3 * len(weeks) + max(round(adjusted - base), 0))
    return found


def got(spark, rows, span):
    found = atom_changes(spark.createDataFrame(rows, SCHEMA), "key", span, str(ORIGIN)).collect()
    return {(r["window"], r["key"]): (r["atoms"], r["weeks"], round(r["baseline"], 9), round(r["coverage_ratio"], 9), r["change"], r["change_score"]) for r in found}


def report(n, day, company="Deep", key="deep", title="deep model released", source="wire", topic="ai"):
    return (n, title, [company], "funding", source, "L2", topic, day, key)


def test_a_company_over_several_weeks_changes_and_over_one_does_not(spark):
    weeks = [report(2 * i + j, dt.date(2024, 1, 3) + dt.timedelta(days=7 * i)) for i in range(3) for j in range(2)]
    assert got(spark, weeks, 31) == {(0, "deep"): (3, 3, 0.0, 1.0, "new", 24)}
    assert got(spark, [report(i, dt.date(2024, 1, 3 + i)) for i in range(3)], 31) == {}
    others = [report(10 + i, dt.date(2024, 1, 3) + dt.timedelta(days=7 * (i // 2)), f"Fin{i}") for i in range(6)]
    assert got(spark, others, 31)[0, "deep"][0] == 6
    assert got(spark, [], 31) == {}
    assert got(spark, [(*weeks[0][:8], None), (*weeks[1][:7], None, "deep")], 31) == {}


def test_copies_do_not_make_a_rise(spark):
    """Many copies of few facts count as the facts, so the window does not rise."""
    steady = [report(100 * w + i, ORIGIN + dt.timedelta(days=28 * w + 6 * i)) for w in range(4) for i in range(4)]
    copies = [report(1000 + i, ORIGIN + dt.timedelta(days=28 * 3 + 6 * (i % 4))) for i in range(40)]
    found = got(spark, steady + copies, 28)
    assert found == brute(sorted(steady + copies), 28)
    assert found[3, "deep"][0] == 4 and found[3, "deep"][4] == "steady"


def test_equals_the_walk(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(14)]
    rows = []
    for i in range(700):
        day = ORIGIN + dt.timedelta(days=int(180 * rng.random() ** 0.7))
        named = rng.choice([[], ["Ab"], ["ab", "Cd"], ["Ef"]])
        rows.append((i, " ".join(rng.sample(vocabulary, 5)), named, rng.choice(["funding", "ma"]), rng.choice(["s1", "s2", "", None]), rng.choice(["L1", "L2", None]), rng.choice(["t", "u", ""]), day, rng.choice(["x", "y", "z", "", None])))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    found = got(spark, shuffled, 28)
    assert found == brute(rows, 28) and {v[4] for v in found.values()} > {"new", "steady"}


def test_independence(spark):
    same = [(i, i, "ma", ["a"], "s", "L1", "t", ORIGIN, "one source, company and day") for i in range(4)]
    spread = [(10 + i, 10 + i, "ma", ["a"], f"s{i}", "L1", "t", ORIGIN, "one of everything else") for i in range(4)]
    days = [(20 + i, 20 + i, "ma", ["a"], "s", "L1", "t", ORIGIN + dt.timedelta(days=i), "two days") for i in range(2)]
    topics = [(30, 30, "ma", [], "s", "L1", "t", ORIGIN, "topics of leaders"), (31, 30, "ma", [], "s", "L1", "u", ORIGIN, "topics of leaders"), (32, 32, "ma", [], "z", "L1", "t", ORIGIN, "topics of leaders")]
    frame = spark.createDataFrame(same + spread + days + topics, "ord long, atom long, event_type string, companies array<string>, source string, source_family string, topic string, day date, key string")
    found = {r["key"]: (r["atoms"], r["topics"], r["promotable"]) for r in independence(frame, ["key"]).collect()}
    assert found == {"one source, company and day": (4, 1, False), "one of everything else": (4, 1, False), "two days": (2, 1, True), "topics of leaders": (2, 1, False)}
