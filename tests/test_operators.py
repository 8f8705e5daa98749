"""Operators without SQL, or whose rules need cases of their own, against brute force."""

import random
from collections import defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rastro.functions import ids
from rastro.functions import numbers as nu
from rastro.functions import text as tx
from rastro.operators import flow, joins, measures, rows, timeline
from rastro.streaming import catalogue


def one(spark, text, make):
    return spark.createDataFrame([(text,)], "c string").select(make(F.col("c")).alias("v")).head().v


@pytest.mark.parametrize(("text", "wanted"), [("12,62", 12.62), ("1.234,56", None), ("€ 9,99", 9.99), ("0", None), ("", None), (None, None), ("9,99 EUR", 9.99), ("x", None)])
def test_price(spark, text, wanted):
    assert one(spark, text, nu.price) == wanted


@pytest.mark.parametrize(("text", "wanted"), [("1.234,56", 1234.56), ("1,234.56", 1234.56), ("3.873", 3873), ("3.87", 3.87), ("1,5", 1.5), ("12,345", 12345), ("n.º 1.2.3", 123), ("", None), (None, None)])
def test_locale_number(spark, text, wanted):
    assert one(spark, text, nu.locale_number) == wanted


@pytest.mark.parametrize(("text", "wanted"), [("1,5 mil+", 1500), ("1.500+", 1500), ("100+", 100), ("100", None), ("2k+", 2000), (None, None)])
def test_monthly_bought(spark, text, wanted):
    assert one(spark, text, nu.monthly_bought) == wanted


def test_uuid5(spark):
    import uuid

    for name in ("https://h/dp/B000000001", "", "ñ"):
        assert one(spark, name, ids.uuid5) == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def test_text_rules(spark):
    assert one(spark, "largo texto corto largo Ver más", tx.expand_collapsed).asDict() == {"text": "largo texto corto", "truncated": False}
    assert one(spark, "abc Ver más", tx.expand_collapsed).asDict() == {"text": "abc", "truncated": True}
    assert one(spark, "abab", tx.halves_once) == "ab"
    assert one(spark, "KX-1234567 y KX-1234567", lambda c: tx.restore_codes(tx.protect_codes(c)["text"], tx.protect_codes(c)["codes"])) == "KX-1234567 y KX-1234567"


def test_greedy_quota(spark):
    rng = random.Random(5)
    data = [(rng.choice("abc"), f"k{rng.randrange(25)}", i, f"s{rng.randrange(4)}") for i in range(90)]
    df = spark.createDataFrame(data, "g string, k string, seq int, s string")
    got = {(r.g, r.k) for r in rows.quota(df, "g", "k", [F.col("seq")], "s", 6, 0.5).collect()}
    best = {}
    for g, k, seq, s in data:
        if (g, k) not in best:
            best[g, k] = (seq, s)
    order = sorted("abc", key=lambda g: (sum(x == g for x, _ in best), g))
    used, wanted = set(), set()
    for g in order:
        taken, per = 0, defaultdict(int)
        for (_, k), (_, s) in sorted(((gk, v) for gk, v in best.items() if gk[0] == g), key=lambda x: x[1]):
            if k not in used and taken < 6 and per[s] < 3:
                taken, per[s] = taken + 1, per[s] + 1
                used.add(k), wanted.add((g, k))
    assert got == wanted


def test_flow(spark):
    assert flow._max_flow({("S", "a"): 3, ("S", "b"): 2, ("a", "b"): 5, ("a", "T"): 2, ("b", "T"): 3}, "S", "T") == 5
    options = spark.createDataFrame([("s1", "e1", "x"), ("s1", "e2", "x"), ("s2", "e2", "y"), ("s1", "e3", "y")], "source string, entity string, category string")
    assert tuple(flow.allocate(options, 2, {"x": 1, "y": 2}).head()) == (3, 0)


def test_running_total(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(200)], "k int, v double")
    total, wanted = 0.0, {}
    for i in range(200):
        total += i % 7
        wanted[i] = total
    assert {r.k: r.t for r in flow.running_total(df, ["k"], "v", "t").collect()} == wanted


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(100)]
    parent = {n: n for e in edges for n in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in measures.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: find(n) for n in parent}


def test_reappearance_needs_a_proven_absence(spark):
    days = [(1, "present"), (2, "absent"), (3, "present"), (4, "unknown"), (5, "present"), (7, "absent"), (9, "present"), (10, "absent"), (11, "present")]
    df = spark.createDataFrame([("p", date(2026, 1, d), s) for d, s in days], "p string, d date, s string")
    assert [r.d.day for r in timeline.reappearances(df, ["p"], "d", "s").orderBy("d").collect()] == [3, 11]


def test_as_of_and_within(spark):
    at = lambda h: datetime(2026, 1, 1, h)
    facts = spark.createDataFrame([("k", at(1), 1, 10), ("k", at(3), 2, 20), ("k", at(3), 3, 30), ("j", at(1), 4, 40)], "k string, t timestamp_ntz, tie int, v int")
    points = spark.createDataFrame([("k", 0, at(0)), ("k", 1, at(1)), ("k", 2, at(5)), ("z", 3, at(5))], "k string, id int, at timestamp_ntz")
    got = {r.id: r.last_v for r in joins.as_of(points, facts, "k", "at", "t", ["v"], "tie").collect()}
    assert got == {0: None, 1: 10, 2: 30, 3: None}
    spans = spark.createDataFrame([("k", at(1), at(5), "s"), ("k", at(5), at(5), "none")], "k string, start timestamp_ntz, end timestamp_ntz, name string")
    assert {(r.id, r.name) for r in joins.within(points, spans, "k", "at", "start", "end", 1).collect()} == {(1, "s")}


def test_duplicate_status(spark):
    rng = random.Random(9)
    data = [(i, f"i{rng.randrange(6)}", f"r{rng.randrange(4)}", rng.random() < 0.7) for i in range(120)]
    seeded, seen, wanted = set(), set(), {}
    for i, item, raw, ok in data:
        wanted[i] = "IDENTITY_UNCONFIRMED" if not ok else "UNIQUE" if item not in seeded else "EXACT_DUPLICATE" if (item, raw) in seen else "NORMALIZED_DUPLICATE"
        seen.add((item, raw))
        if ok:
            seeded.add(item)
    df = spark.createDataFrame([("run", *d) for d in data], "run string, seq int, item string, raw string, ok boolean")
    got = timeline.duplicate_status(df, "run", "item", "raw", [F.col("seq")], F.col("ok"), F.lit(True)).collect()
    assert {r.seq: r.status for r in got} == wanted


def test_claims_and_decisions(spark):
    rng = random.Random(4)
    data = [(f"t{rng.randrange(12)}", i, rng.choice(["reserve", "save", "commit", "hold", "skip", "note"])) for i in range(160)]
    states = defaultdict(lambda: "PENDING")
    for task, _, event in data:
        s = states[task]
        if s in ("COMMITTED", "HELD", "SKIPPED"):
            continue
        states[task] = {("PENDING", "reserve"): "RESERVED", ("RESERVED", "save"): "SAVED", ("SAVED", "commit"): "COMMITTED"}.get((s, event), {"hold": "HELD", "skip": "SKIPPED"}.get(event, s))
    df = spark.createDataFrame(data, "task string, seq int, kind string")
    assert {r.task: r.state for r in catalogue.claim_states(df, "task", "kind", [F.col("seq")]).collect()} == dict(states)

    stacks, log = defaultdict(list), [(f"k{rng.randrange(5)}", i, rng.choice(["same", "different", "undo"])) for i in range(120)]
    for key, _, event in log:
        if event == "undo":
            stacks[key][-1:] = []
        else:
            stacks[key].append(event)
    got = catalogue.standing_decisions(spark.createDataFrame(log, "k string, seq int, e string"), "k", "e", "undo", [F.col("seq")]).collect()
    assert {r.k: r.decision for r in got} == {k: v[-1] for k, v in stacks.items() if v}


def test_count_precedence(spark):
    from rastro.functions import specs as sp

    rows = [
        ("118 ml (Paquete de 1)", "Set de 3", None, None, 12.0, None), ("8 unidades (Paquete de 2)", None, None, None, None, 16), (None, "Pack de 6 vasos", "Set 4", None, None, 6), (None, "vaso", "Set 4 Estándar", None, None, 4),
        (None, "vaso", "grande", "3", None, 3), (None, "1 pieza", None, "1", 5.0, 5), (None, None, None, None, 1.0, None), (None, None, None, None, 2.5, None), ("", "", "", "", None, None),
    ]
    df = spark.createDataFrame(rows, "variant string, title string, size string, sets string, most double, want int")
    got = df.select(sp.resolved_count(F.col("variant"), F.col("title"), F.col("size"), F.col("sets"), F.col("most")).alias("n"), "want").collect()
    assert [r.n for r in got] == [r.want for r in got]
