import random
from collections import defaultdict

import numpy as np

from rastro.llm.packing import LevelArray, fill_report, pack

KINDS = "container_kind string, capacity_tokens int"


def packed(spark, sizes, kinds=(("k", 100),), **how):
    return pack(spark.createDataFrame(sizes, "doc_id bigint, n_tokens bigint"), spark.createDataFrame(list(kinds), KINDS), **how)


def test_no_text_is_lost_or_split(spark):
    rng = random.Random(1)
    sizes = [(i, rng.choice([0, 5, 33, 50, 99, 100, 101, 250])) for i in range(600)] + [(600, None), (7, 33)]
    rows = packed(spark, sizes, (("k", 100), ("l", 64), ("none", 0), ("null", None)), shard_rows=200).collect()
    assert {r.container_kind for r in rows} == {"k", "l"}
    for kind, capacity in (("k", 100), ("l", 64)):
        mine = [r for r in rows if r.container_kind == kind]
        level, of = defaultdict(int), defaultdict(list)
        for r in mine:
            level[r.container_id] += r.n_tokens
            of[r.doc_id].append(r)
        assert max(level.values()) <= capacity
        for doc, size in sizes:
            parts = [p.n_tokens for p in of[doc]]
            if doc != 7:
                assert sum(parts) == (size or 0) and len(parts) == max(1, -(-(size or 0) // capacity))
        assert sum(r.n_tokens for r in mine) == sum(s or 0 for _, s in sizes)


def test_little_room_is_left(spark):
    rng = random.Random(2)
    sizes = [(i, min(2000, int(rng.lognormvariate(5.2, 0.9)) + 1)) for i in range(4000)]
    report = fill_report(packed(spark, sizes, (("k", 512), ("l", 2048)))).collect()
    assert all(r.filled > 0.97 for r in report)
    assert all(r.containers >= r.least for r in report)


def test_least_squares_choice():
    levels = LevelArray(10)
    first = [levels.place(4), levels.place(4)]
    assert first[0] != first[1] or levels.count[8] == 1
    rng = np.random.default_rng(0)
    again = LevelArray(10)
    for size in rng.integers(1, 11, 500):
        counts = again.count[1:10].copy()
        options = {0: counts.copy()} | {h: counts.copy() for h in range(1, 10 - size + 1) if counts[h - 1]}
        for h, c in options.items():
            if h:
                c[h - 1] -= 1
            if h + size < 10:
                c[h + size - 1] += 1
        best = min((c**2).sum() for c in options.values())
        again.place(int(size))
        assert (again.count[1:10] ** 2).sum() == best


def test_empty(spark):
    assert packed(spark, []).collect() == []
    assert packed(spark, [(1, 5)], ()).collect() == []
    assert [r.container_id for r in packed(spark, [(1, 0)]).collect()] == ["0-0"]


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, 5, 3, "x")], "doc_id bigint, n_tokens bigint, shard int, container_kind string")
    assert [r.n_tokens for r in pack(df, spark.createDataFrame([("k", 10)], KINDS)).collect()] == [5]
