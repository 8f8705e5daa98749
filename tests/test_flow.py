import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rastro.operators import flow

KINDS = "source string, entity int, category string"


def whole(options, source_quota, category_quota):
    """The flow of the whole network, entity by entity."""
    arcs = defaultdict(int)
    for s, e, c in options:
        arcs["S", ("s", s)] = source_quota
        arcs[("s", s), ("e", e)] = arcs[("e", e), ("f", e)] = arcs[("f", e), ("c", c)] = 1
    for c, n in category_quota.items():
        arcs[("c", c), "T"] = n
    got = flow._max_flow(arcs, "S", "T")
    return got, sum(category_quota.values()) - got


def some(seed):
    """Few or many sources, some of them hot, few or many categories for an entity, some without a quota, and nulls."""
    r = random.Random(seed)
    sources = [None, *(f"s{i}" for i in range(r.choice([2, 5, 12, 40])))]
    entities, names = r.choice([8, 30, 120]), ["a", "b", "c", "d", None][: r.choice([2, 3, 5])]
    skew = r.choice([0.7, 1, 3])
    options = [(sources[int(len(sources) * r.random() ** skew)], r.choice([None, *range(entities)]), r.choice(names)) for _ in range(entities * r.choice([1, 2, 4]))]
    return options, r.choice([1, 2, 3, 7]), {c: r.choice([0, 1, 4, 9, 20]) for c in ["a", "b", "c", "z"]}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_part_of_the_network_has_the_flow_of_the_whole(spark, seed):
    options, per_source, quotas = some(seed)
    assert tuple(flow.allocate(spark.createDataFrame(options, KINDS), per_source, quotas).head()) == whole(options, per_source, quotas)


def test_a_hot_source_and_entities_that_only_it_has(spark):
    options = [("hot", e, "ab"[e % 2]) for e in range(300)] + [("cold", e, "b") for e in range(290, 300)] + [(f"s{s}", 0, "a") for s in range(50)]
    for per_source, quotas in ((4, {"a": 6, "b": 6}), (12, {"a": 9, "b": 20}), (1, {"a": 5, "b": 5})):
        assert tuple(flow.allocate(spark.createDataFrame(options, KINDS), per_source, quotas).head()) == whole(options, per_source, quotas)


def test_the_network_on_the_driver_does_not_grow_with_the_options(spark, monkeypatch):
    """120,000 entities, no two with the same options."""
    monkeypatch.setattr(flow, "MAX_ARCS", 1_000)
    e = F.col("id")
    options = spark.range(120_000).select(F.explode(F.array(e % 400, 400 + F.floor(e / 400))).alias("source"), e.alias("entity"), F.element_at(F.array(F.lit("x"), F.lit("y")), (e % 2 + 1).cast("int")).alias("category"))
    assert tuple(flow.allocate(options, 3, {"x": 40, "y": 60}).head()) == (100, 0)


def test_nothing_to_allocate(spark):
    empty = spark.createDataFrame([], KINDS)
    assert tuple(flow.allocate(empty, 3, {"a": 2}).head()) == (0, 2)
    one = spark.createDataFrame([("s", 1, "a")], KINDS)
    assert tuple(flow.allocate(one, 0, {"a": 2}).head()) == (0, 2)
    assert tuple(flow.allocate(one, 3, {}).head()) == (0, 0)
