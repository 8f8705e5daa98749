import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rastro.operators.hierarchy import descendants, latest_rows, resolve_hierarchy

SCHEMA = "placement_id string, parent_placement_id string"


def brute(parents):
    out = {}
    for node in parents:
        trail, at = [node], node
        while parents.get(at) and parents[at] in parents:
            at = parents[at]
            if at in trail:
                trail = None
                break
            trail.append(at)
        out[node] = (None, -1, True, None) if trail is None else (trail[-1], len(trail) - 1, False, trail[::-1])
    return out


def run(spark, parents, **how):
    rows = resolve_hierarchy(spark.createDataFrame(list(parents.items()), SCHEMA), **how).collect()
    assert len(rows) == len(parents)
    return {r.node: (r.root, r.depth, r.in_circle, r.path) for r in rows}


SMALL = {"solve_rows": 8, "partition_rows": 10, "hot_children": 4}


@pytest.mark.parametrize("how", [{}, SMALL])
def test_shapes(spark, how):
    rng = random.Random(3)
    tree = {f"t{i}": f"t{rng.randrange(i)}" if i else None for i in range(120)}
    chain = {f"c{i}": f"c{i - 1}" if i else "" for i in range(60)}
    star = {"s": None} | {f"s{i}": "s" for i in range(40)} | {f"s{i}x": f"s{i}" for i in range(40)}
    circle = {f"o{i}": f"o{(i + 1) % 7}" for i in range(7)} | {"below": "o3", "deeper": "below", "self": "self"}
    lost = {"a": "nowhere", "b": "a"}
    parents = tree | chain | star | circle | lost
    assert run(spark, parents, **how) == brute(parents)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(0, 45)), min_size=1, max_size=40))
def test_any_links(spark, links):
    parents = {f"n{i}": None if p is None else f"n{p}" for i, p in enumerate(links)}
    assert run(spark, parents, **SMALL) == brute(parents)


def test_empty_and_extra_columns(spark):
    assert resolve_hierarchy(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([("a", None, 1, "x"), ("b", "a", 2, "y")], SCHEMA + ", w int, path string")
    assert {r.node: r.depth for r in resolve_hierarchy(clash).collect()} == {"a": 0, "b": 1}


def test_latest_rows(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("a", 2, "b"), (None, 9, "z"), ("", 9, "z"), ("b", None, None)], "k string, at int, v string")
    assert {(r.k, r.at, r.v) for r in latest_rows(rows, "k", "at").collect()} == {("a", 2, "y"), ("b", None, None)}


def test_descendants(spark):
    tree = resolve_hierarchy(spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("o", "o")], SCHEMA))
    assert {(r.ancestor, r.node, r.distance) for r in descendants(tree).collect()} == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1)}
