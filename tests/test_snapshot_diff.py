from datetime import datetime

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from rastro.operators import snapshot_diff
from rastro.operators.snapshot_diff import Bitmap, advance_snapshot, empty_state, snapshot_changes

CARDS = "snapshot_id string, asin string, rank int, rank_raw string, source_url string, ingested_at timestamp_ntz"
SNAPS = "snapshot_id string, observed_at timestamp_ntz"
T = datetime(2026, 1, 1)


def snaps(spark, *ids):
    return spark.createDataFrame([(s, T.replace(day=1 + i)) for i, s in enumerate(ids)], SNAPS)


def changes(spark, rows, *ids):
    found = snapshot_changes(spark.createDataFrame(rows, CARDS), snaps(spark, *ids)).collect()
    return {(r.snapshot_id, r.page_url, r.asin, r.change) for r in found}, len(found)


def test_rules(spark):
    late = T.replace(hour=5)
    rows = [
        ("s1", " a1 ", 1, None, "https://h/x/ref=q?pg=2", T), ("s1", "A2", 2, None, "https://h/x/", T), ("s1", "A3", None, "Nº 1.234", "https://h/x", T), ("s1", "A4", None, None, "https://h/x#l", T),
        ("s2", "A1", 1, "#9", "https://h/x", T), ("s2", "A3", 1234, None, "https://h/x", T), ("s2", "A4", 7, None, "https://h/x", T), ("s2", "A5", 5, None, "https://h/x", T),
        ("s2", "A5", 6, None, "https://h/x", late), ("s2", "A5", 6, None, "https://h/x", late),
        ("s3", "A5", 6, None, "https://h/x", T),
        ("s9", "A1", 1, None, "https://h/x", T), (None, "A1", 1, None, "https://h/x", T), ("s1", None, 1, None, "https://h/x", T), ("s1", "", 1, None, "https://h/x", T), ("s1", "A1", 1, None, None, T),
    ]
    found, n = changes(spark, rows, "s1", "s2", "s3", "s4")
    assert n == len(found)
    assert found == {
        ("s2", "https://h/x", "A2", "removed"), ("s2", "https://h/x", "A4", "changed"), ("s2", "https://h/x", "A5", "added"),
        ("s3", "https://h/x", "A1", "removed"), ("s3", "https://h/x", "A3", "removed"), ("s3", "https://h/x", "A4", "removed"), ("s4", "https://h/x", "A5", "removed"),
    }


def test_empty(spark):
    assert changes(spark, [], "s1", "s2") == (set(), 0)
    assert changes(spark, [("s1", "A", 1, None, "u", T)]) == (set(), 0)


def test_extra_columns(spark):
    rows = spark.createDataFrame([("s1", "A", 1, None, "u", T, 3, "p"), ("s2", "A", 2, None, "u", T, 4, "q")], CARDS + ", at int, packed string")
    assert [r.change for r in snapshot_changes(rows, snaps(spark, "s1", "s2")).collect()] == ["changed"]


def test_containers_split_between_keys(spark, monkeypatch):
    rows = [("s1" if i % 3 else "s2", f"A{i // 2}", i % 5, None, f"u{i % 4}", T) for i in range(400)]
    whole = changes(spark, rows, "s1", "s2")
    import pyarrow as pa

    monkeypatch.setattr(snapshot_diff, "CONTAINER", 7)
    table = pa.table({"page_url": [f"u{i // 40}" for i in range(200)], "asin": [f"A{i // 2:03}" for i in range(200)], "at": pa.array([i % 2 for i in range(200)], pa.int32()), "value": pa.array(range(200), pa.int64())})
    out = list(snapshot_diff._stream(iter(table.to_batches(3)), ["s1", "s2"]))
    assert sum(b.num_rows for b in out) == 100
    assert whole[1] == len(whole[0])


@given(st.sets(st.integers(0, 9999)), st.sets(st.integers(0, 9999)), st.booleans())
def test_bitmaps(a, b, dense):
    extra = set(range(5000)) if dense else set()
    x, y = a | extra, b
    p, q = (Bitmap(np.array(sorted(s), np.int64), 10_000) for s in (x, y))
    assert set(p.and_not(q).tolist()) == x - y
    assert set(q.and_not(p).tolist()) == y - x
    assert set(p.both(q).tolist()) == x & y


def test_ranks_of_any_size(spark):
    raw = ["#8.589.934.599", "#7", "#9.223.372.036.854.775.807", None]
    rows = [(f"s{i + 1}", "A", None, r, "u", T) for i, r in enumerate(raw)] + [(f"s{i + 1}", "B", (-1, None, 0, -1)[i], None, "u", T) for i in range(4)]
    found, _ = changes(spark, rows, "s1", "s2", "s3", "s4")
    assert found == {(f"s{i}", "u", a, "changed") for i in (2, 3, 4) for a in "AB"}


def test_stored_ordinals(spark, tmp_path):
    """Deliveries taken one by one give the changes of all at once, and no key ever changes its ordinal."""
    import random

    rng = random.Random(4)
    rows = [(f"s{i}", f"A{rng.randrange(60)}", rng.choice([None, *range(4)]), None, f"u{rng.randrange(5)}", T.replace(second=rng.randrange(50))) for i in range(1, 5) for _ in range(120)]
    cards = spark.createDataFrame(rows, CARDS)
    whole, _ = changes(spark, rows, "s1", "s2", "s3", "s4", "s5")
    state, seen, got = empty_state(spark), {}, set()
    for i in range(1, 6):
        found, state = advance_snapshot(state, cards.filter(f"snapshot_id = 's{i}'"))
        got |= {(f"s{i}", r.page_url, r.asin, r.change) for r in found.collect()}
        state.write.parquet(f"{tmp_path}/{i}")
        state = spark.read.parquet(f"{tmp_path}/{i}")
        now = {(r.page_url, r.asin): r.ordinal for r in state.collect()}
        assert now.items() >= seen.items() and sorted(now.values()) == list(range(len(now)))
        seen = now
    assert {g for g in got if g[0] != "s1"} == whole and {g[3] for g in got if g[0] == "s1"} == {"added"}
