from datetime import datetime

from rastro.plans import relational


def test_grid_has_every_event_type(spark, tmp_path):
    made = {
        "events": ([(i, datetime(2024, 1, 1), 1, f"kind {i}" if i else None, 1.0, None) for i in range(1200)], "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
        "customer": ([(1, 1)], "c_custkey bigint, c_nationkey int"),
        "nation": ([(1, "n", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(1, "r"), (2, "s")], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r.r_name, r.event_type): r.n for r in relational.QUERIES["jn14_coverage_grid"](spark, str(tmp_path)).collect()}
    assert got == {(r, f"kind {i}" if i else None): int(r == "r" and i > 0) for r in "rs" for i in range(1200)}
