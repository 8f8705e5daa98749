"""Runs registered queries beside their SQL and reports differences: python -m tests.compare DIR [PREFIX ...]."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    return v


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> tuple[str, float]:
    t = time.time()
    df = query(spark, sf_dir)
    rows = df.collect()
    took = time.time() - t
    if sql is None:
        return f"rows only: {len(rows)}", took
    cur = con.execute(sql)
    columns = [x[0] for x in cur.description]
    if sorted(columns) != sorted(df.columns):
        return f"DIFF columns {sorted(df.columns)} {sorted(columns)}", took
    a, b = bag(rows, df.columns), bag(cur.fetchall(), columns)
    if a != b:
        return f"DIFF {sum(a.values())} {sum(b.values())} rows; only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}", took
    return f"ok {len(rows)}", took


def main(sf_dir: str, prefixes: list[str]) -> int:
    import __spark_entry__ as e
    from rastro.session import build_session

    spark = build_session(driver_memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), e.oracle_sql(), 0
    for name, q in e.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        try:
            said, took = compare(spark, con, sf_dir, name, q, sql.get(name))
        except Exception as x:
            said, took = f"DIFF {type(x).__name__}: {str(x)[:600]}", 0
        bad += said.startswith("DIFF")
        print(f"{name:34s} {took:6.1f}s {said}", flush=True)
    print("bad", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
