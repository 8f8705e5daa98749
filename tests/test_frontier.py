from pyspark.sql import functions as F

from rastro.operators.hierarchy import crawl_frontier
from rastro.operators.timeline import latest_widest_pages
from rastro.streaming.catalogue import accepted_batches


def test_crawl_frontier(spark):
    rows = [
        ("a", None, "DONE", None), ("b", "a", "PENDING", None), ("c", "a", "RETRY_WAIT", 5), ("d", "a", "RETRY_WAIT", 6), ("e", "c", "RETRY_WAIT", None), ("f", "a", "BLOCKED", None),
        ("g", "lost", "PENDING", None), ("h", "i", "PENDING", None), ("i", "h", "PENDING", None), ("j", "", "PENDING", None),
    ]
    links = spark.createDataFrame(rows, "placement_id string, parent_placement_id string, status string, next_retry_at int")
    assert {tuple(r) for r in crawl_frontier(links, F.lit(5)).collect()} == {("b", 1), ("c", 1), ("e", 2), ("j", 0)}


def test_accepted_batches(spark):
    rows = [("s", "b1", i, 1) for i in range(4)] * 2 + [("s", "b2", 10 + i, 2) for i in range(7)] + [("s", "b3", 20 + i, 3) for i in range(6)] + [("t", "b1", 1, 9)]
    got = accepted_batches(spark.createDataFrame(rows, "s string, b string, o int, at int"), "b", "o", "s", "at", 10).collect()
    assert {tuple(r) for r in got} == {("s", "b1", 4, 4, True), ("s", "b2", 7, 4, False), ("s", "b3", 6, 10, True), ("t", "b1", 1, 1, True)}


def test_latest_widest_pages(spark):
    rows = [("s", 1, "p", 9), ("s", 2, "p", 1), ("s", 2, "q", 3), ("s", 3, "p", None), ("s", 3, "q", 3), ("s", 3, "r", 3), ("t", 1, "p", None)]
    got = latest_widest_pages(spark.createDataFrame(rows, "s string, at int, page string, n int"), ["s"], [], "at", "page", "n", 2).collect()
    assert {tuple(r) for r in got} == {("s", 3, "r", 3), ("s", 2, "q", 3), ("t", 1, "p", None)}
