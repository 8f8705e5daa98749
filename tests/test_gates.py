from datetime import datetime

from rastro.operators import gates

KEYS = ["snapshot_id", "page_url"]
MEANING = {"BEST_SELLERS": "LIST_POSITION"}
GOOD = {
    "snapshot_id": "s", "page_url": "u", "source_type": "BEST_SELLERS", "source_id": "src", "rank_semantics": "LIST_POSITION", "access_status": "NORMAL", "origin": "OFFLINE_FIXTURE", "recognized_page_type": True,
    "expected_count": 2, "count_proven": True, "actual_count": 2, "rendered_count": 2, "contiguous_ranks": True, "expected_rank_start": 1, "expected_rank_end": 2, "evidence_sha256": "x",
}
PAGE = "snapshot_id string, page_url string, source_type string, source_id string, rank_semantics string, access_status string, origin string, recognized_page_type boolean, expected_count bigint, count_proven boolean, actual_count bigint, rendered_count bigint, contiguous_ranks boolean, expected_rank_start bigint, expected_rank_end bigint, evidence_sha256 string, acp_required boolean, http_status int"
ROW = "snapshot_id string, page_url string, observation_id string, source_type string, source_id string, rank_semantics string, slot_position bigint, rank_value bigint, raw_product_url string, identity_status string, product_id string, observed_at timestamp"


def row(i, **changed):
    base = {"snapshot_id": "s", "page_url": "u", "observation_id": f"o{i}", "source_type": "BEST_SELLERS", "source_id": "src", "rank_semantics": "LIST_POSITION", "slot_position": i, "rank_value": i, "raw_product_url": f"/dp/{i}", "identity_status": "CONFIRMED", "product_id": f"p{i}", "observed_at": datetime(2026, 1, 1)}
    return {**base, **changed}


def found(spark, page, rows):
    pages, observed = spark.createDataFrame([{**GOOD, **page}], PAGE), spark.createDataFrame(rows, ROW)
    codes = gates.page_findings(pages, observed, KEYS, MEANING)
    state = gates.states(pages, codes, KEYS).first()
    return {r.code for r in codes.collect()}, state.status


def test_page_gate(spark):
    rows = [row(1), row(2)]
    assert found(spark, {}, rows) == (set(), "COMPLETE")
    assert found(spark, {"count_proven": False}, rows) == ({"COMPLETENESS_UNVERIFIED"}, "UNVERIFIED")
    assert found(spark, {"http_status": 403}, rows) == ({"ACCESS_RESTRICTED"}, "BLOCKED")
    assert found(spark, {"access_status": None}, rows) == ({"ACCESS_STATUS_UNVERIFIED"}, "PARTIAL")
    assert found(spark, {"recognized_page_type": False}, rows) == ({"WRONG_PAGE_TYPE"}, "FAILED")
    assert found(spark, {}, []) == ({"EXPECTED_COUNT_MISMATCH", "NO_PRODUCT_CONTENT", "PARSER_COUNT_MISMATCH", "PARSER_MISSED_SLOTS", "RANK_COVERAGE_GAP"}, "FAILED")
    assert found(spark, {"acp_required": True}, rows) == ({"ACP_INCOMPLETE"}, "PARTIAL")
    assert found(spark, {}, [row(1), row(2, slot_position=1, rank_value=1)]) == ({"DUPLICATE_PRODUCT_SLOT", "DUPLICATE_VISIBLE_RANK", "RANK_COVERAGE_GAP"}, "PARTIAL")
    assert found(spark, {}, [row(1), row(2, slot_position=None, rank_value=-1)])[0] == {"SLOT_POSITION_MISSING", "INVALID_VISIBLE_RANK", "RANK_COVERAGE_GAP"}
    assert found(spark, {}, [row(1, raw_product_url=""), row(2, identity_status="CONFLICT")])[0] == {"PRODUCT_LINK_MISSING", "IDENTITY_CONFLICT", "CONFLICT_AUTO_ASSIGNED_PRODUCT"}
    assert found(spark, {}, [row(1, product_id=None), row(2, identity_status=None)])[0] == {"CONFIRMED_PRODUCT_ID_MISSING", "UNCONFIRMED_ASSIGNED_PRODUCT"}
    assert found(spark, {}, [row(1, source_id=None), row(2, rank_semantics="OTHER")])[0] == {"OBSERVATION_SOURCE_MISMATCH", "RANK_SEMANTICS_MISMATCH"}
    assert found(spark, {"source_type": "X"}, rows)[0] == {"UNKNOWN_SOURCE_TYPE", "OBSERVATION_SOURCE_MISMATCH", "RANK_SEMANTICS_MISMATCH"}


def test_snapshot_gate(spark):
    manifest = spark.createDataFrame([("s", "OFFLINE_FIXTURE", 3, False), ("empty", None, 0, True)], "snapshot_id string, origin string, planned_pages int, frozen boolean")
    pages = spark.createDataFrame([GOOD, {**GOOD, "page_url": "v"}, {**GOOD, "page_url": "v", "origin": "LIVE_CAPTURE"}], PAGE)
    rows = spark.createDataFrame([row(1), row(2), row(1, page_url="v"), row(2, page_url="v"), row(3, page_url="w", observation_id=None, observed_at=None)], ROW)
    got = {(r.snapshot_id, r.code): r.n for r in gates.snapshot_findings(manifest, pages, rows, gates.page_findings(pages, rows, KEYS, MEANING)).collect()}
    assert got == {
        ("s", "DUPLICATE_PAGE_RECORD"): 1, ("s", "SNAPSHOT_NOT_FROZEN"): 1, ("s", "PAGE_ORIGIN_MISMATCH"): 1, ("s", "OBSERVATION_ID_MISSING"): 1, ("s", "DUPLICATE_OBSERVATION_ID"): 2, ("s", "OBSERVATION_PAGE_NOT_REGISTERED"): 1,
        ("s", "OBSERVATION_TIME_INVALID"): 1, ("s", "DUPLICATE_PAGINATION_CONTENT"): 1, ("s", "DUPLICATE_PAGINATION_SLOTS"): 1, ("empty", "ORIGIN_UNKNOWN"): 1, ("empty", "NO_PAGES"): 1,
    }


def test_authority(spark):
    df = spark.createDataFrame([("a", *[True] * 8), ("b", True, False, *[True] * 5, None)], "k string, " + ", ".join(f"{g} boolean" for g in gates.AUTHORITY))
    assert {r.k: (r.authority_status, r.reasons) for r in gates.authority(df, "k").collect()} == {"a": ("AUTHORITATIVE", ""), "b": ("BLOCKED", "ranking_slots_complete;no_duplicate_rank_slot")}


def test_tree(spark):
    shape = "placement_id string, marketplace string, category_id string, parent_placement_id string, parent_category_id string, depth int, category_path array<string>"
    good = [("r", "ES", "1", None, None, 0, ["1"]), ("a", "ES", "2", "r", "1", 1, ["1", "2"])]
    errors = lambda rows: {(r.placement_id, r.error) for r in gates.tree_errors(spark.createDataFrame(rows, shape)).collect()}
    assert errors(good) == set()
    assert errors([]) == {(None, "ROOT_COUNT")}
    assert errors([*good, ("q", "ES", "9", "", None, 1, ["9"])]) == {(None, "ROOT_COUNT"), ("q", "DEPTH_PATH_MISMATCH"), ("q", "ROOT_DEPTH")}
    assert errors([*good, ("b", "FR", None, "r", "7", 3, ["5", "5"])]) == {("b", e) for e in ("MALFORMED", "DEPTH_PATH_MISMATCH", "PATH_END_MISMATCH", "PATH_CYCLE", "OTHER_MARKET", "PARENT_CATEGORY_MISMATCH", "PATH_NOT_BELOW_PARENT", "DEPTH_NOT_BELOW_PARENT")}
    assert errors([*good, good[1], ("c", "ES", "4", "gone", None, 0, ["4"])]) == {("a", "DUPLICATE_PLACEMENT"), ("c", "PARENT_MISSING")}


def test_identity_rules(spark):
    from rastro.operators.quality import identity_rules, issues
    from pyspark.sql import functions as F

    rows = [("B0ABCDEFG1", "/dp/B0ABCDEFG1", "b0abcdefg1"), ("short", None, None), ("B0ABCDEFG1", "https://h/gp/product/b0zzzzzzz9?x=1", "B0ZZZZZZZ8"), (None, "/x/B0ABCDEFG1/", ""), (" b0abcdefg1 ", "/no/id", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, asin string, url string, image string")
    got = {(r.i, r.code) for r in issues(df, ["i"], identity_rules(F.col("asin"), F.col("url"), F.col("image"))).collect()}
    assert got == {(1, "ASIN_INVALID"), (1, "LIMITED_IDENTITY_EVIDENCE"), (2, "URL_ASIN_MISMATCH"), (2, "IMAGE_ASIN_MISMATCH"), (3, "ASIN_INVALID"), (4, "LIMITED_IDENTITY_EVIDENCE")}
