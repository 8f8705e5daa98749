"""Gates: from pages and the observations on them to findings, states and reasons, without gathering a page's rows.

Every condition of a gate is read off aggregates of the observations, joined to one row per page or snapshot, so a page
that holds a tenth of all rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Codes that decide a state, access states that stop a crawl, and states of identity that are conflicts.
RESTRICTED = ["BLOCKED", "CHALLENGE", "CAPTCHA", "ROBOT_CHECK", "ACCESS_DENIED", "RATE_LIMITED", "HTTP_403", "HTTP_429"]
CONFLICTS = ["CONFLICT", "IDENTITY_CONFLICT", "QUARANTINED"]
BLOCKING = ["ACCESS_RESTRICTED", "ACCESS_GATE_NOT_STOPPED"]
FAILING = ["EVIDENCE_CORRUPT", "EVIDENCE_MISSING", "EVIDENCE_METADATA_MISSING", "WRONG_PAGE_TYPE", "PAGE_TYPE_UNKNOWN", "NO_PRODUCT_CONTENT", "LIVE_CAPTURE_PROVENANCE_INVALID"]
ORIGINS = ["LIVE_CAPTURE", "HISTORICAL_REPLAY", "OFFLINE_FIXTURE"]
AUTHORITY = ["ranking_complete", "ranking_slots_complete", "identity_ready", "identity_complete", "access_normal", "no_conflicts", "no_rank_gap", "no_duplicate_rank_slot"]

_PAGE = {
    "source_type": "string", "source_id": "string", "research_category": "string", "rank_semantics": "string", "access_status": "string", "http_status": "int", "origin": "string", "evidence_error": "string",
    "evidence_sha256": "string", "live_error": "boolean", "recognized_page_type": "boolean", "expected_count": "bigint", "count_proven": "boolean", "actual_count": "bigint", "rendered_count": "bigint", "contiguous_ranks": "boolean",
    "expected_rank_start": "bigint", "expected_rank_end": "bigint", "acp_required": "boolean", "acp_complete": "boolean", "acp_pending": "boolean", "category_navigation_valid": "boolean", "browse_node_id": "string",
}
_ROW = {
    "observation_id": "string", "source_type": "string", "source_id": "string", "research_category": "string", "rank_semantics": "string", "slot_position": "bigint", "rank_value": "bigint", "raw_product_url": "string",
    "identity_status": "string", "identity_conflict_reason": "string", "product_id": "string", "asin_from_card": "string", "asin_from_raw_url": "string", "observed_at": "timestamp", "local_date": "date",
}


def _shaped(df: DataFrame, keys: list[str], shape: dict[str, str]) -> DataFrame:
    """``df`` with the columns of ``shape``; those it lacks are null, others are dropped."""
    return df.select(*keys, *[(F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c) for c, kind in shape.items() if c not in keys])


def _stated(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def _row_facts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per page: what its observations tell, as counts."""
    conflict = F.coalesce(F.col("identity_status").isin(CONFLICTS), F.lit(False)) | _stated("identity_conflict_reason")
    confirmed = _stated("product_id") & (F.col("identity_status") == "CONFIRMED") & ~_stated("identity_conflict_reason")
    positive = F.when(F.col("rank_value") > 0, F.col("rank_value"))
    compared = ("source_type", "source_id", "research_category", "rank_semantics")
    limits = [f(c).alias(f"{name}_{c}") for c in compared for f, name in ((F.min, "lo"), (F.max, "hi"))] + [F.count(c).alias(f"n_{c}") for c in compared]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count("slot_position").alias("slots"), F.countDistinct("slot_position").alias("slots_d"), F.count("rank_value").alias("stated_ranks"), F.count(positive).alias("ranks"),
        F.countDistinct(positive).alias("ranks_d"), F.min(positive).alias("rank_lo"), F.max(positive).alias("rank_hi"), F.count_if(~_stated("raw_product_url")).alias("no_link"), F.count_if(conflict).alias("conflicts"),
        F.count_if(conflict & _stated("product_id")).alias("conflict_assigned"), F.count_if(~conflict & _stated("product_id") & ~F.coalesce(confirmed, F.lit(False))).alias("unconfirmed_assigned"),
        F.count_if((F.col("identity_status") == "CONFIRMED") & ~_stated("product_id")).alias("confirmed_without_id"), F.count_if(confirmed).alias("confirmed"), *limits,
    )


def _differs(c: str) -> Column:
    """Whether any observation of the page has another ``c`` than the page; nothing stated differs from anything stated."""
    here = F.col(c)
    some = (F.col(f"lo_{c}") != here) | (F.col(f"hi_{c}") != here) | (here.isNull() & (F.col(f"n_{c}") > 0)) | (here.isNotNull() & (F.col(f"n_{c}") < F.col("n")))
    return (F.col("n") > 0) & F.coalesce(some, F.lit(False))


def page_findings(pages: DataFrame, rows: DataFrame, keys: list[str], semantics: dict[str, str]) -> DataFrame:
    """``keys, code, severity, n``: what is wrong with each page, by its own columns and its observations.

    ``pages`` and ``rows`` hold the columns of the survey's page gate, as far as they are known: a missing column is
    null. ``semantics`` gives what ranks mean for each source type. ``n`` counts the observations concerned (1 for a
    finding of the page itself). A page without observations is judged by its columns; observations without a page count
    for nothing here.
    """
    p = _shaped(pages, keys, _PAGE)
    facts = p.join(_row_facts(_shaped(rows, keys, _ROW), keys), keys, "left").fillna(0)
    kinds = F.create_map(*[F.lit(x) for kv in semantics.items() for x in kv])
    expected_semantics = F.try_element_at(kinds, F.col("source_type"))
    access = F.upper(F.coalesce("access_status", F.lit("UNKNOWN")))
    restricted = access.isin(RESTRICTED) | F.coalesce(F.col("http_status").isin(403, 429), F.lit(False))
    proven, counted = F.coalesce("count_proven", F.lit(False)), F.col("expected_count")
    start, end = F.col("expected_rank_start"), F.col("expected_rank_end")
    ranged = F.coalesce((start > 0) & (start <= end), F.lit(False))
    covered = (F.col("ranks_d") == end - start + 1) & (F.col("rank_lo") == start) & (F.col("rank_hi") == end)
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    page = pages.columns
    one, e, w = F.lit(1), "ERROR", "WARNING"
    rules = [
        (F.col("evidence_error"), e, one, F.col("evidence_error").isNotNull()),
        ("ACCESS_RESTRICTED", e, one, restricted),
        ("ACCESS_STATUS_UNVERIFIED", e, one, ~restricted & ~access.isin("NORMAL", "SUCCESS")),
        ("LIVE_CAPTURE_PROVENANCE_INVALID", e, one, (F.col("origin") == "LIVE_CAPTURE") & yes("live_error")),
        ("WRONG_PAGE_TYPE", e, one, F.col("recognized_page_type") == F.lit(False)),
        ("PAGE_TYPE_UNKNOWN", e, one, F.col("recognized_page_type").isNull()),
        ("UNKNOWN_SOURCE_TYPE", e, one, expected_semantics.isNull()),
        ("RANK_SEMANTICS_MISMATCH", e, one, F.col("rank_semantics").isNotNull() & ~F.col("rank_semantics").eqNullSafe(expected_semantics) | (F.col("n") > 0) & ~F.coalesce((F.col("lo_rank_semantics") == expected_semantics) & (F.col("hi_rank_semantics") == expected_semantics) & (F.col("n_rank_semantics") == F.col("n")), F.col("n_rank_semantics") == 0)),
        ("OBSERVATION_SOURCE_MISMATCH", e, one, _differs("source_type") | _differs("source_id")),
        ("OBSERVATION_CATEGORY_MISMATCH", e, one, _differs("research_category")),
        ("COMPLETENESS_UNVERIFIED", w, one, ~proven),
        ("EXPECTED_COUNT_MISMATCH", e, F.abs(counted - F.col("n")), proven & (F.col("n") != counted)),
        ("NO_PRODUCT_CONTENT", e, one, (F.col("n") == 0) & ~F.coalesce(counted == 0, F.lit(False)) if "expected_count" in page else F.col("n") == 0),
        ("PARSER_COUNT_MISMATCH", e, one, F.col("actual_count") != F.col("n") if "actual_count" in page else F.lit(False)),
        ("PARSER_MISSED_SLOTS", e, F.col("rendered_count") - F.col("n"), (F.col("rendered_count") > F.col("n")) & ~yes("acp_required")),
        ("SLOT_POSITION_MISSING", e, F.col("n") - F.col("slots"), F.col("slots") < F.col("n")),
        ("DUPLICATE_PRODUCT_SLOT", e, one, (F.col("slots") > F.col("slots_d")) | (F.col("n") - F.col("slots") > 1)),
        ("INVALID_VISIBLE_RANK", e, F.col("stated_ranks") - F.col("ranks"), F.col("stated_ranks") > F.col("ranks")),
        ("PRODUCT_LINK_MISSING", e, F.col("no_link"), F.col("no_link") > 0),
        ("IDENTITY_CONFLICT", e, F.col("conflicts"), F.col("conflicts") > 0),
        ("CONFLICT_AUTO_ASSIGNED_PRODUCT", e, F.col("conflict_assigned"), F.col("conflict_assigned") > 0),
        ("UNCONFIRMED_ASSIGNED_PRODUCT", e, F.col("unconfirmed_assigned"), F.col("unconfirmed_assigned") > 0),
        ("CONFIRMED_PRODUCT_ID_MISSING", e, F.col("confirmed_without_id"), F.col("confirmed_without_id") > 0),
        ("DUPLICATE_VISIBLE_RANK", e, F.col("ranks") - F.col("ranks_d"), F.col("ranks") > F.col("ranks_d")),
        ("RANK_COVERAGE_GAP", e, one, yes("contiguous_ranks") & ranged & ~F.coalesce(covered, F.lit(False))),
        ("RANK_COVERAGE_UNVERIFIED", w, one, yes("contiguous_ranks") & ~ranged),
        ("ACP_INCOMPLETE", e, one, yes("acp_required") & (~yes("acp_complete") | yes("acp_pending"))),
        ("CATEGORY_NAVIGATION_MISMATCH", e, one, F.col("category_navigation_valid") == F.lit(False)),
        ("CATEGORY_NAVIGATION_UNVERIFIED", w, one, _stated("browse_node_id") & F.col("category_navigation_valid").isNull()),
    ]
    found = F.array_compact(F.array(*[F.when(when, F.struct((code if isinstance(code, Column) else F.lit(code)).alias("code"), F.lit(severity).alias("severity"), n.cast("bigint").alias("n"))) for code, severity, n, when in rules]))
    return facts.select(*keys, F.inline(found))


def states(entities: DataFrame, findings: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, status, reasons``: BLOCKED, FAILED, PARTIAL (any error), UNVERIFIED (any finding of that kind) or COMPLETE.

    ``reasons`` lists the codes of errors, sorted.
    """
    error = F.col("severity") == "ERROR"
    per = findings.groupBy(*keys).agg(
        F.bool_or(F.col("code").isin(BLOCKING)).alias("_b"), F.bool_or(F.col("code").isin(FAILING)).alias("_f"), F.bool_or(error).alias("_e"), F.bool_or(F.contains("code", F.lit("UNVERIFIED"))).alias("_u"),
        F.array_join(F.array_sort(F.collect_set(F.when(error, F.col("code")))), ";").alias("reasons"),
    )
    status = F.when(F.col("_b"), "BLOCKED").when(F.col("_f"), "FAILED").when(F.col("_e"), "PARTIAL").when(F.col("_u"), "UNVERIFIED").otherwise("COMPLETE")
    return entities.select(*keys).distinct().join(per, keys, "left").select(*keys, status.alias("status"), F.coalesce("reasons", F.lit("")).alias("reasons"))


def snapshot_findings(manifests: DataFrame, pages: DataFrame, rows: DataFrame, page_found: DataFrame, snapshot: str = "snapshot_id", page: str = "page_url") -> DataFrame:
    """``snapshot, code, severity, n`` of whole snapshots: the findings of their pages, and those that show only across pages.

    ``manifests(snapshot, origin, planned_pages, frozen, access_stop_enforced, local_date)``; a missing column is null. Pages
    with one content, or with the same slots in the same order, under different addresses are repeated pagination.
    """
    keys = [snapshot, page]
    m = _shaped(manifests, [snapshot], {"origin": "string", "planned_pages": "bigint", "frozen": "boolean", "access_stop_enforced": "boolean", "local_date": "date"})
    p, r = _shaped(pages, keys, _PAGE), _shaped(rows, keys, _ROW)

    def counted(df: DataFrame, code: str, severity: str = "ERROR") -> DataFrame:
        return df.groupBy(snapshot).agg(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.count(F.lit(1)).alias("n"))

    m_named = m.select(snapshot, F.col("origin").alias("m_origin"), F.col("local_date").alias("m_date"))
    strange = (F.col("origin") != F.col("m_origin")) | ((F.col("m_origin") == "LIVE_CAPTURE") & ~F.coalesce(F.col("origin") == "LIVE_CAPTURE", F.lit(False)))
    day = F.to_date("observed_at")
    bad_time = F.col("observed_at").isNull() | (F.col("local_date") != day) | (F.col("m_date") != day)
    per_page = p.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ids = r.groupBy(snapshot, "observation_id").agg(F.count(F.lit(1)).alias("_n"))
    sign = F.xxhash64("slot_position", "rank_value", "asin_from_card", "asin_from_raw_url", "raw_product_url")
    slots = r.groupBy(*keys).agg(F.sum(sign.cast("decimal(20,0)")).alias("_sum"), F.bit_xor(sign).alias("_xor"), F.count(F.lit(1)).alias("_n"))
    pages_of = p.groupBy(snapshot).agg(F.count(F.lit(1)).alias("_pages"))
    planned = m.join(pages_of, snapshot, "left").fillna(0, ["_pages"])
    blocked = page_found.filter("code = 'ACCESS_RESTRICTED'").select(snapshot).distinct()
    parts = [
        page_found.groupBy(snapshot, "code", "severity").agg(F.sum("n").alias("n")),
        counted(per_page.filter("_n > 1"), "DUPLICATE_PAGE_RECORD"),
        counted(m.filter(~F.coalesce(F.col("origin").isin(ORIGINS), F.lit(False))), "ORIGIN_UNKNOWN"),
        counted(m.filter(F.col("frozen") == F.lit(False)), "SNAPSHOT_NOT_FROZEN"),
        counted(p.join(m_named, snapshot).filter(strange), "PAGE_ORIGIN_MISMATCH"),
        counted(ids.filter(~_stated("observation_id")), "OBSERVATION_ID_MISSING"),
        counted(ids.filter("_n > 1"), "DUPLICATE_OBSERVATION_ID"),
        counted(r.join(per_page.select(*keys), keys, "left_anti"), "OBSERVATION_PAGE_NOT_REGISTERED"),
        counted(r.join(m_named, snapshot).filter(bad_time), "OBSERVATION_TIME_INVALID"),
        counted(p.filter(_stated("evidence_sha256")).groupBy(snapshot, "source_id", "evidence_sha256").agg(F.countDistinct(page).alias("_n")).filter("_n > 1"), "DUPLICATE_PAGINATION_CONTENT"),
        counted(slots.groupBy(snapshot, "_sum", "_xor", F.col("_n")).agg(F.countDistinct(page).alias("_p")).filter("_p > 1"), "DUPLICATE_PAGINATION_SLOTS"),
        counted(planned.filter("planned_pages <> _pages"), "PLANNED_PAGE_COUNT_MISMATCH"),
        counted(planned.filter("_pages = 0"), "NO_PAGES"),
        counted(m.filter((F.col("origin") == "LIVE_CAPTURE") & ~F.coalesce("access_stop_enforced", F.lit(False))).join(blocked, snapshot, "left_semi"), "ACCESS_GATE_NOT_STOPPED"),
    ]
    out = parts[0].select(snapshot, "code", "severity", "n")
    for part in parts[1:]:
        out = out.unionAll(part.select(snapshot, "code", "severity", "n"))
    return out


def authority(facts: DataFrame, key: str) -> DataFrame:
    """``key, authority_status, reasons``: AUTHORITATIVE only if all eight gates (boolean columns) are true; null is not."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(F.col(g), F.lit(False)), F.lit(g)) for g in AUTHORITY]))
    return facts.select(key, F.when(F.size(failed) == 0, "AUTHORITATIVE").otherwise("BLOCKED").alias("authority_status"), F.array_join(failed, ";").alias("reasons"))


def tree_errors(rows: DataFrame) -> DataFrame:
    """``placement_id, error`` of ``rows(placement_id, marketplace, category_id, parent_placement_id, parent_category_id, depth, category_path)``.

    Twelve kinds; ``ROOT_COUNT`` concerns the whole table and has a null id. All but that are read off a row and its
    parent by one join, whatever the depth. A null path is an empty one.
    """
    t = rows.withColumn("category_path", F.coalesce("category_path", F.array().cast("array<string>")))
    n = t.groupBy("placement_id").agg(F.count(F.lit(1)).alias("_n"))
    up = t.dropDuplicates(["placement_id"]).select(F.col("placement_id").alias("_p"), *[F.col(c).alias(f"_{c}") for c in ("marketplace", "category_id", "depth", "category_path")])
    joined = t.join(n, "placement_id").join(up, F.col("parent_placement_id") == F.col("_p"), "left")
    has, found, size = _stated("parent_placement_id"), F.col("_p").isNotNull(), F.size("category_path")
    rules = [
        ("DUPLICATE_PLACEMENT", F.col("_n") > 1),
        ("MALFORMED", ~_stated("category_id") | ~_stated("marketplace")),
        ("DEPTH_PATH_MISMATCH", ~F.col("depth").eqNullSafe(size - 1)),
        ("PATH_END_MISMATCH", ~F.get("category_path", size - 1).eqNullSafe(F.col("category_id"))),
        ("PATH_CYCLE", size > F.size(F.array_distinct("category_path"))),
        ("ROOT_DEPTH", ~has & ~F.col("depth").eqNullSafe(F.lit(0))),
        ("PARENT_MISSING", has & ~found),
        ("OTHER_MARKET", found & ~F.col("marketplace").eqNullSafe(F.col("_marketplace"))),
        ("PARENT_CATEGORY_MISMATCH", found & ~F.col("parent_category_id").eqNullSafe(F.col("_category_id"))),
        ("PATH_NOT_BELOW_PARENT", found & ~F.slice("category_path", F.lit(1), F.greatest(size - 1, F.lit(0))).eqNullSafe(F.col("_category_path"))),
        ("DEPTH_NOT_BELOW_PARENT", found & ~F.col("depth").eqNullSafe(F.col("_depth") + 1)),
    ]
    errors = joined.select("placement_id", F.explode(F.array_compact(F.array(*[F.when(when, F.lit(code)) for code, when in rules]))).alias("error"))
    roots = t.filter(~has).agg(F.countDistinct("placement_id").alias("_r")).filter("_r <> 1")
    return errors.unionAll(roots.select(F.lit(None).cast("string").alias("placement_id"), F.lit("ROOT_COUNT").alias("error")))
