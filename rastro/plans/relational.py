"""Queries of projections, filters, joins, set operations, sorts and quotas, one per survey id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rastro.functions import numbers as nu
from rastro.functions import text as tx
from rastro.functions import urls as ur
from rastro.operators import joins, rows
from rastro.operators.joins import small
from rastro.session import read

c = F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
LINE_ORDER = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_orderkey", "l_suppkey"]
LINE_SQL = ", ".join(LINE_ORDER)


def query(sql: str | None) -> Callable:
    """Registers a function of (table reader) under its name, with the SQL it is checked against."""

    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda table: read(spark, sf_dir, table))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# ---- projections and filters ------------------------------------------------------------------------------------


@query("SELECT listing_id, coalesce(nullif(trim(brand), ''), nullif(trim(seller), ''), asin) AS v FROM product_details")
def prj1_first_present(t):
    return t("product_details").select("listing_id", F.coalesce(tx.present(c("brand")), tx.present(c("seller")), c("asin")).alias("v"))


@query("SELECT listing_id, coalesce(nullif(trim(price_eur), ''), nullif(trim(listprice_eur), '')) AS price, coalesce(nullif(trim(bsr), ''), nullif(trim(rank), '')) AS rank FROM product_details")
def prj2_aliases(t):
    table = {"price": ["price_eur", "listprice_eur"], "rank": ["bsr", "rank"]}
    return t("product_details").select("listing_id", *[F.coalesce(*[tx.present(c(a)) for a in names]).alias(out) for out, names in table.items()])


@query("SELECT *, upper(trim(asin)) AS candidate_asin, rank IS NOT NULL AS has_rank FROM (SELECT snapshot_id, asin, rank FROM identity_candidates)")
def prj3_candidate_columns(t):
    return t("identity_candidates").select("snapshot_id", "asin", "rank").withColumns({"candidate_asin": F.upper(F.trim("asin")), "has_rank": c("rank").isNotNull()})


@query("SELECT listing_id AS \"ID\", asin AS \"ASIN\", coalesce(nullif(trim(brand), ''), '-') AS \"Marca\", title AS \"Título\", coalesce(price_eur, '') AS \"Precio\" FROM product_details")
def prj4_export_columns(t):
    return t("product_details").select(c("listing_id").alias("ID"), c("asin").alias("ASIN"), F.coalesce(tx.present(c("brand")), F.lit("-")).alias("Marca"), c("title").alias("Título"), F.coalesce("price_eur", F.lit("")).alias("Precio"))


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net, CASE WHEN l_quantity > 30 THEN 'BULK' ELSE 'UNIT' END AS size_class, year(l_shipdate) AS ship_year FROM lineitem")
def prj5_enrichment(t):
    return t("lineitem").select("l_orderkey", "l_linenumber", F.round(c("l_extendedprice") * (1 - c("l_discount")), 4).alias("net"), F.when(c("l_quantity") > 30, "BULK").otherwise("UNIT").alias("size_class"), F.year("l_shipdate").cast("bigint").alias("ship_year"))


@query("SELECT event_id, coalesce(event_type, 'none') AS snapshot_id, CASE WHEN event_type IN ('purchase', 'signup') THEN 'LINKED' ELSE 'UNLINKED' END AS link_status FROM events")
def prj6_snapshot_status(t):
    return t("events").select("event_id", F.coalesce("event_type", F.lit("none")).alias("snapshot_id"), F.when(c("event_type").isin("purchase", "signup"), "LINKED").otherwise("UNLINKED").alias("link_status"))


@query("SELECT p.listing_id, coalesce(CASE WHEN s.title_es_raw IN ('', '{}', '[]', 'null', 'None') THEN NULL ELSE s.title_es_raw END, p.title) AS shown FROM product_details p LEFT JOIN (SELECT asin, min(title_es_raw) AS title_es_raw FROM saved_cases GROUP BY asin) s ON s.asin = p.asin")
def prj7_display_overlay(t):
    overlay = t("saved_cases").groupBy("asin").agg(F.min("title_es_raw").alias("over"))
    usable = F.when(~c("over").isin("", "{}", "[]", "null", "None"), c("over"))
    return t("product_details").join(overlay, "asin", "left").select("listing_id", F.coalesce(usable, "title").alias("shown"))


@query("SELECT listing_id, field, value FROM (SELECT listing_id, price_eur, rating, reviews, availability FROM product_details) UNPIVOT INCLUDE NULLS (value FOR field IN (price_eur, rating, reviews, availability))")
def prj8_unpivot(t):
    return t("product_details").unpivot("listing_id", ["price_eur", "rating", "reviews", "availability"], "field", "value")


@query("SELECT upper(trim(asin)) AS asin, count(*) AS n, array_to_string(list_sort(list_distinct(list(snapshot_id))), ',') AS snapshots FROM identity_candidates GROUP BY 1")
def prj9_memberships(t):
    return t("identity_candidates").groupBy(F.upper(F.trim("asin")).alias("asin")).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("snapshot_id")), ",").alias("snapshots"))


@query("SELECT listing_id, sha256(asin || '|' || title) AS v FROM product_details")
def prj10_stable_hash(t):
    return t("product_details").drop("captured_at", "ingested_at").select("listing_id", F.sha2(F.concat_ws("|", "asin", "title"), 256).alias("v"))


@query("SELECT count(*) AS n, count(DISTINCT doc_id) AS ids, CAST(sum(CAST('0x' || substr(sha256(coalesce(text, '')), 1, 12) AS BIGINT)) AS VARCHAR) AS dataset FROM documents")
def prj11_dataset_hash(t):
    # The digests of the records are added up, so that the dataset's digest needs no order and no single task.
    part = F.conv(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return t("documents").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc_id").alias("ids"), F.sum(part).cast("string").alias("dataset"))


@query("SELECT snapshot_id, asin FROM identity_candidates WHERE regexp_matches(upper(trim(asin)), '^[A-Z0-9]{10}$')")
def flt1_valid_id(t):
    return t("identity_candidates").filter(F.upper(F.trim("asin")).rlike("^[A-Z0-9]{10}$")).select("snapshot_id", "asin")


@query("SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_quantity BETWEEN CASE l_returnflag WHEN 'A' THEN 10 ELSE 1 END AND CASE l_returnflag WHEN 'A' THEN 20 ELSE 40 END")
def flt2_group_ranges(t):
    spark = t("region").sparkSession
    own = F.broadcast(spark.createDataFrame([("A", 10.0, 20.0)], "l_returnflag string, lo double, hi double"))
    return t("lineitem").join(own, "l_returnflag", "left").filter(c("l_quantity").between(F.coalesce("lo", F.lit(1.0)), F.coalesce("hi", F.lit(40.0)))).select("l_orderkey", "l_linenumber", "l_returnflag")


@query("WITH k AS (SELECT snapshot_id, upper(trim(asin)) AS asin, nullif(href_asin, '') AS product, CASE WHEN card_asin <> '' AND card_asin = href_asin THEN 'CONFIRMED' ELSE 'UNCONFIRMED' END AS state, card_asin <> '' AND href_asin <> '' AND card_asin <> href_asin AS conflict FROM identity_candidates) SELECT snapshot_id, asin FROM k WHERE product IS NOT NULL AND state = 'CONFIRMED' AND NOT conflict")
def flt3_confirmed(t):
    card, href = c("card_asin"), c("href_asin")
    k = t("identity_candidates").select("snapshot_id", F.upper(F.trim("asin")).alias("asin"), href.alias("product_id"), F.when((card != "") & (card == href), "CONFIRMED").otherwise("UNCONFIRMED").alias("identity_status"), F.array_compact(F.array(F.when((card != "") & (href != "") & (card != href), "CARD_LINK"))).alias("conflicts"))
    return rows.confirmed(k).select("snapshot_id", "asin")


@query("WITH k AS (SELECT snapshot_id, asin, raw_href, rank, evidence_source, representation_type, CASE WHEN raw_href IS NULL THEN NULL ELSE '/dp/' || nullif(upper(regexp_extract(raw_href, '/(?:dp|gp/product|gp/aw/d)/([A-Za-z0-9]{10})(?:[/?#]|$)', 1)), '') END AS url FROM identity_candidates) SELECT snapshot_id, CASE WHEN url IS NULL THEN 'excluded' WHEN url = '/dp/' || upper(trim(asin)) AND rank IS NOT NULL AND coalesce(representation_type <> 'SUPPLEMENTAL', true) AND evidence_source IS NOT NULL AND evidence_source <> '' THEN 'qualified' ELSE 'invalid' END AS state, count(*) AS n FROM k GROUP BY 1, 2")
def flt4_qualified(t):
    url = F.concat(F.lit("/dp/"), ur.item_id(c("raw_href")))
    eligible = F.coalesce(c("representation_type") != "SUPPLEMENTAL", F.lit(True))
    state = rows.qualification(url, F.concat(F.lit("/dp/"), F.upper(F.trim("asin"))), c("rank"), eligible, c("evidence_source"))
    return t("identity_candidates").groupBy("snapshot_id", state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT listing_id FROM product_details WHERE coalesce(soldbyamazon <> 'No', true)")
def flt5_not_false(t):
    return t("product_details").filter(F.coalesce(c("soldbyamazon") != "No", F.lit(True))).select("listing_id")


@query("SELECT event_id FROM events WHERE event_type = 'click'")
def flt6_optional_filters(t):
    wanted = {"event_type": "click", "user_id": None}
    df = t("events")
    for name, value in wanted.items():
        df = df if value is None else df.filter(c(name) == value)
    return df.select("event_id")


@query("SELECT listing_id FROM product_details WHERE contains(lower(bsr), 'hogar') AND asin IN (SELECT asin FROM saved_cases)")
def flt7_ids_and_category(t):
    return t("product_details").filter(F.contains(F.lower("bsr"), F.lit("hogar"))).join(t("saved_cases").select("asin"), "asin", "left_semi").select("listing_id")


@query("SELECT listing_id FROM product_details WHERE nullif(trim(title), '') IS NOT NULL AND nullif(trim(price_eur), '') IS NOT NULL AND regexp_matches(asin, '^[A-Z0-9]{10}$')")
def flt8_usable(t):
    return t("product_details").filter(tx.present(c("title")).isNotNull() & tx.present(c("price_eur")).isNotNull() & c("asin").rlike("^[A-Z0-9]{10}$")).select("listing_id")


@query("SELECT placement_id, last_seen_at, CASE WHEN last_error_type IN ('HTTP_403', 'HTTP_429') OR status = 'BLOCKED' THEN 'BLOCKED' WHEN last_error_type IS NOT NULL THEN 'ERROR' WHEN status = 'DONE' THEN 'OK' ELSE 'UNKNOWN' END AS access FROM category_placements")
def flt9_access_state(t):
    blocked = c("last_error_type").isin("HTTP_403", "HTTP_429") | (c("status") == "BLOCKED")
    return t("category_placements").select("placement_id", "last_seen_at", F.when(blocked, "BLOCKED").when(c("last_error_type").isNotNull(), "ERROR").when(c("status") == "DONE", "OK").otherwise("UNKNOWN").alias("access"))


@query("SELECT listing_id FROM product_details WHERE NOT regexp_matches(lower(title), 'oferta|top ventas|envío gratis')")
def flt10_not_advert(t):
    return t("product_details").filter(~F.lower("title").rlike("oferta|top ventas|envío gratis")).select("listing_id")


@query("SELECT placement_id, last_seen_at, CASE WHEN last_error_type IS NULL THEN NULL WHEN regexp_matches(last_error_type, '(?i)timeout|reset|503') THEN 'TRANSIENT' ELSE 'PERMANENT' END AS kind, coalesce(regexp_matches(last_error_type, '(?i)timeout|reset|503'), false) AS retryable FROM category_placements")
def flt11_failures(t):
    again = c("last_error_type").rlike("(?i)timeout|reset|503")
    return t("category_placements").select("placement_id", "last_seen_at", F.when(c("last_error_type").isNotNull(), F.when(again, "TRANSIENT").otherwise("PERMANENT")).alias("kind"), F.coalesce(again, F.lit(False)).alias("retryable"))


@query("SELECT snapshot_id, asin, CASE WHEN list_has_any([asin_source, evidence_source], ['payload']) THEN 'PAYLOAD' WHEN list_has_any([asin_source, evidence_source], ['card']) THEN 'CARD' ELSE 'OTHER' END AS v FROM identity_candidates")
def flt12_cache_class(t):
    both = F.array("asin_source", "evidence_source")
    return t("identity_candidates").select("snapshot_id", "asin", F.when(F.arrays_overlap(both, F.array(F.lit("payload"))), "PAYLOAD").when(F.arrays_overlap(both, F.array(F.lit("card"))), "CARD").otherwise("OTHER").alias("v"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'HOLD' WHEN o_totalprice > 300000 THEN 'REVIEW' WHEN o_orderpriority = '1-URGENT' THEN 'FETCH_NOW' WHEN o_orderstatus = 'O' THEN 'FETCH' ELSE 'KEEP' END AS action FROM orders")
def flt13_ordered_decision(t):
    return t("orders").select("o_orderkey", F.when(c("o_orderstatus") == "P", "HOLD").when(c("o_totalprice") > 300000, "REVIEW").when(c("o_orderpriority") == "1-URGENT", "FETCH_NOW").when(c("o_orderstatus") == "O", "FETCH").otherwise("KEEP").alias("action"))


@query("WITH s AS (SELECT asin, max(captured_at) AS seen, arg_max(field, captured_at) AS field, bool_or(coalesce(title_es_raw, '') <> '') AS titled FROM (SELECT DISTINCT asin, captured_at, min(field) OVER (PARTITION BY asin, captured_at) AS field, title_es_raw FROM saved_cases WHERE asin IS NOT NULL) GROUP BY 1) SELECT DISTINCT p.listing_id, CASE WHEN s.seen IS NULL THEN 'NEW' WHEN NOT s.titled THEN 'UNRELIABLE' WHEN s.field <> 'title_es_raw' AND s.field <> 'specification_es' THEN 'OLD_SCHEMA' WHEN nullif(trim(p.brand), '') IS NULL OR nullif(trim(p.price_eur), '') IS NULL THEN 'MISSING_FIELDS' WHEN epoch(TIMESTAMP '2026-06-01') - epoch(s.seen) > 30 * 86400 THEN 'STALE' ELSE 'FRESH' END AS decision FROM product_details p LEFT JOIN s ON s.asin = p.asin")
def flt14_refresh_decision(t):
    titled = F.bool_or(tx.present(c("title_es_raw")).isNotNull())
    seen = t("saved_cases").filter("asin is not null").groupBy("asin").agg(F.max("captured_at").alias("seen"), titled.alias("titled"), F.min(F.struct((-F.unix_micros(c("captured_at").cast("timestamp"))).alias("o"), "field"))["field"].alias("schema"))
    missing = tx.present(c("brand")).isNull() | tx.present(c("price_eur")).isNull()
    old = F.timestamp_diff("SECOND", c("seen"), F.lit("2026-06-01").cast("timestamp_ntz")) > 30 * 86400
    decision = rows.refresh_decision(c("seen"), ~c("titled"), ~c("schema").isin("title_es_raw", "specification_es"), missing, old)
    return t("product_details").join(seen, "asin", "left").select("listing_id", decision.alias("decision")).distinct()


# ---- joins ------------------------------------------------------------------------------------------------------

_FIRST_CARD = "(SELECT upper(trim(asin)) AS asin, rank, snapshot_id FROM identity_candidates QUALIFY row_number() OVER (PARTITION BY upper(trim(asin)) ORDER BY observed_at, ingested_at, coalesce(rank, -1), page_number, card_index, source_url, coalesce(rank_raw, '')) = 1)"


def _card_order() -> list:
    return [c("observed_at"), c("ingested_at"), F.coalesce("rank", F.lit(-1)), c("page_number"), c("card_index"), c("source_url"), F.coalesce("rank_raw", F.lit(""))]


_FIRST_DETAIL = "(SELECT asin, title, CAST(rank AS VARCHAR) AS drank FROM product_details QUALIFY row_number() OVER (PARTITION BY asin ORDER BY ingested_at, listing_id, title) = 1)"


@query(f"SELECT coalesce(r.asin, d.asin) AS asin, coalesce(CAST(r.rank AS VARCHAR), d.drank) AS rank, r.snapshot_id, d.title FROM {_FIRST_CARD} r FULL JOIN {_FIRST_DETAIL} d ON r.asin = d.asin")
def jn1_merge_rankings_details(t):
    cards = t("identity_candidates").withColumn("asin", F.upper(F.trim("asin")))
    first = cards.withColumn("rank", c("rank").cast("string"))
    merged = joins.merge_first(first, t("product_details").select("asin", "title", "rank", "ingested_at", "listing_id"), "asin", _card_order(), [c("ingested_at"), c("listing_id"), c("title")])
    return merged.select("asin", "rank", "snapshot_id", "title")


@query("SELECT p.listing_id, CASE WHEN s.title IS NOT NULL AND s.title = p.title THEN s.title END AS translated FROM product_details p LEFT JOIN (SELECT asin, min(title) AS title FROM product_details GROUP BY asin) s ON p.asin = s.asin")
def jn2_conditional_overlay(t):
    other = t("product_details").groupBy("asin").agg(F.min("title").alias("other"))
    return t("product_details").join(other, "asin", "left").select("listing_id", F.when(c("other") == c("title"), c("other")).alias("translated"))


@query("SELECT p.p_partkey, l.l_orderkey, o.o_orderstatus FROM part p LEFT JOIN (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY " + ", ".join(f"{x} DESC" for x in LINE_ORDER) + ") = 1) l ON l.l_partkey = p.p_partkey LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey")
def jn3_last_wins_joins(t):
    last = rows.first_by(t("lineitem"), ["l_partkey"], [F.desc(x) for x in LINE_ORDER])
    return t("part").join(last, c("p_partkey") == c("l_partkey"), "left").join(t("orders"), c("l_orderkey") == c("o_orderkey"), "left").select("p_partkey", "l_orderkey", "o_orderstatus")


@query("SELECT c.c_custkey, c.c_nationkey IS NOT DISTINCT FROM s.s_nationkey AS same FROM customer c LEFT JOIN supplier s ON s.s_suppkey = c.c_custkey")
def jn4_null_safe_compare(t):
    return t("customer").join(t("supplier"), c("c_custkey") == c("s_suppkey"), "left").select("c_custkey", c("c_nationkey").eqNullSafe(c("s_nationkey")).alias("same"))


_AT = "(SELECT snapshot_id FROM ranking_snapshots ORDER BY observed_at LIMIT 1 OFFSET {0})"
_LEAST = "(SELECT upper(trim(asin)) AS asin, source_type, min(rank) AS rank FROM (SELECT asin, rank, regexp_extract(source_url, '/bestsellers/([^/?#]+)', 1) AS source_type FROM identity_candidates WHERE rank > 0 AND snapshot_id = " + _AT + ") GROUP BY 1, 2)"


def _snapshot(t, n: int) -> DataFrame:
    chosen = t("ranking_snapshots").orderBy("observed_at").offset(n).limit(1).select("snapshot_id")
    cards = t("identity_candidates").join(F.broadcast(chosen), "snapshot_id", "left_semi")
    return cards.select(F.upper(F.trim("asin")).alias("asin"), F.regexp_extract("source_url", "/bestsellers/([^/?#]+)", 1).alias("source_type"), "rank")


@query(f"SELECT a.asin, a.source_type, a.rank AS rank_before, b.rank AS rank_after, a.rank - b.rank AS delta, CASE WHEN a.rank > b.rank THEN 'UP' WHEN a.rank < b.rank THEN 'DOWN' ELSE 'UNCHANGED' END AS movement FROM {_LEAST.format(0)} a JOIN {_LEAST.format(1)} b USING (asin, source_type)")
def jn5_rank_changes(t):
    from rastro.operators.timeline import rank_changes

    return rank_changes(_snapshot(t, 0), _snapshot(t, 1), ["asin", "source_type"], "rank")


@query("SELECT l.l_orderkey, l.l_linenumber, coalesce(a.s_name, b.s_name) AS s_name FROM lineitem l LEFT JOIN (SELECT s_suppkey AS l_suppkey, s_nationkey AS l_partkey, s_name FROM supplier) a USING (l_suppkey, l_partkey) LEFT JOIN (SELECT s_suppkey AS l_suppkey, s_name FROM supplier QUALIFY count(*) OVER (PARTITION BY s_suppkey) = 1) b USING (l_suppkey)")
def jn6_key_then_part(t):
    facts = t("supplier").select(c("s_suppkey").alias("l_suppkey"), c("s_nationkey").cast("bigint").alias("l_partkey"), "s_name")
    return joins.unique_fallback(t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"), facts, ["l_suppkey", "l_partkey"], "l_suppkey", ["s_name"]).select("l_orderkey", "l_linenumber", "s_name")


@query("SELECT o.o_orderkey, c.c_name, n.n_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey")
def jn7_three_way(t):
    return t("orders").join(t("customer"), c("o_custkey") == c("c_custkey")).join(small(t("nation")), c("n_nationkey") == c("c_nationkey")).select("o_orderkey", "c_name", "n_name")


@query("SELECT a.attr_id, coalesce(e.column_name, n.column_name) AS column_name FROM product_attributes a LEFT JOIN attribute_columns e ON e.label_es = a.label_raw LEFT JOIN (SELECT lower(label_es) AS k, min(column_name) AS column_name FROM attribute_columns GROUP BY 1) n ON n.k = lower(trim(a.label_raw, ' '))")
def jn8_exact_then_normal(t):
    table = t("attribute_columns").select(c("label_es").alias("term"), F.lower("label_es").alias("key"), c("column_name").alias("value"))
    rows_ = t("product_attributes").select("attr_id", "label_raw")
    return joins.exact_then_normal(rows_, table, "label_raw", F.lower(F.trim("label_raw")), "column_name").select("attr_id", "column_name")


@query("SELECT i.snapshot_id, i.source_url, coalesce(nullif(i.card_asin, ''), g.grp) AS grp FROM identity_candidates i LEFT JOIN (SELECT regexp_replace(source_url, '[?#].*$', '') AS page, max(page_number)::VARCHAR AS grp FROM identity_candidates GROUP BY 1) g ON g.page = regexp_replace(i.source_url, '[?#].*$', '')")
def jn9_group_by_url(t):
    page = F.regexp_replace("source_url", r"[?#].*$", "")
    groups = t("identity_candidates").groupBy(page.alias("page")).agg(F.max("page_number").cast("string").alias("g"))
    return t("identity_candidates").join(groups, page == c("page"), "left").select("snapshot_id", "source_url", F.coalesce(F.nullif("card_asin", F.lit("")), "g").alias("grp"))


@query("WITH x AS (SELECT placement_id, max(nullif(parent_placement_id, '')) AS parent, min(category_name) FILTER (WHERE status = 'DONE') AS name FROM category_placements GROUP BY 1), f AS (SELECT parent, min(placement_id) AS member FROM x WHERE name IS NOT NULL AND parent IS NOT NULL GROUP BY 1) SELECT x.placement_id, coalesce(x.name, p.name, m.name) AS evidence, CASE WHEN x.name IS NOT NULL THEN 'OWN' WHEN p.name IS NOT NULL THEN 'PARENT' WHEN m.name IS NOT NULL THEN 'FAMILY' ELSE 'NONE' END AS taken_from FROM x LEFT JOIN x p ON p.placement_id = x.parent LEFT JOIN f ON f.parent = x.parent LEFT JOIN x m ON m.placement_id = f.member")
def jn10_parent_evidence(t):
    own = t("category_placements").groupBy("placement_id").agg(F.max(F.nullif("parent_placement_id", F.lit(""))).alias("parent"), F.min(F.when(c("status") == "DONE", c("category_name"))).alias("evidence"))
    return joins.closest_evidence(own, "placement_id", "parent", "evidence")


@query("SELECT listing_id FROM product_details WHERE asin IN (SELECT asin FROM product_attributes WHERE asin IS NOT NULL)")
def jn11_semi(t):
    return t("product_details").join(t("product_attributes").select("asin"), "asin", "left_semi").select("listing_id")


@query("SELECT listing_id FROM product_details p WHERE NOT EXISTS (SELECT 1 FROM product_attributes a WHERE a.asin = p.asin)")
def jn12_anti(t):
    return t("product_details").join(t("product_attributes").select("asin"), "asin", "left_anti").select("listing_id")


@query("SELECT asin, CASE WHEN n IS NULL THEN 'MISSING' WHEN w IS NULL THEN 'EXTRA' ELSE 'DUPLICATE' END AS state FROM (SELECT asin, 1 AS w FROM product_details GROUP BY asin) a FULL JOIN (SELECT asin, count(*) AS n FROM saved_cases WHERE asin IS NOT NULL GROUP BY asin) b USING (asin) WHERE n IS NULL OR w IS NULL OR n > 1")
def jn13_reconcile(t):
    return joins.reconcile(t("product_details"), t("saved_cases").filter("asin is not null"), "asin")


@query("SELECT r.r_name, k.event_type, coalesce(n, 0) AS n FROM region r CROSS JOIN (SELECT DISTINCT event_type FROM events) k LEFT JOIN (SELECT r.r_name, e.event_type, count(*) AS n FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN nation x ON x.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = x.n_regionkey GROUP BY 1, 2) g ON g.r_name = r.r_name AND g.event_type = k.event_type")
def jn14_coverage_grid(t):
    kinds = t("events").select("event_type").distinct()
    grid = kinds.join(small(t("region").select("r_name")))
    who = t("customer").join(small(t("nation")), c("c_nationkey") == c("n_nationkey")).join(small(t("region")), c("n_regionkey") == c("r_regionkey")).select("c_custkey", "r_name")
    n = t("events").join(who, c("user_id") == c("c_custkey")).groupBy("r_name", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return grid.join(n, ["r_name", "event_type"], "left").fillna(0, ["n"])


@query("SELECT p.event_id, s.event_id AS span_id FROM events p JOIN events s ON p.user_id = s.user_id AND p.event_type = 'purchase' AND s.event_type = 'signup' AND p.ts >= s.ts AND p.ts < s.ts + INTERVAL 72 HOUR")
def jn15_interval(t):
    e = t("events")
    spans = e.filter("event_type = 'signup'").select("user_id", c("event_id").alias("span_id"), c("ts").alias("start"), (c("ts") + F.expr("INTERVAL 72 HOURS")).alias("end"))
    return joins.within(e.filter("event_type = 'purchase'").select("user_id", "event_id", "ts"), spans, "user_id", "ts", "start", "end").select("event_id", "span_id")


@query("SELECT p.event_id, v.ts AS last_ts, v.value AS last_value FROM (SELECT * FROM events WHERE event_type = 'purchase') p LEFT JOIN LATERAL (SELECT ts, value FROM events v WHERE v.user_id = p.user_id AND v.event_type = 'view' AND v.ts <= p.ts ORDER BY ts DESC, event_id DESC LIMIT 1) v ON true")
def jn16_as_of(t):
    e = t("events")
    return joins.as_of(e.filter("event_type = 'purchase'").select("user_id", "event_id", "ts"), e.filter("event_type = 'view'").select("user_id", c("ts").alias("ts_"), "value", c("event_id").alias("tie")).withColumnRenamed("ts_", "at"), "user_id", "ts", "at", ["value"], "tie").select("event_id", c("last_at").alias("last_ts"), "last_value")


@query("SELECT count(*) AS unmatched FROM (SELECT DISTINCT o_orderkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL")
def jn17_key_sets(t):
    a, b = t("orders").select(c("o_orderkey").alias("a")).distinct(), t("lineitem").select(c("l_orderkey").alias("b")).distinct()
    return a.join(b, c("a") == c("b"), "full").filter("a is null or b is null").agg(F.count(F.lit(1)).alias("unmatched"))


@query("SELECT a.o_orderkey AS k, CASE WHEN abs(a.o_totalprice - b.s) > 1 THEN 'PRICE' ELSE 'SAME' END AS v FROM orders a JOIN (SELECT l_orderkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1) b ON a.o_orderkey = b.l_orderkey")
def jn18_recomputed(t):
    again = t("lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("s"))
    return t("orders").join(again, c("o_orderkey") == c("l_orderkey")).select(c("o_orderkey").alias("k"), F.when(F.abs(c("o_totalprice") - c("s")) > 1, "PRICE").otherwise("SAME").alias("v"))


@query("SELECT user_id, event_type, 'left' AS side FROM (SELECT user_id, event_type FROM events WHERE event_id % 2 = 0 EXCEPT ALL SELECT user_id, event_type FROM events WHERE event_id % 2 = 1) UNION ALL SELECT user_id, event_type, 'right' FROM (SELECT user_id, event_type FROM events WHERE event_id % 2 = 1 EXCEPT ALL SELECT user_id, event_type FROM events WHERE event_id % 2 = 0)")
def jn19_bag_difference(t):
    e = t("events")
    return joins.bag_difference(e.filter("event_id % 2 = 0").select("user_id", "event_type"), e.filter("event_id % 2 = 1").select("user_id", "event_type"))


@query("WITH m AS (SELECT c.c_custkey, r.category, r.scope FROM customer c JOIN (SELECT n_nationkey AS key, n_name AS category, 0 AS scope FROM nation WHERE n_nationkey < 10 UNION ALL SELECT n_regionkey, 'REGION_' || n_regionkey, 1 FROM nation) r ON (r.scope = 0 AND r.key = c.c_nationkey) OR (r.scope = 1 AND r.key = c.c_nationkey % 5)), b AS (SELECT c_custkey, min(scope) AS scope FROM m GROUP BY 1) SELECT m.c_custkey, CASE WHEN count(DISTINCT category) = 1 THEN min(category) END AS category, count(DISTINCT category) > 1 AS conflict FROM m JOIN b USING (c_custkey, scope) GROUP BY 1")
def jn20_rule_precedence(t):
    n = t("nation")
    rules = n.filter("n_nationkey < 10").select(c("n_nationkey").alias("key"), c("n_name").alias("category"), F.lit(0).alias("kind")).unionAll(n.select("n_regionkey", F.concat(F.lit("REGION_"), c("n_regionkey").cast("string")), F.lit(1)))
    return joins.best_rule(t("customer").select("c_custkey", "c_nationkey"), rules, [(c("kind") == 0) & (c("key") == c("c_nationkey")), (c("kind") == 1) & (c("key") == c("c_nationkey") % 5)], "c_custkey", "category")


@query("SELECT p.listing_id, s.note, coalesce(s.n, 0) > 1 AS conflict FROM product_details p LEFT JOIN (SELECT asin, CASE WHEN count(DISTINCT specification_es) = 1 THEN min(specification_es) END AS note, count(DISTINCT specification_es) AS n FROM saved_cases GROUP BY 1) s ON s.asin = p.asin")
def jn21_notes(t):
    notes = t("saved_cases").groupBy("asin").agg(F.when(F.countDistinct("specification_es") == 1, F.min("specification_es")).alias("note"), F.countDistinct("specification_es").alias("n"))
    return t("product_details").join(notes, "asin", "left").select("listing_id", "note", (F.coalesce("n", F.lit(0)) > 1).alias("conflict"))


@query("SELECT p.listing_id, coalesce(p.brand, s.s, a.a) AS brand FROM product_details p LEFT JOIN (SELECT asin, min(field) AS s FROM saved_cases GROUP BY 1) s ON s.asin = p.asin LEFT JOIN (SELECT asin, min(section) AS a FROM product_attributes GROUP BY 1) a ON a.asin = p.asin")
def jn22_precedence(t):
    one, two = t("saved_cases").groupBy("asin").agg(F.min("field").alias("brand")), t("product_attributes").groupBy("asin").agg(F.min("section").alias("brand"))
    return joins.fill_from(t("product_details").select("asin", "listing_id", "brand"), [one, two], "asin", ["brand"]).select("listing_id", "brand")


@query("SELECT i.snapshot_id, i.asin, upper(trim(i.asin)) = p.asin AS verified FROM identity_candidates i JOIN (SELECT DISTINCT asin FROM product_details) p ON p.asin = upper(trim(i.asin))")
def jn23_verified(t):
    p = t("product_details").select(c("asin").alias("p")).distinct()
    return t("identity_candidates").join(p, F.upper(F.trim("asin")) == c("p")).select("snapshot_id", "asin", (F.upper(F.trim("asin")) == c("p")).alias("verified"))


@query("SELECT CASE WHEN l.k IS NOT NULL AND o.o_orderstatus = 'F' THEN 'DONE' WHEN o.o_orderstatus = 'P' THEN 'HELD' WHEN l.k IS NOT NULL THEN 'RUNNING' ELSE 'OPEN' END AS state, count(*) AS n FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON l.k = o.o_orderkey GROUP BY 1")
def jn24_outcomes(t):
    lines = t("lineitem").select(c("l_orderkey").alias("k")).distinct()
    state = F.when(c("k").isNotNull() & (c("o_orderstatus") == "F"), "DONE").when(c("o_orderstatus") == "P", "HELD").when(c("k").isNotNull(), "RUNNING").otherwise("OPEN")
    return t("orders").join(lines, c("k") == c("o_orderkey"), "left").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p.asin, coalesce(k.contexts, 0) AS contexts FROM (SELECT DISTINCT asin FROM product_details) p LEFT JOIN (SELECT upper(trim(asin)) AS asin, count(DISTINCT source_url || '|' || coalesce(rank, -1)) AS contexts FROM identity_candidates GROUP BY 1) k USING (asin)")
def jn25_contexts(t):
    k = t("identity_candidates").groupBy(F.upper(F.trim("asin")).alias("asin")).agg(F.countDistinct(F.concat_ws("|", "source_url", F.coalesce("rank", F.lit(-1)).cast("string"))).alias("contexts"))
    return t("product_details").select("asin").distinct().join(k, "asin", "left").fillna(0, ["contexts"])


@query("WITH base AS (SELECT DISTINCT upper(trim(asin)) AS asin, source_url, rank FROM identity_candidates WHERE rank <= 40), extra AS (SELECT DISTINCT upper(trim(asin)) AS asin, source_url, rank FROM identity_candidates WHERE rank BETWEEN 31 AND 50), n AS (SELECT e.*, e.asin IN (SELECT asin FROM base) AS known FROM extra e WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.asin = e.asin AND b.source_url = e.source_url AND b.rank = e.rank)) SELECT asin, count(*) AS contexts, array_to_string(list_sort(list(DISTINCT rank))[1:5], ';') AS first_ranks, any_value(known) AS merged FROM n GROUP BY 1")
def jn26_supplement(t):
    k = t("identity_candidates").select(F.upper(F.trim("asin")).alias("asin"), "source_url", "rank").distinct()
    new = joins.supplement(k.filter("rank <= 40"), k.filter("rank between 31 and 50"), "asin", ["source_url", "rank"])
    nth = F.dense_rank().over(Window.partitionBy("asin").orderBy("rank"))
    return new.withColumn("r", nth).groupBy("asin").agg(F.count(F.lit(1)).alias("contexts"), F.array_join(F.array_sort(F.collect_set(F.when(c("r") <= 5, c("rank")))), ";").alias("first_ranks"), F.first("merged").alias("merged"))


def _snapshot_cells(n: int) -> str:
    return f"(SELECT upper(trim(asin)) AS asin, max(rank_raw) AS rank_raw, max(raw_href) AS raw_href, max(card_asin) AS card_asin, max(evidence_source) AS evidence_source, '{{\"page\":' || max(page_number) || CASE WHEN {n} = 2 THEN ',\"card\":' || max(card_index) ELSE '' END || '}}' AS place FROM identity_candidates WHERE snapshot_id = (SELECT snapshot_id FROM ranking_snapshots ORDER BY observed_at LIMIT 1 OFFSET {n - 1}) GROUP BY 1)"


_CELL_SQL = "SELECT a.asin, '{f}' AS field, CASE WHEN coalesce(a.{f}, '') = '' AND coalesce(b.{f}, '') = '' THEN 'EMPTY_SCHEMA_EXTENSION' WHEN '{f}' = 'place' AND regexp_extract(a.place, '\"page\":([0-9]+)', 1) = regexp_extract(b.place, '\"page\":([0-9]+)', 1) THEN 'METADATA_EXTENSION' WHEN '{f}' = 'raw_href' THEN 'NEW_RAW_REGION' WHEN coalesce(a.{f}, '') = '' THEN 'FIELD_ADDED' ELSE 'FIELD_CHANGED' END AS change FROM {a} a JOIN {b} b USING (asin) WHERE a.{f} IS DISTINCT FROM b.{f}"


@query(" UNION ALL ".join(_CELL_SQL.format(f=f, a=_snapshot_cells(1), b=_snapshot_cells(2)) for f in ("rank_raw", "raw_href", "card_asin", "evidence_source", "place")))
def jn27_field_differences(t):
    names = [r.snapshot_id for r in t("ranking_snapshots").orderBy("observed_at").limit(2).collect()]  # of the fixed list of snapshots

    def cells(n: int) -> DataFrame:
        place = F.struct(F.max("page_number").alias("page"), *([F.max("card_index").alias("card")] if n == 2 else []))
        rows_ = t("identity_candidates").filter(c("snapshot_id") == names[n - 1]).groupBy(F.upper(F.trim("asin")).alias("asin"))
        return rows_.agg(*[F.max(f).alias(f) for f in ("rank_raw", "raw_href", "card_asin", "evidence_source")], F.to_json(place).alias("place"))

    return joins.field_extensions(cells(1), cells(2), "asin", ["rank_raw", "raw_href", "card_asin", "evidence_source", "place"], ["place"], ["raw_href"])


@query("SELECT count(*) AS n, count(*) FILTER (WHERE nullif(trim(p.brand), '') IS NULL AND m.v IS NOT NULL) AS changed FROM product_details p LEFT JOIN (SELECT asin, min(value_raw) AS v FROM product_attributes WHERE lower(label_raw) = 'marca' GROUP BY 1) m ON m.asin = p.asin")
def jn28_fill_missing(t):
    m = t("product_attributes").filter(F.lower("label_raw") == "marca").groupBy("asin").agg(F.min("value_raw").alias("v"))
    return t("product_details").join(m, "asin", "left").agg(F.count(F.lit(1)).alias("n"), F.count_if(tx.present(c("brand")).isNull() & c("v").isNotNull()).alias("changed"))


@query("SELECT page, CASE WHEN n >= 12 THEN 'COMPLETE' WHEN n > 0 THEN 'PARTIAL' END AS state FROM (SELECT regexp_replace(regexp_replace(source_url, '[?#].*$', ''), '/ref=[^/]*$', '') AS page, count(DISTINCT snapshot_id) AS n FROM identity_candidates GROUP BY 1)")
def jn29_source_plan(t):
    page = F.regexp_replace(F.regexp_replace("source_url", r"[?#].*$", ""), r"/ref=[^/]*$", "")
    return t("identity_candidates").groupBy(page.alias("page")).agg(F.countDistinct("snapshot_id").alias("n")).select("page", F.when(c("n") >= 12, "COMPLETE").when(c("n") > 0, "PARTIAL").alias("state"))


@query("SELECT regexp_replace(coalesce(raw_href, ''), '[?].*$', '') AS k, count(*) AS n, min(asin) AS parent FROM identity_candidates GROUP BY 1")
def jn30_rederive(t):
    return t("identity_candidates").groupBy(F.regexp_replace(F.coalesce("raw_href", F.lit("")), r"[?].*$", "").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("asin").alias("parent"))


@query("SELECT p.listing_id, coalesce(s.state, 'PENDING_REVIEW') AS state FROM product_details p LEFT JOIN (SELECT DISTINCT asin, 'REVIEWED' AS state FROM saved_cases WHERE asin IS NOT NULL) s ON s.asin = p.asin")
def jn31_review_state(t):
    s = t("saved_cases").filter("asin is not null").select("asin", F.lit("REVIEWED").alias("state")).distinct()
    return t("product_details").join(s, "asin", "left").select("listing_id", F.coalesce("state", F.lit("PENDING_REVIEW")).alias("state"))


@query("WITH m AS (SELECT a.event_id, b.event_id AS hit, a.user_id % 7 = b.user_id % 7 AS slot, count(*) OVER (PARTITION BY a.event_id) AS n, count(*) FILTER (WHERE a.user_id % 7 = b.user_id % 7) OVER (PARTITION BY a.event_id) AS ns FROM events a JOIN events b ON a.event_type = 'signup' AND b.event_type = 'error' AND a.user_id = b.user_id AND a.ts::DATE = b.ts::DATE) SELECT e.event_id, max(CASE WHEN ns = 1 AND slot THEN hit WHEN ns <> 1 AND n = 1 THEN hit END) AS card FROM (SELECT event_id FROM events WHERE event_type = 'signup') e LEFT JOIN m USING (event_id) GROUP BY 1")
def jn32_card_lookup(t):
    e = t("events").withColumn("day", F.to_date("ts"))
    a, b = e.filter("event_type = 'signup'").select("event_id", "user_id", "day"), e.filter("event_type = 'error'").select("user_id", "day", c("event_id").alias("hit"), (c("user_id") % 7).alias("s"))
    w = Window.partitionBy("event_id")
    m = a.join(b, ["user_id", "day"]).withColumns({"slot": c("user_id") % 7 == c("s"), "n": F.count(F.lit(1)).over(w)}).withColumn("ns", F.count_if("slot").over(w))
    best = m.groupBy("event_id").agg(F.max(F.when((c("ns") == 1) & c("slot"), c("hit")).when((c("ns") != 1) & (c("n") == 1), c("hit"))).alias("card"))
    return a.select("event_id").join(best, "event_id", "left")


# ---- sorts, limits, quotas --------------------------------------------------------------------------------------


@query("SELECT listing_id, asin FROM product_details ORDER BY asin, listing_id")
def so1_sorted(t):
    return t("product_details").select("listing_id", "asin").orderBy("asin", "listing_id")


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'P' THEN 1 ELSE 2 END AS priority FROM orders ORDER BY 2, 1")
def so2_priority(t):
    return t("orders").select("o_orderkey", F.when(c("o_orderstatus") == "O", 0).when(c("o_orderstatus") == "P", 1).otherwise(2).alias("priority")).orderBy("priority", "o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100")
def so3_page(t):
    return rows.page_of(t("orders").select("o_orderkey", "o_totalprice"), [c("o_orderkey")], 100, 50)


@query("SELECT seller, brand, n FROM (SELECT seller, brand, count(*) AS n FROM product_details GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY seller ORDER BY n DESC, coalesce(brand, '')) <= 3")
def so4_top_per_group(t):
    return rows.first_by(t("product_details").groupBy("seller", "brand").agg(F.count(F.lit(1)).alias("n")), ["seller"], [F.desc("n"), F.coalesce("brand", F.lit(""))], 3)


@query(f"SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_partkey) AS parts, greatest(150 - count(*), 0) AS short FROM (SELECT * FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY {LINE_SQL}) = 1) QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY {LINE_SQL}) <= 150) GROUP BY 1, 2")
def so5_unique_quota(t):
    order = [c(x) for x in LINE_ORDER]
    first = rows.first_by(t("lineitem"), ["l_partkey"], order)
    return rows.first_by(first, ["l_returnflag", "l_linestatus"], order, 150).groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("l_partkey").alias("parts"), F.greatest(150 - F.count(F.lit(1)), F.lit(0)).alias("short"))


@query(None)
def so6_greedy_quota(t):
    picked = rows.quota(t("lineitem"), "l_returnflag", "l_partkey", [c(x) for x in LINE_ORDER], "l_suppkey", 40, 0.2)
    return picked.select("l_returnflag", "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT listing_id, CAST((nullif(trim(title), '') IS NOT NULL)::INT + (nullif(trim(brand), '') IS NOT NULL)::INT + (nullif(trim(price_eur), '') IS NOT NULL)::INT + (nullif(trim(rating), '') IS NOT NULL)::INT AS INT) AS quality FROM product_details")
def so7_quality(t):
    return t("product_details").select("listing_id", rows.filled(c("title"), c("brand"), c("price_eur"), c("rating")).alias("quality"))


@query(None)
def so8_allocation(t):
    from rastro.operators.flow import allocate

    options = t("lineitem").select(c("l_suppkey").alias("source"), c("l_partkey").alias("entity"), c("l_returnflag").alias("category"))
    return allocate(options, 15, {"A": 300, "N": 400, "R": 300})


_SO9_SQL = """WITH RECURSIVE s AS (SELECT 's' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS source_id, 'K' || s_nationkey % 3 AS source_type, 'C' || s_nationkey % 2 AS category, CAST(1 + s_suppkey % 5 AS BIGINT) AS pages, CAST(10 + s_suppkey % 7 AS BIGINT) AS cap, CAST(1 + s_suppkey % 3 AS BIGINT) AS cost FROM supplier),
o AS (SELECT *, row_number() OVER (ORDER BY tier, source_id) AS k FROM (SELECT *, CASE WHEN source_type = 'K1' AND category = 'C0' THEN 1 WHEN source_type = 'K1' THEN 2 ELSE 3 END AS tier FROM s)),
w AS (SELECT CAST(0 AS BIGINT) AS k, '' AS source_id, '' AS source_type, 0 AS tier, CAST(0 AS BIGINT) AS cap, CAST(0 AS BIGINT) AS cost, CAST(0 AS BIGINT) AS quantity, CAST(1500 AS BIGINT) AS gap, CAST(90 AS BIGINT) AS pages, CAST(160 AS BIGINT) AS requests, CAST(600 AS BIGINT) AS b0, CAST(500 AS BIGINT) AS b1, CAST(550 AS BIGINT) AS b2
UNION ALL SELECT o.k, o.source_id, o.source_type, o.tier, o.cap, o.cost, q.v, w.gap - q.v, w.pages - CAST(ceil(q.v / o.cap) AS BIGINT), w.requests - CAST(ceil(q.v / o.cap) AS BIGINT) * o.cost, w.b0 - CASE WHEN o.source_type = 'K0' THEN q.v ELSE 0 END, w.b1 - CASE WHEN o.source_type = 'K1' THEN q.v ELSE 0 END, w.b2 - CASE WHEN o.source_type = 'K2' THEN q.v ELSE 0 END
FROM w JOIN o ON o.k = w.k + 1, LATERAL (SELECT least(w.gap, CASE o.source_type WHEN 'K0' THEN w.b0 WHEN 'K1' THEN w.b1 ELSE w.b2 END, least(o.pages, w.pages, w.requests // o.cost) * o.cap) AS v) q)
SELECT source_id, source_type, tier, CAST(ceil(quantity / cap) AS BIGINT) AS page_count, CAST(ceil(quantity / cap) AS BIGINT) * cost AS requests, quantity FROM w WHERE quantity > 0"""


@query(_SO9_SQL)
def so9_shrinking_budgets(t):
    from rastro.operators.flow import tiered_plan

    key, nation = c("s_suppkey"), c("s_nationkey")
    s = t("supplier").select(F.concat(F.lit("s"), F.lpad(key.cast("string"), 9, "0")).alias("source_id"), F.concat(F.lit("K"), (nation % 3).cast("string")).alias("source_type"), F.concat(F.lit("C"), (nation % 2).cast("string")).alias("research_category"),
        (1 + key % 5).cast("bigint").alias("pages"), (10 + key % 7).cast("bigint").alias("page_capacity"), (1 + key % 3).cast("bigint").alias("request_cost"))
    return tiered_plan(s, "K1", "C0", 1500, 90, 160, {"K0": 600, "K1": 500, "K2": 550}, cross=True)


@query("SELECT l_suppkey, array_to_string(list_slice(list_sort(list_distinct(list(l_partkey))), 1, 5), ',') AS sample FROM lineitem GROUP BY 1")
def so10_sample_lists(t):
    few = rows.first_by(t("lineitem").select("l_suppkey", "l_partkey").distinct(), ["l_suppkey"], [c("l_partkey")], 5)
    return few.groupBy("l_suppkey").agg(F.array_join(F.array_sort(F.collect_list("l_partkey")), ",").alias("sample"))


@query("SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY value <= 10, ts, event_id) AS turn, list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS group_rank FROM events")
def so11_interleave(t):
    kinds = F.array(*map(F.lit, ["click", "error", "purchase", "signup", "view"]))
    saved_first = c("value") <= 10  # rows whose page is there already come before the others
    return rows.interleave(t("events"), "event_type", [saved_first, c("ts"), c("event_id")], F.array_position(kinds, c("event_type"))).select("event_id", c("turn").cast("bigint").alias("turn"), c("group_rank").cast("int").alias("group_rank"))


@query("WITH p AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS p, count(*) OVER (PARTITION BY event_type) AS n FROM events), q AS (SELECT event_id, event_type, CASE WHEN p % 2 = 0 THEN p // 2 ELSE ceil(n / 2) + (n - 1 - p) // 2 END AS turn FROM p) SELECT event_id, event_type, CAST(turn AS BIGINT) AS turn FROM q ORDER BY turn, event_type LIMIT 100")
def so12_stratified(t):
    return rows.stratified(t("events").select("event_id", "event_type", "value"), "event_type", [c("value"), c("event_id")], 100).select("event_id", "event_type", "turn")


# ---- set operations ---------------------------------------------------------------------------------------------

_E = "(SELECT DISTINCT user_id FROM events WHERE event_type = '{0}')"


@query(f"SELECT CASE WHEN a.user_id IS NULL THEN 'new' WHEN b.user_id IS NULL THEN 'exited' ELSE 'shared' END AS state, count(*) AS n FROM {_E.format('click')} a FULL JOIN {_E.format('view')} b ON a.user_id = b.user_id GROUP BY 1")
def st1_new_exited_shared(t):
    e = t("events")
    a, b = e.filter("event_type = 'click'").select(c("user_id").alias("a")).distinct(), e.filter("event_type = 'view'").select(c("user_id").alias("b")).distinct()
    return a.join(b, c("a") == c("b"), "full").groupBy(F.when(c("a").isNull(), "new").when(c("b").isNull(), "exited").otherwise("shared").alias("state")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def st2_union_by_name(t):
    return t("customer").select(c("c_custkey").alias("id"), c("c_name").alias("name"), c("c_mktsegment").alias("segment")).unionByName(t("supplier").select(c("s_suppkey").alias("id"), c("s_name").alias("name")), allowMissingColumns=True)


@query("WITH s AS (SELECT DISTINCT user_id, event_type FROM events) SELECT a.event_type AS a, b.event_type AS b, count(*) AS n FROM s a JOIN s b ON a.user_id = b.user_id AND a.event_type < b.event_type GROUP BY 1, 2")
def st3_pairwise_overlaps(t):
    kinds = t("events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("k"))
    a = kinds.select("k", F.explode("k").alias("a"))
    return a.select("a", F.explode(F.filter("k", lambda x: x > c("a"))).alias("b")).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))


@query("WITH s AS (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) SELECT n = 1 AS exclusive, count(*) AS parts FROM s GROUP BY 1")
def st4_exclusive(t):
    return t("lineitem").groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("n")).groupBy((c("n") == 1).alias("exclusive")).agg(F.count(F.lit(1)).alias("parts"))


@query("SELECT count(*) = count(DISTINCT o_orderkey) AS is_unique, count(*) AS n FROM orders")
def st5_uniqueness(t):
    return t("orders").agg((F.count(F.lit(1)) == F.countDistinct("o_orderkey")).alias("is_unique"), F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) = 0 AS equal FROM ((SELECT l_suppkey FROM lineitem EXCEPT ALL SELECT l_suppkey FROM lineitem) UNION ALL (SELECT l_suppkey FROM lineitem EXCEPT ALL SELECT l_suppkey FROM lineitem))")
def st6_bag_equality(t):
    x = t("lineitem").select("l_suppkey")
    return joins.bag_difference(x, x).agg((F.count(F.lit(1)) == 0).alias("equal"))


@query("SELECT context_id, array_to_string(list_filter(b, lambda x, i: list_position(b, x) = i), '|') AS v FROM (SELECT context_id, list_filter(feature_bullets_raw, lambda x: x IS NOT NULL) AS b FROM capacity_context)")
def st7_ordered_distinct(t):
    return t("capacity_context").select("context_id", F.array_join(F.array_distinct("feature_bullets_raw"), "|").alias("v"))


@query("SELECT (SELECT count(*) FROM (SELECT DISTINCT snapshot_id FROM ranking_snapshots EXCEPT SELECT snapshot_id FROM identity_candidates)) AS planned_only, (SELECT count(*) FROM (SELECT DISTINCT snapshot_id FROM identity_candidates EXCEPT SELECT snapshot_id FROM ranking_snapshots)) AS actual_only")
def st8_subset(t):
    a, b = t("ranking_snapshots").select("snapshot_id").distinct(), t("identity_candidates").select("snapshot_id").distinct()
    return a.withColumn("p", F.lit(1)).join(b.withColumn("a", F.lit(1)), "snapshot_id", "full").agg(F.count_if(c("a").isNull()).alias("planned_only"), F.count_if(c("p").isNull()).alias("actual_only"))


@query("SELECT user_id, array_to_string(list_sort(list_filter(['click', 'error', 'purchase', 'signup', 'view'], lambda x: NOT list_contains(k, x))), ',') AS missing FROM (SELECT user_id, list(DISTINCT event_type) AS k FROM events GROUP BY 1)")
def st9_required_missing(t):
    need = F.array(*map(F.lit, ["click", "error", "purchase", "signup", "view"]))
    return t("events").groupBy("user_id").agg(F.array_join(F.array_sort(F.array_except(need, F.collect_set("event_type"))), ",").alias("missing"))


@query("SELECT coalesce(a.n_nationkey, b.k) AS k, a.n_name AS left_name, b.name AS right_name FROM nation a FULL JOIN (SELECT s_suppkey AS k, s_name AS name FROM supplier) b ON a.n_nationkey = b.k WHERE a.n_name IS DISTINCT FROM b.name")
def st10_listing_differences(t):
    a, b = t("nation").select(c("n_nationkey").cast("bigint").alias("k"), c("n_name").alias("left_name")), t("supplier").select(c("s_suppkey").alias("k"), c("s_name").alias("right_name"))
    return a.join(b, "k", "full").filter(~c("left_name").eqNullSafe(c("right_name")))


def queries() -> dict:
    return QUERIES


def oracles() -> dict[str, str]:
    return ORACLES
