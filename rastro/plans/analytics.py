"""Queries of aggregations and window functions, one per survey id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rastro.functions import text as tx
from rastro.operators import measures as ms
from rastro.operators import rows
from rastro.operators import timeline as tl
from rastro.plans.scalars import madrid_sql
from rastro.session import read

c = F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
ORDER = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_orderkey", "l_suppkey"]
ORDER_SQL = ", ".join(ORDER)
KINDS = ["click", "error", "purchase", "signup", "view"]
CARD = "(SELECT snapshot_id, upper(trim(asin)) AS asin, rank, rank_raw, page_number, card_index, source_url, raw_href, card_asin, evidence_source, observed_at, ingested_at, regexp_replace(regexp_replace(regexp_replace(trim(source_url), '[?#].*$', ''), '/ref=[^/]*', '', 'g'), '/+$', '') AS page FROM identity_candidates)"


def query(sql: str | None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda table: read(spark, sf_dir, table))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def cards(t) -> DataFrame:
    from rastro.operators.snapshot_diff import clean_page_url

    return t("identity_candidates").withColumns({"asin": F.upper(F.trim("asin")), "page": clean_page_url(c("source_url"))})


n_rows = lambda: F.count(F.lit(1))

# ---- aggregations -----------------------------------------------------------------------------------------------


@query("SELECT coalesce(l.k, g.event_type) AS event_type, coalesce(n, 0) AS n, coalesce(v, 0) AS n_valid, coalesce(i, 0) AS n_items, coalesce(v, 0) - coalesce(i, 0) AS duplicates, coalesce(n, 0) - coalesce(v, 0) AS invalid FROM (SELECT unnest(['click', 'refund', 'view']) AS k) l FULL JOIN (SELECT coalesce(event_type, 'UNMAPPED') AS event_type, count(*) AS n, count(*) FILTER (WHERE value > 5) AS v, count(DISTINCT CASE WHEN value > 5 THEN user_id END) AS i FROM events GROUP BY 1) g ON g.event_type = l.k")
def ag1_group_statistics(t):
    labels = t("events").sparkSession.createDataFrame([("click",), ("refund",), ("view",)], "event_type string")
    return ms.group_statistics(t("events"), labels, "event_type", "user_id", c("value") > 5)


@query("SELECT count(*) AS n, count(value) AS n_value, count(DISTINCT user_id) AS n_users, count(value) - count(DISTINCT user_id) AS repeats FROM events")
def ag2_counts(t):
    return t("events").agg(n_rows().alias("n"), F.count("value").alias("n_value"), F.countDistinct("user_id").alias("n_users"), (F.count("value") - F.countDistinct("user_id")).alias("repeats"))


@query("SELECT l_partkey, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags FROM lineitem GROUP BY 1")
def ag3_memberships(t):
    return t("lineitem").groupBy("l_partkey").agg(F.array_join(F.array_sort(F.collect_set("l_returnflag")), ",").alias("flags"))


@query("SELECT count(*) FILTER (WHERE n > 1) AS reused, count(*) AS n FROM (SELECT l_partkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)")
def ag4_reuse(t):
    return t("lineitem").groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("s")).agg(F.count_if(c("s") > 1).alias("reused"), n_rows().alias("n"))


@query(f"SELECT asin, page, min(rank) AS rank FROM {CARD} WHERE rank > 0 GROUP BY 1, 2")
def ag5_least_rank(t):
    return cards(t).filter("rank > 0").groupBy("asin", "page").agg(F.min("rank").alias("rank"))


@query("SELECT user_id, arg_max(event_id, ts) AS event_id, max(ts) AS ts FROM (SELECT user_id, ts, max(event_id) AS event_id FROM events GROUP BY 1, 2) GROUP BY 1")
def ag6_latest_record(t):
    best = t("events").groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("b"))
    return best.select("user_id", "b.event_id", "b.ts")


@query(f"SELECT asin, min(observed_at) AS first_seen, max(observed_at) AS last_seen, count(*) AS n FROM {CARD} GROUP BY 1")
def ag7_seen(t):
    return cards(t).groupBy("asin").agg(F.min("observed_at").alias("first_seen"), F.max("observed_at").alias("last_seen"), n_rows().alias("n"))


@query(" UNION ALL ".join(f"SELECT asin, '{f}' AS field, count(DISTINCT {f}) AS n_values, array_to_string(list_sort(list(DISTINCT {f}))[1:3], ';') AS evidence FROM {CARD} GROUP BY 1 HAVING count(DISTINCT {f}) > 1" for f in ("card_asin", "evidence_source", "raw_href")))
def ag8_value_conflicts(t):
    return ms.value_conflicts(cards(t), "asin", ["card_asin", "evidence_source", "raw_href"])


@query("WITH e AS (SELECT user_id % 700 AS item, ts, event_id, CASE WHEN value > 10 THEN value END AS rating, CASE WHEN event_id % 100 > 30 THEN event_id % 100 END AS reviews FROM events), r AS (SELECT item, max(ts) AS ts FROM e WHERE rating IS NOT NULL GROUP BY 1), v AS (SELECT item, arg_max(reviews, (ts, event_id)) AS reviews FROM e WHERE reviews IS NOT NULL GROUP BY 1) SELECT k.item, CASE WHEN count(DISTINCT e.rating) = 1 THEN min(e.rating) END AS rating, min(e.event_id) AS evidence, any_value(v.reviews) AS reviews, CASE WHEN count(DISTINCT e.rating) = 1 THEN 'RATING' WHEN count(e.rating) > 0 THEN 'TIE' WHEN any_value(v.reviews) IS NOT NULL THEN 'REVIEWS' ELSE 'NONE' END AS basis FROM (SELECT DISTINCT item FROM e) k LEFT JOIN r USING (item) LEFT JOIN e ON e.item = k.item AND e.ts = r.ts AND e.rating IS NOT NULL LEFT JOIN v ON v.item = k.item GROUP BY 1")
def ag9_latest_valid(t):
    e = t("events").select((c("user_id") % 700).alias("item"), "ts", "event_id", F.when(c("value") > 10, c("value")).alias("rating"), F.when(c("event_id") % 100 > 30, c("event_id") % 100).alias("reviews"))
    return ms.latest_rating(e, "item", "ts", "event_id", "rating", "reviews")


@query("WITH s AS (SELECT DISTINCT event_type, user_id FROM events), k AS (SELECT user_id, count(*) AS n FROM s GROUP BY 1) SELECT event_type, count(*) AS items, count(*) FILTER (WHERE n > 1) AS shared, count(*) FILTER (WHERE n = 1) AS only_here, count(*) / (SELECT count(*) FROM k) AS coverage FROM s JOIN k USING (user_id) GROUP BY 1")
def ag10_contribution(t):
    return ms.contribution(t("events"), "event_type", "user_id")


_VALID = "regexp_matches(coalesce(asin, ''), '^[A-Z0-9]{10}$') AND rank > 0"


@query(f"WITH k AS (SELECT page, raw_href, CASE WHEN {_VALID} THEN asin END AS item, regexp_extract(page, '/gp/[^/]+/([^/]+)', 1) AS grp FROM {CARD}), g AS (SELECT page, count(*) AS n, count(DISTINCT raw_href) AS raw_urls, count(item) AS valid, count(DISTINCT item) AS items, count(DISTINCT CASE WHEN item IS NOT NULL THEN grp END) AS groups FROM k GROUP BY GROUPING SETS ((page), ())) SELECT page, n, raw_urls, valid, items, groups, CASE WHEN page IS NULL THEN CAST((SELECT sum(items) FROM g WHERE page IS NOT NULL) AS BIGINT) END AS sum_of_sources, greatest(5000 - items, 0) AS shortfall FROM g")
def ag11_accounting(t):
    k = cards(t).filter("page is not null").withColumn("grp", F.regexp_extract("page", "/gp/[^/]+/([^/]+)", 1))
    valid = F.coalesce(c("asin"), F.lit("")).rlike("^[A-Z0-9]{10}$") & (c("rank") > 0)
    return ms.accounting(k, "page", "raw_href", "asin", "grp", valid, 5000)


@query("SELECT seller, field, CASE WHEN nullif(trim(value), '') IS NULL THEN 'MISSING' ELSE 'PRESENT' END AS status, count(*) AS n FROM (SELECT seller, field, value FROM (SELECT seller, brand, price_eur, rating FROM product_details) UNPIVOT INCLUDE NULLS (value FOR field IN (brand, price_eur, rating))) GROUP BY 1, 2, 3")
def ag12_field_status(t):
    long = t("product_details").unpivot("seller", ["brand", "price_eur", "rating"], "field", "value")
    return long.groupBy("seller", "field", F.when(tx.present(c("value")).isNull(), "MISSING").otherwise("PRESENT").alias("status")).agg(n_rows().alias("n"))


@query("SELECT event_type, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY 1")
def ag13_percentiles(t):
    return ms.percentiles(t("events"), "event_type", "value", {"p50": 0.5, "p95": 0.95})


@query("SELECT l_returnflag, list_sort(list(l_quantity))[1 + CAST(floor((count(l_quantity) - 1) * 0.95) AS INT)] AS p95 FROM lineitem GROUP BY 1")
def ag14_nearest_rank(t):
    # Counted per value first: what is sorted is the values and their counts, not the rows.
    counts = t("lineitem").groupBy("l_returnflag", "l_quantity").agg(n_rows().alias("k")).filter("l_quantity is not null")
    w = Window.partitionBy("l_returnflag")
    upto = counts.withColumns({"upto": F.sum("k").over(w.orderBy("l_quantity")), "total": F.sum("k").over(w)})
    return upto.filter(c("upto") > F.floor((c("total") - 1) * 0.95)).groupBy("l_returnflag").agg(F.min("l_quantity").alias("p95"))


@query("SELECT event_type AS stage, count(*) AS n, sum(value) AS total, avg(value) AS mean, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY 1")
def ag15_stage_timing(t):
    sums = t("events").groupBy(c("event_type").alias("stage")).agg(n_rows().alias("n"), F.sum("value").alias("total"), F.avg("value").alias("mean"))
    shares = ms.percentiles(t("events"), "event_type", "value", {"p50": 0.5, "p95": 0.95})
    return sums.join(shares, c("stage").eqNullSafe(c("event_type")), "left").drop("event_type")


@query("SELECT o_custkey, CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0 THEN count(*) FILTER (WHERE o_orderstatus = 'O') / count(*) FILTER (WHERE o_orderstatus = 'F') END AS ratio FROM orders GROUP BY 1")
def ag16_ratios(t):
    return t("orders").groupBy("o_custkey").agg(F.try_divide(F.count_if(c("o_orderstatus") == "O"), F.count_if(c("o_orderstatus") == "F")).alias("ratio"))


@query("WITH a AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-15'), b AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-15') SELECT (SELECT count(*) FROM b WHERE user_id NOT IN (SELECT user_id FROM a)) AS fresh, (SELECT count(*) FROM b WHERE user_id IN (SELECT user_id FROM a)) AS inherited, (SELECT count(*) FROM a WHERE user_id NOT IN (SELECT user_id FROM b)) AS lost")
def ag17_fresh_inherited(t):
    late = c("ts") >= F.lit("2024-01-15").cast("timestamp_ntz")
    k = t("events").groupBy("user_id").agg(F.bool_or(late).alias("b"), F.bool_or(~late).alias("a"))
    return k.agg(F.count_if(c("b") & ~c("a")).alias("fresh"), F.count_if(c("b") & c("a")).alias("inherited"), F.count_if(c("a") & ~c("b")).alias("lost"))


@query("SELECT o_custkey, CASE min(list_position(['O', 'P', 'F'], o_orderstatus)) WHEN 1 THEN 'O' WHEN 2 THEN 'P' WHEN 3 THEN 'F' END AS worst, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_p, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f FROM orders GROUP BY 1")
def ag18_worst_status(t):
    return ms.worst(t("orders"), "o_custkey", "o_orderstatus", ["O", "P", "F"])


_FILL = ["title", "price_eur", "listprice_eur", "rating", "seller", "brand"]


@query(" UNION ALL ".join(f"SELECT '{x}' AS field, count(*) FILTER (WHERE nullif(trim({x}), '') IS NOT NULL) AS filled, count(*) FILTER (WHERE nullif(trim({x}), '') IS NOT NULL) / count(*) AS rate FROM product_details" for x in _FILL))
def ag19_fill_rates(t):
    return ms.fill_rates(t("product_details"), _FILL)


@query("SELECT field, count(*) AS cells, count(*) FILTER (WHERE bad) AS defects FROM (SELECT asin, label_raw AS field, bool_or(nullif(trim(value_raw), '') IS NULL) AS bad FROM product_attributes GROUP BY 1, 2) GROUP BY 1")
def ag20_defect_rates(t):
    cells = t("product_attributes").groupBy("asin", c("label_raw").alias("field")).agg(F.bool_or(tx.present(c("value_raw")).isNull()).alias("bad"))
    return cells.groupBy("field").agg(n_rows().alias("cells"), F.count_if("bad").alias("defects"))


@query("WITH v AS (SELECT listing_id, field, value FROM (SELECT listing_id, brand, seller, availability FROM product_details) UNPIVOT (value FOR field IN (brand, seller, availability))), k AS (SELECT field, value, count(*) AS n FROM v GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY field ORDER BY count(*) DESC, value) <= 5), d AS (SELECT DISTINCT v.field, v.value, k.n, v.listing_id FROM v JOIN k USING (field, value)) SELECT field, value, n, string_agg(listing_id::VARCHAR, ',' ORDER BY listing_id) AS samples FROM (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY field, value ORDER BY listing_id) <= 5) GROUP BY 1, 2, 3")
def ag21_frequencies(t):
    return ms.frequencies(t("product_details"), ["brand", "seller", "availability"], "listing_id", 5)


@query("SELECT source, count(*) AS n, count(nullif(text, '')) AS filled, count(DISTINCT nullif(text, '')) AS distinct_texts, avg(length(text)) AS mean_length, max(length(text)) AS longest FROM documents GROUP BY 1")
def ag22_text_profile(t):
    return t("documents").groupBy("source").agg(n_rows().alias("n"), F.count(F.nullif("text", F.lit(""))).alias("filled"), F.countDistinct(F.nullif("text", F.lit(""))).alias("distinct_texts"), F.avg(F.length("text")).alias("mean_length"), F.max(F.length("text")).cast("bigint").alias("longest"))


@query("SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)")
def ag23_duplicate_count(t):
    return t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(n_rows().alias("n")).agg(F.sum(c("n") - 1).alias("duplicates"))


@query(f"SELECT page, count(*) AS n, count(DISTINCT asin) AS items, CASE WHEN count(DISTINCT rank) > 0 THEN max(rank) - min(rank) + 1 - count(DISTINCT rank) ELSE 0 END AS gaps, count(*) - count(DISTINCT asin) AS duplicates, array_to_string(list_filter([CASE WHEN count(DISTINCT asin) < 30 THEN 'TOO_FEW' END, CASE WHEN max(rank) - min(rank) + 1 > count(DISTINCT rank) THEN 'RANK_GAP' END, CASE WHEN count(*) > count(DISTINCT asin) THEN 'DUPLICATE' END], lambda x: x IS NOT NULL), ';') AS reasons FROM {CARD} GROUP BY 1")
def ag24_page_gate(t):
    return ms.page_gate(cards(t), "page", "rank", "asin", 30)


@query(f"SELECT page, CAST(max(rank) - min(rank) + 1 - count(DISTINCT rank) AS BIGINT) AS gaps FROM {CARD} WHERE rank IS NOT NULL GROUP BY 1")
def ag25_rank_gaps(t):
    return cards(t).filter("rank is not null").groupBy("page").agg((F.max("rank") - F.min("rank") + 1 - F.countDistinct("rank")).cast("bigint").alias("gaps"))


@query(f"SELECT snapshot_id, page, rank, count(DISTINCT asin) AS items FROM {CARD} WHERE rank IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT asin) > 1")
def ag26_slot_conflicts(t):
    return cards(t).filter("rank is not null").groupBy("snapshot_id", "page", "rank").agg(F.countDistinct("asin").alias("items")).filter("items > 1")


@query(f"WITH k AS (SELECT *, card_asin <> '' AND card_asin <> asin AS bad FROM {CARD}), h AS (SELECT asin, page, rank, bad FROM k QUALIFY row_number() OVER (PARTITION BY asin ORDER BY bad DESC, snapshot_id, page, card_index, coalesce(rank, -1)) = 1) SELECT k.asin, count(*) AS n, array_to_string(list_sort(list(DISTINCT evidence_source)), ';') AS evidence, count(DISTINCT k.page) AS pages, bool_or(k.bad) AS conflict, h.page AS header_page, h.rank AS header_rank FROM k JOIN h ON h.asin IS NOT DISTINCT FROM k.asin GROUP BY k.asin, h.page, h.rank")
def ag27_identity_groups(t):
    bad = (c("card_asin") != "") & (c("card_asin") != c("asin"))
    head = F.min(F.struct((~bad).alias("fine"), "snapshot_id", "page", "card_index", F.coalesce("rank", F.lit(-1)).alias("r"), "rank"))
    g = cards(t).groupBy("asin").agg(n_rows().alias("n"), F.array_join(F.array_sort(F.collect_set("evidence_source")), ";").alias("evidence"), F.countDistinct("page").alias("pages"), F.bool_or(bad).alias("conflict"), head.alias("h"))
    return g.select("asin", "n", "evidence", "pages", "conflict", c("h.page").alias("header_page"), c("h.rank").alias("header_rank"))


@query(f"SELECT snapshot_id, count(*) AS n, count(*) FILTER (WHERE rank IS NULL) AS no_rank, count(*) FILTER (WHERE raw_href IS NULL) AS no_href, count(DISTINCT asin) AS items, count(DISTINCT page) AS pages, max(ingested_at) AS last_ingested FROM {CARD} GROUP BY 1")
def ag28_manifest_counters(t):
    return cards(t).groupBy("snapshot_id").agg(n_rows().alias("n"), F.count_if(c("rank").isNull()).alias("no_rank"), F.count_if(c("raw_href").isNull()).alias("no_href"), F.countDistinct("asin").alias("items"), F.countDistinct("page").alias("pages"), F.max("ingested_at").alias("last_ingested"))


@query("SELECT bucket, count(*) AS items FROM (SELECT asin, max(CASE WHEN nullif(trim(price_eur), '') IS NULL THEN 3 WHEN nullif(trim(brand), '') IS NULL THEN 2 WHEN nullif(trim(rating), '') IS NULL THEN 1 ELSE 0 END) AS bucket FROM product_details GROUP BY 1) GROUP BY 1")
def ag29_disjoint_buckets(t):
    severity = F.when(tx.present(c("price_eur")).isNull(), 3).when(tx.present(c("brand")).isNull(), 2).when(tx.present(c("rating")).isNull(), 1).otherwise(0)
    return t("product_details").groupBy("asin").agg(F.max(severity).alias("bucket")).groupBy("bucket").agg(n_rows().alias("items"))


@query("SELECT event_type, avg(value) AS mean_s, count(*) AS n, count(*) FILTER (WHERE value > 10) AS overlong FROM events GROUP BY 1")
def ag30_capacity(t):
    return t("events").groupBy("event_type").agg(F.avg("value").alias("mean_s"), n_rows().alias("n"), F.count_if(c("value") > 10).alias("overlong"))


@query(f"SELECT CAST({madrid_sql('ts')} AS DATE) AS local_day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def ag31_daily_counts(t):
    from rastro.functions.dates import local_date

    return t("events").groupBy(local_date(c("ts")).alias("local_day"), "event_type").agg(n_rows().alias("n"))


@query("SELECT status, count(*) AS n FROM category_placements GROUP BY 1")
def ag32_histogram(t):
    return t("category_placements").groupBy("status").agg(n_rows().alias("n"))


@query("SELECT count(*) AS keys, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS in_groups FROM (SELECT md5(coalesce(text, '')) AS k, count(*) AS n FROM documents GROUP BY 1)")
def ag33_review_keys(t):
    k = t("documents").groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("k")).agg(n_rows().alias("n"))
    return k.agg(n_rows().alias("keys"), F.coalesce(F.sum(F.when(c("n") > 1, c("n"))), F.lit(0)).alias("in_groups"))


@query("SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'BLOCKED' WHEN bool_and(o_orderstatus = 'F') THEN 'RELEASED' ELSE 'PENDING' END AS state FROM orders GROUP BY 1")
def ag34_release_status(t):
    return t("orders").groupBy("o_custkey").agg(F.when(F.bool_or(c("o_orderstatus") == "P"), "BLOCKED").when(F.every(c("o_orderstatus") == "F"), "RELEASED").otherwise("PENDING").alias("state"))


@query("SELECT user_id, bool_or(event_type = 'error') AS blocked, CAST(5 - count(DISTINCT event_type) AS INT) AS n_missing FROM events GROUP BY 1")
def ag35_readiness(t):
    need = F.array(*map(F.lit, KINDS))
    return t("events").groupBy("user_id").agg(F.bool_or(c("event_type") == "error").alias("blocked"), F.size(F.array_except(need, F.collect_set("event_type"))).alias("n_missing"))


@query("WITH e AS (SELECT marketplace, category_name, CASE status WHEN 'DONE' THEN 'AVAILABLE' WHEN 'FAILED_FINAL' THEN 'UNSUPPORTED' WHEN 'PENDING' THEN 'TEMPORARY' ELSE 'BLOCKED' END AS s FROM category_placements) SELECT g.marketplace, g.category_name, CASE WHEN bool_or(s = 'AVAILABLE') THEN 'AVAILABLE' WHEN bool_or(s = 'BLOCKED') THEN 'BLOCKED' WHEN bool_or(s = 'TEMPORARY') THEN 'TEMPORARY' WHEN bool_and(s = 'UNSUPPORTED') THEN 'UNSUPPORTED' ELSE 'UNVERIFIED' END AS coverage FROM (SELECT DISTINCT marketplace, category_name FROM e WHERE category_name IS NOT NULL) g LEFT JOIN e ON e.marketplace = g.marketplace AND e.category_name = g.category_name GROUP BY 1, 2")
def ag36_coverage(t):
    p = t("category_placements")
    state = F.when(c("status") == "DONE", "AVAILABLE").when(c("status") == "FAILED_FINAL", "UNSUPPORTED").when(c("status") == "PENDING", "TEMPORARY").otherwise("BLOCKED")
    grid = p.filter("category_name is not null").select("marketplace", "category_name").distinct()
    return ms.coverage(grid, p.select("marketplace", "category_name", state.alias("s")), ["marketplace", "category_name"], "s")


@query("SELECT dimension, value, count(*) AS n FROM (SELECT unnest(['lang', 'source']) AS dimension, unnest([lang, source]) AS value FROM documents) GROUP BY 1, 2")
def ag37_histograms(t):
    return t("documents").unpivot([], ["lang", "source"], "dimension", "value").groupBy("dimension", "value").agg(n_rows().alias("n"))


@query("SELECT count(*) AS requests FROM (SELECT DISTINCT md5(text) AS k FROM documents WHERE text <> '' AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE source = 'care_guide' AND text IS NOT NULL))")
def ag38_request_plan(t):
    d = t("documents").withColumn("k", F.md5("text"))
    hit = d.filter("source = 'care_guide' and text is not null").select("k")
    return d.filter("text <> ''").select("k").distinct().join(hit, "k", "left_anti").agg(n_rows().alias("requests"))


@query("SELECT seller, count(*) AS n, count(nullif(trim(brand), '')) AS with_brand, count(DISTINCT asin) AS items FROM product_details GROUP BY 1")
def ag39_selection_summary(t):
    return t("product_details").groupBy("seller").agg(n_rows().alias("n"), F.count(tx.present(c("brand"))).alias("with_brand"), F.countDistinct("asin").alias("items"))


@query("SELECT category_name, count(*) AS n, CASE WHEN count(*) FILTER (WHERE status = 'DONE') = count(*) THEN 'COMPLETE' WHEN count(*) FILTER (WHERE status = 'DONE') > 0 THEN 'PARTIAL' ELSE 'OPEN' END AS state FROM category_placements GROUP BY 1")
def ag40_category_summary(t):
    done = F.count_if(c("status") == "DONE")
    return t("category_placements").groupBy("category_name").agg(n_rows().alias("n"), F.when(done == n_rows(), "COMPLETE").when(done > 0, "PARTIAL").otherwise("OPEN").alias("state"))


@query("""WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS a, -(o_orderkey % 997) - 1 AS b FROM orders), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
cc(node, component) USING KEY (node) AS (SELECT a, min(least(a, b)) FROM u GROUP BY a
UNION SELECT u.a, min(n.component) FROM u JOIN cc AS n ON n.node = u.b JOIN recurring.cc AS o ON o.node = u.a WHERE n.component < o.component GROUP BY u.a)
SELECT node, component FROM cc""")
def ag41_components(t):
    return ms.components(t("orders").select(c("o_custkey").alias("a"), (-(c("o_orderkey") % 997) - 1).alias("b")).distinct())


@query("SELECT source, md5(text) AS h, count(DISTINCT doc_id) AS pages, count(DISTINCT (coalesce(lang, ''), n_chars)) AS slots FROM documents WHERE text <> '' GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > 1")
def ag42_repeated_content(t):
    slot = F.struct(F.coalesce("lang", F.lit("")).alias("lang"), "n_chars")
    return t("documents").filter("text <> ''").groupBy("source", F.md5("text").alias("h")).agg(F.countDistinct("doc_id").alias("pages"), F.countDistinct(slot).alias("slots")).filter("pages > 1")


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS unique_ids, count(*) - count(DISTINCT event_id) AS clashes FROM (SELECT event_id FROM events WHERE event_type IN ('click', 'view') UNION ALL SELECT event_id FROM events WHERE event_type IN ('view', 'error'))")
def ag43_campaign(t):
    e = t("events").select("event_id", "event_type")
    both = e.filter(c("event_type").isin("click", "view")).unionByName(e.filter(c("event_type").isin("view", "error")))
    return both.agg(n_rows().alias("n"), F.countDistinct("event_id").alias("unique_ids"), (n_rows() - F.countDistinct("event_id")).alias("clashes"))


@query(f"WITH k AS (SELECT snapshot_id, page, page_number, rank, asin FROM {CARD} WHERE page_number IS NOT NULL), r AS (SELECT DISTINCT snapshot_id, page, asin FROM k WHERE page_number = 1) SELECT k.snapshot_id, k.page, coalesce(bool_or(k.rank > 16), false) AS beyond_first_frame, count(DISTINCT k.asin) FILTER (WHERE r.asin IS NULL) AS new_items FROM k LEFT JOIN r ON r.snapshot_id = k.snapshot_id AND r.page = k.page AND r.asin = k.asin GROUP BY 1, 2")
def ag44_loading(t):
    k = cards(t).filter("page_number is not null").select("snapshot_id", "page", "page_number", "rank", "asin")
    root = k.filter("page_number = 1").select("snapshot_id", "page", "asin").distinct().withColumn("known", F.lit(True))
    joined = k.join(root, ["snapshot_id", "page", "asin"], "left")
    return joined.groupBy("snapshot_id", "page").agg(F.coalesce(F.bool_or(c("rank") > 16), F.lit(False)).alias("beyond_first_frame"), F.countDistinct(F.when(c("known").isNull(), c("asin"))).alias("new_items"))


@query("SELECT a.k IS NOT NULL AS hit, count(*) AS terms, CAST(sum(n) AS BIGINT) AS weighted FROM (SELECT lower(label_raw) AS t, count(*) AS n FROM product_attributes WHERE label_raw IS NOT NULL GROUP BY 1) f LEFT JOIN (SELECT DISTINCT lower(label_es) AS k FROM attribute_columns) a ON a.k = f.t GROUP BY 1")
def ag45_dictionary_coverage(t):
    terms = t("product_attributes").filter("label_raw is not null").groupBy(F.lower("label_raw").alias("t")).agg(n_rows().alias("n"))
    known = t("attribute_columns").select(F.lower("label_es").alias("k")).distinct()
    return terms.join(known, c("t") == c("k"), "left").groupBy(c("k").isNotNull().alias("hit")).agg(n_rows().alias("terms"), F.sum("n").alias("weighted"))


@query(f"SELECT count(*) AS n, count(DISTINCT raw_href) AS urls, count(DISTINCT asin) AS items, count(DISTINCT CASE WHEN card_asin = asin THEN asin END) AS confirmed FROM {CARD}")
def ag46_populations(t):
    return cards(t).agg(n_rows().alias("n"), F.countDistinct("raw_href").alias("urls"), F.countDistinct("asin").alias("items"), F.countDistinct(F.when(c("card_asin") == c("asin"), c("asin"))).alias("confirmed"))


@query(f"SELECT page, count(*) FILTER (WHERE rank BETWEEN 1 AND 30) AS r1_30, count(*) FILTER (WHERE rank BETWEEN 31 AND 50) AS r31_50, count(*) FILTER (WHERE rank BETWEEN 51 AND 80) AS r51_80, min(rank) AS lo, max(rank) AS hi, array_to_string(list_sort(list(DISTINCT page_number)), ',') AS pages FROM {CARD} GROUP BY 1")
def ag47_rank_buckets(t):
    between = lambda a, b: F.count_if(c("rank").between(a, b))
    return cards(t).groupBy("page").agg(between(1, 30).alias("r1_30"), between(31, 50).alias("r31_50"), between(51, 80).alias("r51_80"), F.min("rank").alias("lo"), F.max("rank").alias("hi"), F.array_join(F.array_sort(F.collect_set("page_number")), ",").alias("pages"))


@query("WITH k AS (SELECT DISTINCT l_returnflag AS g, l_partkey AS id FROM lineitem), s AS (SELECT id FROM k GROUP BY 1 HAVING count(*) = 1) SELECT q.g, coalesce(n, 0) AS available, greatest(0, 500 - coalesce(n, 0)) AS shortfall FROM (SELECT unnest(['A', 'N', 'R', 'X']) AS g) q LEFT JOIN (SELECT g, count(*) AS n FROM k WHERE id IN (SELECT id FROM s) GROUP BY 1) a USING (g)")
def ag48_quota_readiness(t):
    groups = t("lineitem").groupBy("l_partkey").agg(F.min("l_returnflag").alias("g"), F.countDistinct("l_returnflag").alias("n")).filter("n = 1").groupBy("g").agg(n_rows().alias("available"))
    quotas = t("lineitem").sparkSession.createDataFrame([(x,) for x in "ANRX"], "g string")
    return quotas.join(groups, "g", "left").fillna(0, ["available"]).withColumn("shortfall", F.greatest(F.lit(0), 500 - c("available")))


@query("WITH f AS (SELECT user_id, event_type, min(event_id) AS e, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, min(e) AS first_event, CAST(sum(n) AS BIGINT) AS n, array_to_string(list(event_type ORDER BY e), ';') AS contexts, row_number() OVER (ORDER BY min(e)) AS position FROM f GROUP BY 1")
def ag49_first_occurrence(t):
    from rastro.operators.flow import running_total

    per = t("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("e"), n_rows().alias("n"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("e", "event_type"))), lambda x: x["event_type"]), ";")
    ids = per.groupBy("user_id").agg(F.min("e").alias("first_event"), F.sum("n").alias("n"), listed.alias("contexts"), F.lit(1).alias("one"))
    return running_total(ids, ["first_event"], "one", "position").select("user_id", "first_event", "n", "contexts", c("position").cast("bigint").alias("position"))


@query("SELECT coalesce(field, 'TOTAL') AS field, count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS missing, count(*) FILTER (WHERE value IS NOT NULL AND trim(value) = '') AS blank, count(*) FILTER (WHERE lower(trim(value)) IN ('genérico', 'marca blanca', 'n/d', '-')) AS placeholder FROM (SELECT field, value FROM (SELECT brand, seller, title, price_eur, rating FROM product_details) UNPIVOT INCLUDE NULLS (value FOR field IN (brand, seller, title, price_eur, rating))) GROUP BY GROUPING SETS ((field), ())")
def ag50_issue_matrix(t):
    p = t("product_details").select(F.lit(1).alias("one"), "brand", "seller", "title", "price_eur", "rating")
    long = p.unpivot("one", ["brand", "seller", "title", "price_eur", "rating"], "field", "value")
    issues = {"missing": c("value").isNull(), "blank": F.trim("value") == "", "placeholder": F.lower(F.trim("value")).isin("genérico", "marca blanca", "n/d", "-")}
    return long.groupingSets([[c("field")], []], c("field")).agg(n_rows().alias("n"), *[F.count_if(w).alias(k) for k, w in issues.items()]).withColumn("field", F.coalesce("field", F.lit("TOTAL")))


@query("SELECT asin, min(source_html) FILTER (WHERE regexp_matches(source_html, '^run_[0-9]+/')) AS page, count(*) FILTER (WHERE regexp_matches(source_html, '^run_[0-9]+/')) AS valid, count(*) FILTER (WHERE coalesce(source_html, '') = '') AS missing, count(*) FILTER (WHERE source_html <> '' AND NOT regexp_matches(source_html, '^run_[0-9]+/')) AS other FROM saved_cases GROUP BY 1")
def ag51_first_valid_page(t):
    h = c("source_html")
    ok = h.rlike("^run_[0-9]+/")
    return t("saved_cases").groupBy("asin").agg(F.min(F.when(ok, h)).alias("page"), F.count_if(ok).alias("valid"), F.count_if(F.coalesce(h, F.lit("")) == "").alias("missing"), F.count_if((h != "") & ~ok).alias("other"))


@query("SELECT k.status, coalesce(n, 0) AS n FROM (SELECT unnest(['DONE', 'PENDING', 'IN_PROGRESS', 'FAILED_FINAL', 'CANCELLED']) AS status) k LEFT JOIN (SELECT status, count(*) AS n FROM category_placements GROUP BY 1) g USING (status)")
def ag52_zero_filled(t):
    domain = t("region").sparkSession.createDataFrame([(x,) for x in ("DONE", "PENDING", "IN_PROGRESS", "FAILED_FINAL", "CANCELLED")], "status string")
    return domain.join(t("category_placements").groupBy("status").agg(n_rows().alias("n")), "status", "left").fillna(0, ["n"])


@query("WITH b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events), f AS (SELECT event_type, user_id, min(ts) AS first FROM events GROUP BY 1, 2), n AS (SELECT event_type, count(*) FILTER (WHERE first > lo AND first <= lo + INTERVAL 10 DAY) AS captured FROM f, b GROUP BY 1) SELECT event_type, captured, 150 * 10.0 / 30 AS expected, captured / (150 * 10.0 / 30) AS ratio, captured / (150 * 10.0 / 30) < 0.8 AS alert FROM n")
def ag53_progress(t):
    start = t("events").agg(F.min("ts").alias("start"))
    first = t("events").groupBy("event_type", "user_id").agg(F.min("ts").alias("first")).join(F.broadcast(start))
    return ms.progress(first, "event_type", "first", c("start"), c("start") + F.expr("INTERVAL 10 DAYS"), 150, 10 / 30)


@query("SELECT evidence_source, count(*) AS n, count(DISTINCT raw_href) AS urls, count(*) FILTER (WHERE representation_type = 'RANKING_CARD') AS cards, count(*) FILTER (WHERE representation_type = 'SUPPLEMENTAL') AS supplemental, count(*) FILTER (WHERE representation_type IS NULL) AS no_state FROM identity_candidates GROUP BY 1")
def ag54_type_counts(t):
    kind = c("representation_type")
    return t("identity_candidates").groupBy("evidence_source").agg(n_rows().alias("n"), F.countDistinct("raw_href").alias("urls"), F.count_if(kind == "RANKING_CARD").alias("cards"), F.count_if(kind == "SUPPLEMENTAL").alias("supplemental"), F.count_if(kind.isNull()).alias("no_state"))


@query("SELECT event_type, count(*) AS n, bool_and(value > 0) AS ok FROM events GROUP BY 1")
def ag55_merge_aggregates(t):
    part = lambda df: df.groupBy("event_type").agg(n_rows().alias("n"), F.every(c("value") > 0).alias("ok"))
    e = t("events")
    return part(e.filter("user_id % 2 = 0")).unionByName(part(e.filter("user_id % 2 <> 0"))).groupBy("event_type").agg(F.sum("n").alias("n"), F.every("ok").alias("ok"))


# ---- windows ----------------------------------------------------------------------------------------------------


@query(f"SELECT l_returnflag, l_partkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_partkey ORDER BY {ORDER_SQL}) = 1")
def wn1_best_per_group(t):
    return rows.first_by(t("lineitem"), ["l_returnflag", "l_partkey"], [c(x) for x in ORDER]).select("l_returnflag", "l_partkey", "l_orderkey", "l_linenumber")


@query("SELECT asin, evidence_source, rank FROM (SELECT upper(trim(asin)) AS asin, evidence_source, rank, row_number() OVER (PARTITION BY upper(trim(asin)) ORDER BY CASE evidence_source WHEN 'saved_html' THEN 0 WHEN 'ajax' THEN 1 ELSE 2 END, rank NULLS LAST) AS r FROM identity_candidates) WHERE r = 1")
def wn2_best_evidence(t):
    order = F.when(c("evidence_source") == "saved_html", 0).when(c("evidence_source") == "ajax", 1).otherwise(2)
    return rows.first_by(cards(t), ["asin"], [order, F.asc_nulls_last("rank")]).select("asin", "evidence_source", "rank")


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def wn3_first_wins(t):
    return rows.first_by(t("events"), ["user_id", "event_type"], [c("event_id")]).select("user_id", "event_type", "event_id")


@query("SELECT user_id, CAST(ts AS DATE) AS day, event_id, n - 1 AS collapsed FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS r, count(*) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS n FROM events) WHERE r = 1")
def wn4_latest_per_day(t):
    best = t("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max(F.struct("ts", "event_id")).alias("b"), n_rows().alias("n"))
    return best.select("user_id", "day", "b.event_id", (c("n") - 1).alias("collapsed"))


_STREAKS = "(SELECT user_id, min(d) AS start, count(*) AS days FROM (SELECT user_id, d, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INT) AS i FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events)) GROUP BY user_id, i)"


@query(f"SELECT user_id, CAST(start AS DATE) AS start, days FROM {_STREAKS}")
def wn5_streaks(t):
    return tl.streaks(t("events").select("user_id", F.to_date("ts").alias("day")), ["user_id"], "day")


@query(f"SELECT user_id, days FROM {_STREAKS} WHERE start + CAST(days AS INT) - 1 = (SELECT max(CAST(ts AS DATE)) FROM events)")
def wn6_current_streak(t):
    day = t("events").select("user_id", F.to_date("ts").alias("day"))
    last = day.agg(F.max("day").alias("last"))
    return tl.streaks(day, ["user_id"], "day").join(F.broadcast(last)).filter(F.date_add("start", (c("days") - 1).cast("int")) == c("last")).select("user_id", "days")


_STATES = "(SELECT user_id, CAST(ts AS DATE) AS day, CASE WHEN bool_or(event_type = 'purchase') THEN 'present' WHEN bool_or(event_type = 'error') THEN 'unknown' ELSE 'absent' END AS state FROM events GROUP BY 1, 2)"


@query(f"SELECT user_id, day FROM (SELECT *, lag(day) OVER w AS pd, lag(state) OVER w AS ps, min(CASE WHEN state = 'present' THEN day END) OVER w AS seen FROM {_STATES} WINDOW w AS (PARTITION BY user_id ORDER BY day)) WHERE state = 'present' AND ps = 'absent' AND day - pd = 1 AND seen < day")
def wn7_reappearances(t):
    state = F.when(F.bool_or(c("event_type") == "purchase"), "present").when(F.bool_or(c("event_type") == "error"), "unknown").otherwise("absent")
    return tl.reappearances(t("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(state.alias("state")), ["user_id"], "day", "state")


@query("SELECT user_id, change FROM (SELECT user_id, lag(v) OVER (PARTITION BY user_id ORDER BY d) - v AS change, row_number() OVER (PARTITION BY user_id ORDER BY d DESC) AS r FROM (SELECT user_id, CAST(ts AS DATE) AS d, min(value) AS v FROM events GROUP BY 1, 2)) WHERE r = 1")
def wn8_latest_change(t):
    daily = t("events").groupBy("user_id", F.to_date("ts").alias("d")).agg(F.min("value").alias("v"))
    w = Window.partitionBy("user_id")
    return daily.withColumns({"change": F.lag("v").over(w.orderBy("d")) - c("v"), "r": F.row_number().over(w.orderBy(F.desc("d")))}).filter("r = 1").select("user_id", "change")


@query(f"SELECT asin, snapshot_id, page, rank, min(rank) OVER (PARTITION BY asin) AS best FROM {CARD}")
def wn9_best_rank(t):
    return cards(t).select("asin", "snapshot_id", "page", "rank", F.min("rank").over(Window.partitionBy("asin")).alias("best"))


@query("SELECT user_id, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day, count(DISTINCT CAST(ts AS DATE)) AS days, count(*) AS n FROM events GROUP BY 1")
def wn10_days(t):
    day = F.to_date("ts")
    return t("events").groupBy("user_id").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.countDistinct(day).alias("days"), n_rows().alias("n"))


@query("WITH f AS (SELECT event_type, user_id, min(CAST(ts AS DATE)) AS d FROM events GROUP BY 1, 2), g AS (SELECT k.event_type, k.d, coalesce(n, 0) AS new FROM (SELECT DISTINCT event_type, CAST(ts AS DATE) AS d FROM events) k LEFT JOIN (SELECT event_type, d, count(*) AS n FROM f GROUP BY 1, 2) x USING (event_type, d)) SELECT event_type, d, new, CAST(sum(new) OVER (PARTITION BY event_type ORDER BY d) AS BIGINT) AS seen, new / (24.0 * (d - lag(d) OVER (PARTITION BY event_type ORDER BY d))) AS per_hour FROM g")
def wn11_cumulative_distinct(t):
    return tl.cumulative_distinct(t("events").select("event_type", "user_id", F.to_date("ts").alias("d")), ["event_type"], "d", "user_id")


@query("WITH e AS (SELECT event_id, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events), k AS (SELECT a.event_id, a.s, a.n, coalesce(max(x.s), f.s) AS base, coalesce(max(x.n), 1) AS bn FROM e a JOIN (SELECT user_id, s FROM e WHERE n = 1) f ON f.user_id = a.user_id LEFT JOIN e x ON x.user_id = a.user_id AND x.s <= a.s - 300 GROUP BY a.event_id, a.s, a.n, f.s) SELECT event_id, CASE WHEN s > base THEN (n - bn) * 3600 / (s - base) END AS per_hour, CASE WHEN s > base AND n > bn THEN greatest(50 - n, 0) * (s - base) / ((n - bn) * 3600) END AS eta_hours FROM k")
def wn12_trailing_rate(t):
    rates = tl.trailing_rate(t("events").select("event_id", "user_id", "ts"), ["user_id"], "ts", "event_id", 300, 50)
    return rates.select("event_id", "per_hour", "eta_hours")


@query("SELECT event_type, quantile_cont(g, 0.5) AS p50, quantile_cont(g, 0.95) AS p95 FROM (SELECT event_type, CAST(trunc(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id))) AS BIGINT) AS g FROM events) GROUP BY 1")
def wn13_gaps(t):
    return ms.percentiles(tl.gaps_between(t("events").select("event_type", "ts", "event_id"), ["event_type"], "ts", "event_id"), "event_type", "gap_s", {"p50": 0.5, "p95": 0.95})


@query("SELECT user_id, min(g) < 60 AS too_fast FROM (SELECT user_id, CAST(trunc(epoch(ts) - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) AS BIGINT) AS g FROM events) GROUP BY 1")
def wn14_pacing(t):
    return tl.gaps_between(t("events"), ["user_id"], "ts", "event_id").groupBy("user_id").agg((F.min("gap_s") < 60).alias("too_fast"))


@query("SELECT event_type, day, count(*) FILTER (WHERE sighting = 'FIRST_SEEN') AS first_seen, count(*) FILTER (WHERE sighting = 'REUSED_OTHER_DAY') AS reused_other_day, count(*) FILTER (WHERE sighting = 'REUSED_SAME_DAY') AS reused_same_day FROM (SELECT event_type, CAST(ts AS DATE) AS day, CASE WHEN row_number() OVER (PARTITION BY event_type, user_id, CAST(ts AS DATE) ORDER BY ts, event_id) > 1 THEN 'REUSED_SAME_DAY' WHEN CAST(ts AS DATE) > min(CAST(ts AS DATE)) OVER (PARTITION BY event_type, user_id) THEN 'REUSED_OTHER_DAY' ELSE 'FIRST_SEEN' END AS sighting FROM events) WHERE day IN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 7) GROUP BY 1, 2")
def wn15_sightings(t):
    seen = tl.sightings(t("events").withColumn("day", F.to_date("ts")), ["event_type"], "user_id", "day", [c("ts"), c("event_id")])
    return tl.sighting_history(seen, ["event_type"], "day", 7)


@query("SELECT event_id, CASE WHEN value IS NULL THEN 'INVALID' WHEN event_type = 'error' THEN 'IDENTITY_UNCONFIRMED' WHEN coalesce(sum((event_type <> 'error' AND value IS NOT NULL)::INT) OVER (PARTITION BY CAST(ts AS DATE), user_id % 100 ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 THEN 'UNIQUE' WHEN count(*) OVER (PARTITION BY CAST(ts AS DATE), user_id % 100, user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 THEN 'EXACT_DUPLICATE' ELSE 'NORMALIZED_DUPLICATE' END AS status FROM events")
def wn16_duplicate_status(t):
    e = t("events").withColumns({"day": F.to_date("ts"), "item": c("user_id") % 100})
    return tl.duplicate_status(e, "day", "item", "user_id", [c("ts"), c("event_id")], c("event_type") != "error", c("value").isNotNull()).select("event_id", "status")


@query("SELECT event_id, min(event_id) OVER (PARTITION BY user_id) AS representative, min(event_id) OVER (PARTITION BY user_id) = event_id AS eligible FROM events")
def wn17_representative(t):
    first = F.min("event_id").over(Window.partitionBy("user_id"))
    return t("events").select("event_id", first.alias("representative"), (first == c("event_id")).alias("eligible"))


@query("SELECT event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1 OR event_type = 'signup'")
def wn18_first_or_verified(t):
    at = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    return t("events").withColumn("r", at).filter((c("r") == 1) | (c("event_type") == "signup")).select("event_id")


@query("SELECT asin, section, count(*) - count(DISTINCT position) AS repeated, CAST(coalesce(sum((p > position)::INT), 0) AS BIGINT) AS descending FROM (SELECT asin, section, position, lag(position) OVER (PARTITION BY asin, section ORDER BY attr_id, position, captured_at) AS p FROM product_attributes) GROUP BY 1, 2")
def wn19_positions(t):
    before = F.lag("position").over(Window.partitionBy("asin", "section").orderBy("attr_id", "position", "captured_at"))
    a = t("product_attributes").withColumn("p", before).groupBy("asin", "section")
    return a.agg((n_rows() - F.countDistinct("position")).alias("repeated"), F.count_if(c("p") > c("position")).alias("descending"))


@query(f"SELECT snapshot_id, asin, page, count(*) OVER (PARTITION BY snapshot_id, asin) AS contexts FROM {CARD}")
def wn20_contexts(t):
    return cards(t).select("snapshot_id", "asin", "page", F.count(F.lit(1)).over(Window.partitionBy("snapshot_id", "asin")).alias("contexts"))


@query("WITH d AS (SELECT DISTINCT event_type, user_id % 50 AS shop, CAST(ts AS DATE) AS d FROM events) SELECT event_type, shop, d AS start FROM d WHERE (SELECT count(*) FROM d x WHERE x.event_type = d.event_type AND x.shop = d.shop AND x.d BETWEEN d.d AND d.d + 13) = 14")
def wn21_day_window(t):
    return tl.full_windows(t("events").select("event_type", (c("user_id") % 50).alias("shop"), F.to_date("ts").alias("d")), ["event_type", "shop"], "d", 14)


@query("SELECT snapshot_id, asin, raw_href, CAST(length(raw_href) AS BIGINT) AS widest FROM (SELECT DISTINCT snapshot_id, asin, raw_href FROM identity_candidates WHERE raw_href IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY snapshot_id, asin ORDER BY length(raw_href) DESC, raw_href DESC) = 1")
def wn22_widest_capture(t):
    cards_ = t("identity_candidates").filter("raw_href is not null")
    best = cards_.groupBy("snapshot_id", "asin").agg(F.max(F.struct(F.length("raw_href").cast("bigint").alias("widest"), "raw_href")).alias("b"))
    return best.select("snapshot_id", "asin", "b.raw_href", "b.widest")


@query("SELECT source_url, observed_at, arg_max(snapshot_id, (n, snapshot_id)) AS snapshot_id, max(n) AS n FROM (SELECT source_url, observed_at, snapshot_id, count(*) AS n FROM identity_candidates WHERE source_url IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY observed_at DESC NULLS LAST) <= 3")
def wn22_retained_pages(t):
    pages = t("identity_candidates").filter("source_url is not null").groupBy("source_url", "observed_at", "snapshot_id").agg(F.count(F.lit(1)).alias("n"))
    return tl.latest_widest_pages(pages, ["source_url"], [], "observed_at", "snapshot_id", "n", 3)


@query(f"SELECT page, rank + 1 AS from_value, nx - 1 AS to_value FROM (SELECT page, rank, lead(rank) OVER (PARTITION BY page ORDER BY rank) AS nx FROM (SELECT DISTINCT page, rank FROM {CARD} WHERE rank IS NOT NULL)) WHERE nx > rank + 1")
def wn23_missing_ranges(t):
    return tl.missing_ranges(cards(t).filter("rank is not null").select("page", "rank").distinct(), ["page"], "rank")


@query(f"WITH p AS (SELECT page, regexp_extract(page, '/gp/[^/]+/([^/]+)', 1) AS kind, count(*) AS n FROM {CARD} GROUP BY 1, 2) SELECT page, CAST(sum(n) OVER (ORDER BY page) AS BIGINT) AS upto, sum(n) OVER (ORDER BY page) <= 5000 AS within, page = min(page) OVER (PARTITION BY kind) AS first_of_kind FROM p")
def wn24_budget_prefix(t):
    from rastro.operators.flow import running_total

    pages = cards(t).groupBy("page", F.regexp_extract("page", "/gp/[^/]+/([^/]+)", 1).alias("kind")).agg(n_rows().alias("n"))
    first = pages.groupBy("kind").agg(F.min("page").alias("first"))
    total = running_total(pages, ["page"], "n", "upto").join(first, "kind")
    return total.select("page", c("upto").cast("bigint").alias("upto"), (c("upto") <= 5000).alias("within"), (c("page") == c("first")).alias("first_of_kind"))


@query(r"SELECT tail, count(*) AS n FROM (SELECT regexp_replace(regexp_replace(source_url, '[?#].*$', ''), '/ref=.*$', '') AS tail FROM identity_candidates) GROUP BY 1")
def ur10_alias_groups(t):
    return t("identity_candidates").groupBy(F.regexp_replace(F.regexp_replace("source_url", r"[?#].*$", ""), "/ref=.*$", "").alias("tail")).agg(n_rows().alias("n"))


@query("SELECT asin, label_raw, value_raw FROM product_attributes WHERE label_raw IS NOT NULL AND value_raw <> '' AND asin IS NOT NULL QUALIFY row_number() OVER (PARTITION BY asin, label_raw ORDER BY position, attr_id, captured_at) = 1")
def ar4_first_wins_map(t):
    stated = t("product_attributes").filter("label_raw is not null and value_raw <> '' and asin is not null")
    first = rows.first_by(stated, ["asin", "label_raw"], [c("position"), c("attr_id"), c("captured_at")])
    packed = first.groupBy("asin").agg(F.map_from_entries(F.collect_list(F.struct("label_raw", "value_raw"))).alias("m"))
    return packed.select("asin", F.explode("m").alias("label_raw", "value_raw"))


@query("SELECT context_id, CAST(coalesce(len(list_distinct(list_filter(feature_bullets_raw, lambda x: contains(x, ':')))), 0) AS INT) AS labelled FROM capacity_context")
def ar5_bullet_attributes(t):
    return t("capacity_context").select("context_id", F.coalesce(F.size(F.array_distinct(F.filter("feature_bullets_raw", lambda x: F.contains(x, F.lit(":"))))), F.lit(0)).alias("labelled"))


@query("SELECT asin, min(value_raw) AS brand FROM product_attributes WHERE lower(trim(label_raw, ' ')) IN ('marca', 'brand') AND value_raw <> '' GROUP BY 1")
def ar6_attribute_brand(t):
    return t("product_attributes").filter(F.lower(F.trim("label_raw")).isin("marca", "brand") & (c("value_raw") != "")).groupBy("asin").agg(F.min("value_raw").alias("brand"))


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1")
def dt6_period(t):
    return t("events").groupBy(F.to_date("ts").alias("day")).agg(n_rows().alias("n"), F.countDistinct("event_type").alias("kinds"))


def queries() -> dict:
    return QUERIES


def oracles() -> dict[str, str]:
    return ORACLES
