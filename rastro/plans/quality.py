"""Queries of the composite checks and gates, one per survey id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.functions import arrays as ar
from rastro.functions import numbers as nu
from rastro.functions import specs as sp
from rastro.functions import text as tx
from rastro.functions import urls as ur
from rastro.operators import gates
from rastro.operators import quality as ql
from rastro.operators.snapshot_diff import clean_page_url
from rastro.plans.analytics import CARD, cards
from rastro.plans.scalars import _price_sql
from rastro.session import read

c = F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
STOP = "|".join(tx.BRAND_STOP_WORDS)


def query(sql: str | None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda table: read(spark, sf_dir, table))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def union(table: str, key: str, rules: list[tuple[str, str, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT {key}, '{code}' AS code, '{sev}' AS severity, '{field}' AS field FROM {table} WHERE {when}" for code, sev, field, when in rules)


_RATING = r"TRY_CAST(nullif(replace(regexp_extract(rating, '^\s*([0-9]+(?:[.,][0-9]+)?)', 1), ',', '.'), '') AS DOUBLE)"


_CARD_URL = "nullif(upper(coalesce(nullif(regexp_extract(raw_href, '(?i)/(?:dp|gp/product|product)/([A-Z0-9]{10})', 1), ''), regexp_extract(raw_href, '/([A-Z0-9]{10})(?:[/?#]|$)', 1))), '')"
_ASIN = "upper(trim(coalesce(asin, '')))"


@query(union("identity_candidates", "snapshot_id, card_index, asin", [("ASIN_INVALID", "P0", "asin", f"NOT regexp_matches({_ASIN}, '^[A-Z0-9]{{10}}$')"), ("URL_ASIN_MISMATCH", "P0", "product_url", f"{_ASIN} <> '' AND {_CARD_URL} <> {_ASIN}"), ("IMAGE_ASIN_MISMATCH", "P0", "image_url", f"{_ASIN} <> '' AND nullif(upper(trim(card_asin)), '') <> {_ASIN}"), ("LIMITED_IDENTITY_EVIDENCE", "P2", "raw_href", f"{_CARD_URL} IS NULL")]))
def dq1_identity(t):
    """Cards as records: the card's own id stands for that of the picture beside it."""
    return ql.issues(t("identity_candidates"), ["snapshot_id", "card_index", "asin"], ql.identity_rules(c("asin"), c("raw_href"), c("card_asin")))


@query(union("product_details", "listing_id", [("PRICE_INVALID", "P1", "price_eur", f"nullif(trim(price_eur), '') IS NOT NULL AND ({_price_sql('price_eur')}) IS NULL"), ("ORIGINAL_PRICE_INVALID", "P1", "listprice_eur", f"({_price_sql('listprice_eur')}) <= ({_price_sql('price_eur')})")]))
def dq2_prices(t):
    rules = [("PRICE_INVALID", "P1", "price_eur", tx.present(c("price_eur")).isNotNull() & nu.price(c("price_eur")).isNull()), ("ORIGINAL_PRICE_INVALID", "P1", "listprice_eur", nu.price(c("listprice_eur")) <= nu.price(c("price_eur")))]
    return ql.issues(t("product_details"), ["listing_id"], rules)


@query(union("product_details", "listing_id", [("RATING_INVALID", "P2", "rating", f"nullif(trim(rating), '') IS NOT NULL AND coalesce({_RATING} NOT BETWEEN 0 AND 5, true)"), ("REVIEW_COUNT_INVALID", "P2", "reviews", "nullif(trim(reviews), '') IS NOT NULL AND NOT regexp_matches(reviews, '^[0-9]+([. ][0-9]{3})*$')")]))
def dq3_ratings(t):
    rules = [("RATING_INVALID", "P2", "rating", tx.present(c("rating")).isNotNull() & nu.rating(c("rating")).isNull()), ("REVIEW_COUNT_INVALID", "P2", "reviews", tx.present(c("reviews")).isNotNull() & ~c("reviews").rlike(r"^[0-9]+([. ][0-9]{3})*$"))]
    return ql.issues(t("product_details"), ["listing_id"], rules)


@query(union("product_details", "listing_id", [("BRAND_MISSING", "P2", "brand", "nullif(trim(brand), '') IS NULL"), ("BRAND_FALSE_POSITIVE", "P1", "brand", f"regexp_matches(trim(brand), '(?i)\\b({STOP})\\b')")]))
def dq4_brands(t):
    return ql.issues(t("product_details"), ["listing_id"], [("BRAND_MISSING", "P2", "brand", tx.present(c("brand")).isNull()), ("BRAND_FALSE_POSITIVE", "P1", "brand", F.trim("brand").rlike(rf"(?i)\b({STOP})\b"))])


@query(union("product_attributes", "attr_id", [("SPEC_UNIT_MISMATCH", "P1", "value_raw", f"contains(lower(label_raw), 'peso') AND ({sp.unit_class_sql('value_raw')}) <> 'weight'"), ("SPEC_SUSPICIOUS_VALUE", "P2", "value_raw", r"regexp_matches(value_raw, '^\s*1\s*[xX×]\s*1(\s*[xX×]\s*1)?\s*([a-z]|$)')")]))
def dq5_specifications(t):
    rules = [("SPEC_UNIT_MISMATCH", "P1", "value_raw", F.contains(F.lower("label_raw"), F.lit("peso")) & (sp.unit_class(c("value_raw")) != "weight")), ("SPEC_SUSPICIOUS_VALUE", "P2", "value_raw", sp.suspicious_dimension(c("value_raw")))]
    return ql.issues(t("product_attributes"), ["attr_id"], rules)


@query(union("product_details", "listing_id", [("RANK_BSR_MIXED", "P0", "rank", "regexp_replace(regexp_extract(bsr, 'n\\.?º?\\s*([0-9.,]+)\\s+en\\s+', 1), '[.,]', '', 'g') = rank"), ("RANK_SOURCE_MISSING", "P2", "rank", "nullif(trim(rank), '') IS NULL")]))
def dq6_rank_separation(t):
    rules = [("RANK_BSR_MIXED", "P0", "rank", F.get(ar.rank_segments(c("bsr")), 0)["rank"] == c("rank")), ("RANK_SOURCE_MISSING", "P2", "rank", tx.present(c("rank")).isNull())]
    return ql.issues(t("product_details"), ["listing_id"], rules)


@query(union("category_placements", "placement_id", [("CATEGORY_DUPLICATED_LEVEL", "P2", "category_name", "string_split(category_name, ' y ')[1] = string_split(category_name, ' y ')[2]"), ("CATEGORY_UNVERIFIED_LEAF", "P3", "category_name", "nullif(trim(category_name), '') IS NULL")]))
def dq7_categories(t):
    parts = F.split("category_name", " y ")
    return ql.issues(t("category_placements"), ["placement_id"], [("CATEGORY_DUPLICATED_LEVEL", "P2", "category_name", F.get(parts, 0) == F.get(parts, 1)), ("CATEGORY_UNVERIFIED_LEAF", "P3", "category_name", tx.present(c("category_name")).isNull())])


@query(union("product_details", "listing_id", [("TITLE_UNTRANSLATED_TEXT", "P3", "title", "regexp_matches(title, '(?i)\\b(black|white|red|blue|green|yellow|grey|pink)\\b')"), ("TITLE_BRAND_DUPLICATION", "P3", "title", "length(lower(title)) - length(replace(lower(title), lower(brand), '')) > length(brand) AND length(brand) > 3")]))
def dq8_titles(t):
    twice = (F.length(F.lower("title")) - F.length(F.replace(F.lower("title"), F.lower("brand"), F.lit(""))) > F.length("brand")) & (F.length("brand") > 3)
    return ql.issues(t("product_details"), ["listing_id"], [("TITLE_UNTRANSLATED_TEXT", "P3", "title", c("title").rlike(r"(?i)\b(black|white|red|blue|green|yellow|grey|pink)\b")), ("TITLE_BRAND_DUPLICATION", "P3", "title", twice)])


_KIND = "CASE " + " ".join(f"WHEN contains(translate(lower({{0}}), '{tx.ACCENTED}', '{tx.PLAIN}'), '{w}') THEN '{k}'" for w, k in tx.KINDS) + " END"


@query(f"SELECT p.listing_id, 'SOURCE_CONFLICT' AS code, 'P1' AS severity, 'title' AS field FROM product_details p JOIN (SELECT asin, min(title_es_raw) AS other FROM saved_cases GROUP BY 1) s USING (asin) WHERE ({_KIND.format('p.title')}) <> ({_KIND.format('s.other')})")
def dq9_title_conflict(t):
    other = t("saved_cases").groupBy("asin").agg(F.min("title_es_raw").alias("other"))
    return ql.issues(t("product_details").join(other, "asin"), ["listing_id"], [("SOURCE_CONFLICT", "P1", "title", tx.product_kind(c("title")) != tx.product_kind(c("other")))])


@query(union("product_details", "listing_id", [("MONTHLY_BOUGHT_UNPARSEABLE", "P3", "availability", "nullif(trim(availability), '') IS NOT NULL AND NOT regexp_matches(availability, '^\\s*[0-9.,]+\\s*(mil|k)?\\s*\\+')")]))
def dq10_monthly_bought(t):
    return ql.issues(t("product_details"), ["listing_id"], [("MONTHLY_BOUGHT_UNPARSEABLE", "P3", "availability", tx.present(c("availability")).isNotNull() & nu.monthly_bought(c("availability")).isNull())])


@query("SELECT asin, CASE WHEN bool_or(f) THEN 'FAIL' WHEN sum(n) > 0 THEN 'WARN' ELSE 'PASS' END AS state, bool_or(f) AS blocks, CAST(sum(n) AS BIGINT) AS issues FROM (SELECT asin, nullif(trim(price_eur), '') IS NULL AS f, (nullif(trim(price_eur), '') IS NULL)::INT + (nullif(trim(brand), '') IS NULL)::INT AS n FROM product_details) GROUP BY 1")
def dq11_record_states(t):
    p = t("product_details")
    found = ql.issues(p, ["asin"], [("PRICE_MISSING", "P1", "price_eur", tx.present(c("price_eur")).isNull()), ("BRAND_MISSING", "P2", "brand", tx.present(c("brand")).isNull())])
    return ql.record_states(p, found, "asin")


_COUNT_LABEL = r"regexp_matches(lower(label_raw), '(piezas|unidades|pieces|cantidad)')"
_COUNT_VALUE = f"CASE WHEN ({sp.unit_class_sql('trim(value_raw)')}) IS NULL THEN TRY_CAST(nullif(replace(regexp_extract(regexp_replace(value_raw, '\\s', '', 'g'), '^([0-9]+(?:[.,][0-9]+)?)', 1), ',', '.'), '') AS DOUBLE) END"


@query(f"SELECT asin, max({_COUNT_VALUE}) AS pieces FROM product_attributes WHERE asin IS NOT NULL AND {_COUNT_LABEL} GROUP BY 1")
def sp4_package_count(t):
    a = t("product_attributes").filter(c("asin").isNotNull() & F.lower("label_raw").rlike("(piezas|unidades|pieces|cantidad)"))
    return a.groupBy("asin").agg(F.max(sp.count_value(c("value_raw"))).alias("pieces"))




def _count_sql(x: str, pattern: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({x}, '{pattern}', 1), '') AS INT)"


_UNITS = _count_sql(f"regexp_replace(variant, '{sp.COUNT_AFTER}.*$', '')", sp.COUNT_BEFORE)


@query(f"""WITH m AS (SELECT asin, max({_COUNT_VALUE}) AS most FROM product_attributes WHERE asin IS NOT NULL AND {_COUNT_LABEL} GROUP BY 1),
d AS (SELECT DISTINCT p.listing_id, p.title, CASE WHEN p.listing_id % 4 = 0 THEN (p.listing_id % 3 + 1) || ' unidades (Paquete de ' || (p.listing_id % 5 + 1) || ')' END AS variant, m.most FROM product_details p LEFT JOIN m USING (asin)),
n AS (SELECT listing_id, {_UNITS} AS u, {_count_sql('variant', sp.COUNT_AFTER)} AS k, coalesce({_count_sql('title', sp.COUNT_BEFORE)}, {_count_sql('title', sp.COUNT_AFTER)}) AS t, most FROM d)
SELECT listing_id, CASE WHEN u IS NOT NULL OR k IS NOT NULL THEN CASE WHEN coalesce(u, 1) * coalesce(k, 1) > 1 THEN coalesce(u, 1) * coalesce(k, 1) END WHEN t > 1 THEN t WHEN most > 1 AND most = floor(most) THEN CAST(most AS INT) END AS pieces FROM n""")
def sp5_count_precedence(t):
    key = c("listing_id")
    variant = F.when(key % 4 == 0, F.concat((key % 3 + 1).cast("string"), F.lit(" unidades (Paquete de "), (key % 5 + 1).cast("string"), F.lit(")")))
    d = t("product_details").join(sp4_package_count(t), "asin", "left").select("listing_id", "title", variant.alias("variant"), c("pieces").alias("most")).distinct()
    nothing = F.lit(None).cast("string")
    return d.select("listing_id", sp.resolved_count(c("variant"), c("title"), nothing, nothing, c("most")).alias("pieces"))


@query(" UNION ALL ".join(f"SELECT listing_id, '{n}' AS field, CASE WHEN coalesce(trim({s}), '') = '' THEN 'SOURCE_MISSING' WHEN ({p}) IS NULL THEN 'PARSER_MISSED' ELSE 'PASS' END AS class FROM product_details" for n, s, p in (("price", "price_eur", _price_sql("price_eur")), ("rating", "rating", f"CASE WHEN {_RATING} BETWEEN 0 AND 5 THEN 1 END"))))
def dq12_field_closure(t):
    price, rating = nu.price(c("price_eur")), nu.rating(c("rating"))
    return ql.closure(t("product_details"), "listing_id", {"price": (c("price_eur"), price, price), "rating": (c("rating"), rating, rating)})


@query("WITH a AS (SELECT asin, min(title) AS title FROM product_details GROUP BY 1), b AS (SELECT asin, min(title_es_raw) AS title FROM saved_cases WHERE asin IS NOT NULL GROUP BY 1) SELECT asin, CASE WHEN b.title IS NULL THEN 'EXPORT_MISSING' ELSE 'EXPORT_VALUE_MISMATCH' END AS code FROM a LEFT JOIN b USING (asin) WHERE a.title IS DISTINCT FROM b.title")
def dq13_export_cells(t):
    a, b = t("product_details").groupBy("asin").agg(F.min("title").alias("title")), t("saved_cases").filter("asin is not null").groupBy("asin").agg(F.min("title_es_raw").alias("shown"))
    return a.join(b, "asin", "left").filter(~c("title").eqNullSafe(c("shown"))).select("asin", F.when(c("shown").isNull(), "EXPORT_MISSING").otherwise("EXPORT_VALUE_MISMATCH").alias("code"))


@query(f"""WITH k AS (SELECT snapshot_id, page, asin, rank, card_asin, {_CARD_URL} AS url_asin FROM {CARD}), g AS (SELECT snapshot_id, page, count(*) FILTER (WHERE rank > 0) AS n, max(rank) FILTER (WHERE rank > 0) - min(rank) FILTER (WHERE rank > 0) + 1 - count(DISTINCT rank) FILTER (WHERE rank > 0) AS gaps FROM k GROUP BY 1, 2)
SELECT snapshot_id, page, 'DUPLICATE_RANK_SLOT' AS code, count(*) AS n FROM (SELECT snapshot_id, page, rank FROM k WHERE rank > 0 GROUP BY 1, 2, 3 HAVING count(DISTINCT asin) > 1) GROUP BY 1, 2
UNION ALL SELECT snapshot_id, page, 'RANK_GAP', CAST(gaps AS BIGINT) FROM g WHERE n >= 3 AND gaps > 0
UNION ALL SELECT snapshot_id, page, 'RANK_MISSING', count(*) FROM k WHERE coalesce(rank, 0) <= 0 GROUP BY 1, 2
UNION ALL SELECT snapshot_id, page, 'INVALID_ASIN', count(*) FROM k WHERE NOT regexp_matches(coalesce(asin, ''), '^[A-Z0-9]{{10}}$') GROUP BY 1, 2
UNION ALL SELECT snapshot_id, page, 'LINK_ASIN_MISMATCH', count(*) FROM k WHERE regexp_matches(coalesce(asin, ''), '^[A-Z0-9]{{10}}$') AND ((nullif(upper(trim(card_asin)), '') <> url_asin) OR url_asin <> asin) GROUP BY 1, 2
UNION ALL SELECT snapshot_id, page, 'LIMITED_IDENTITY_EVIDENCE', count(*) FROM k WHERE regexp_matches(coalesce(asin, ''), '^[A-Z0-9]{{10}}$') AND url_asin IS NULL GROUP BY 1, 2""")
def dq14_rank_integrity(t):
    return ql.rank_integrity(cards(t), ["snapshot_id", "page"], "rank", "asin", c("card_asin"), c("raw_href"))


@query("SELECT placement_id, last_seen_at, CASE WHEN status = 'FAILED_FINAL' THEN 'ACCESS_BLOCKED' WHEN attempt_count > 0 AND status = 'DONE' THEN 'CHALLENGE_RECOVERED' WHEN status IS NULL THEN 'ACCESS_STATE_UNKNOWN' END AS code FROM category_placements WHERE status = 'FAILED_FINAL' OR (attempt_count > 0 AND status = 'DONE') OR status IS NULL")
def dq15_access(t):
    code = F.when(c("status") == "FAILED_FINAL", "ACCESS_BLOCKED").when((c("attempt_count") > 0) & (c("status") == "DONE"), "CHALLENGE_RECOVERED").when(c("status").isNull(), "ACCESS_STATE_UNKNOWN")
    return t("category_placements").select("placement_id", "last_seen_at", code.alias("code")).filter("code is not null")


@query("SELECT snapshot_id, asin, card_index, CASE WHEN len(k) = 0 THEN 'UNCONFIRMED' WHEN len(k) = 1 THEN 'MATCH' ELSE 'MISMATCH' END AS state FROM (SELECT snapshot_id, asin, card_index, list_distinct(list_filter([upper(trim(card_asin)), upper(trim(href_asin))], lambda x: x IS NOT NULL AND x <> '')) AS k FROM identity_candidates)")
def dq16_detail_identity(t):
    k = F.size(ar.family(F.array("card_asin", "href_asin")))
    return t("identity_candidates").select("snapshot_id", "asin", "card_index", F.when(k == 0, "UNCONFIRMED").when(k == 1, "MATCH").otherwise("MISMATCH").alias("state"))


@query("""WITH a AS (SELECT *, lower(trim(coalesce(section, ''))) AS s, trim(coalesce(label_raw, '')) AS l, trim(coalesce(value_raw, '')) AS v FROM product_attributes WHERE asin IS NOT NULL),
o AS (SELECT asin, s, position, lag(position) OVER (PARTITION BY asin, s ORDER BY attr_id, position, captured_at) AS before FROM a WHERE position IS NOT NULL)
SELECT asin, 'DETAIL_LABEL_VALUE_MISSING' AS code, count(*) AS n FROM a WHERE l = '' OR v = '' GROUP BY 1
UNION ALL SELECT asin, 'DETAIL_PROVENANCE_INCOMPLETE', count(*) FROM a WHERE s = '' OR trim(coalesce(source, '')) = '' GROUP BY 1
UNION ALL SELECT asin, 'DETAIL_POSITION_MISSING', count(*) FROM a WHERE position IS NULL GROUP BY 1
UNION ALL SELECT asin, 'DETAIL_POSITION_DUPLICATE', count(*) FROM (SELECT asin, s FROM o GROUP BY 1, 2 HAVING count(*) > count(DISTINCT position)) GROUP BY 1
UNION ALL SELECT asin, 'DETAIL_POSITION_ORDER', count(*) FROM (SELECT DISTINCT asin, s FROM o WHERE before > position) GROUP BY 1
UNION ALL SELECT asin, 'DETAIL_ITEM_DUPLICATED', count(*) FROM (SELECT asin, s, lower(l), v FROM a GROUP BY ALL HAVING count(*) > 1) GROUP BY 1""")
def dq17_detail_structure(t):
    return ql.detail_structure(t("product_attributes").filter("asin is not null"), "asin", [c("attr_id"), c("position"), c("captured_at")])


_FOLDED = f"translate(lower({{0}}), '{tx.ACCENTED}', '{tx.PLAIN}')"


@query(f"""WITH r AS (SELECT upper(trim(asin)) AS asin, arg_min(regexp_extract(source_url, '/gp/[^/]+/([^/?#]+)', 1), (snapshot_id, source_url, card_index)) AS listed FROM identity_candidates WHERE coalesce(trim(asin), '') <> '' GROUP BY 1),
d AS (SELECT DISTINCT listing_id, asin, {_FOLDED.format("trim(regexp_extract(bsr, ' en (.+)$', 1))")} AS detailed FROM product_details)
SELECT listing_id, CASE WHEN coalesce(listed, '') <> '' AND coalesce(detailed, '') <> '' THEN CASE WHEN listed = detailed THEN 'AGREED' ELSE 'CATEGORY_EVIDENCE_CONFLICT' END WHEN coalesce(listed, '') <> '' OR coalesce(detailed, '') <> '' THEN 'ONE_SIDED' ELSE 'NONE' END AS evidence FROM d LEFT JOIN r USING (asin)""")
def dq18_category_conflict(t):
    """The category a record's first list page names against the one its own page names."""
    named = t("identity_candidates").select(F.upper(F.trim("asin")).alias("asin"), F.regexp_extract("source_url", "/gp/[^/]+/([^/?#]+)", 1).alias("listed"), F.struct("snapshot_id", "source_url", "card_index").alias("o"))
    first = named.filter("asin <> ''").groupBy("asin").agg(F.min_by("listed", "o").alias("listed"))
    own = t("product_details").select("listing_id", "asin", tx.fold(F.trim(F.regexp_extract("bsr", " en (.+)$", 1))).alias("detailed")).distinct()
    return own.join(first, "asin", "left").select("listing_id", ql.evidence_agreement(c("listed"), c("detailed")).alias("evidence"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE f <> l) AS mismatches FROM (SELECT l_orderkey, l_linenumber, min(l_quantity) AS f, max(l_quantity) AS l FROM lineitem GROUP BY 1, 2)")
def dq19_replay_mismatch(t):
    return t("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_quantity").alias("f"), F.max("l_quantity").alias("l")).agg(F.count(F.lit(1)).alias("n"), F.count_if(c("f") != c("l")).alias("mismatches"))


_MEANING = {"BEST_SELLERS": "LIST_POSITION"}
_OBS = f"""(SELECT snapshot_id, regexp_replace(regexp_replace(regexp_replace(trim(source_url), '[?#].*$', ''), '/ref=[^/]*', '', 'g'), '/+$', '') AS page_url, rank, nullif(raw_href, '') AS href, page_number * 1000 + card_index AS slot, evidence_source,
CASE WHEN card_asin <> '' AND card_asin = href_asin THEN 'CONFIRMED' WHEN card_asin <> '' AND href_asin <> '' THEN 'CONFLICT' ELSE 'UNCONFIRMED' END AS state,
CASE WHEN card_asin = href_asin OR representation_type = 'SUPPLEMENTAL' THEN nullif(href_asin, '') END AS product FROM identity_candidates)"""
_PAGE_FACTS = f"""(SELECT snapshot_id, page_url, count(*) AS n, count(slot) AS slots, count(DISTINCT slot) AS slots_d, max(rank) AS expected, bool_or(evidence_source = 'ajax') AS proven, list(rank) FILTER (WHERE rank > 0) AS ranks,
count(*) FILTER (WHERE rank <= 0) AS bad, count(*) FILTER (WHERE href IS NULL) AS no_link, count(*) FILTER (WHERE state = 'CONFLICT') AS conflicts, count(*) FILTER (WHERE state = 'CONFLICT' AND product IS NOT NULL) AS assigned,
count(*) FILTER (WHERE state = 'UNCONFIRMED' AND product IS NOT NULL) AS unconfirmed, count(*) FILTER (WHERE state = 'CONFIRMED' AND product IS NULL) AS no_id FROM {_OBS} GROUP BY 1, 2)"""
_PAGE_RULES = [
    ("ACCESS_STATUS_UNVERIFIED", "1", "contains(page_url, 'bebe')"), ("PAGE_TYPE_UNKNOWN", "1", "NOT contains(page_url, '/gp/bestsellers/')"), ("COMPLETENESS_UNVERIFIED", "1", "NOT coalesce(proven, false)"), ("EXPECTED_COUNT_MISMATCH", "abs(expected - n)", "proven AND n <> expected"),
    ("SLOT_POSITION_MISSING", "n - slots", "slots < n"), ("DUPLICATE_PRODUCT_SLOT", "1", "slots > slots_d OR n - slots > 1"), ("INVALID_VISIBLE_RANK", "bad", "bad > 0"), ("PRODUCT_LINK_MISSING", "no_link", "no_link > 0"), ("IDENTITY_CONFLICT", "conflicts", "conflicts > 0"),
    ("CONFLICT_AUTO_ASSIGNED_PRODUCT", "assigned", "assigned > 0"), ("UNCONFIRMED_ASSIGNED_PRODUCT", "unconfirmed", "unconfirmed > 0"), ("CONFIRMED_PRODUCT_ID_MISSING", "no_id", "no_id > 0"), ("DUPLICATE_VISIBLE_RANK", "len(ranks) - len(list_distinct(ranks))", "len(ranks) > len(list_distinct(ranks))"),
    ("RANK_COVERAGE_GAP", "1", "expected >= 1 AND list_sort(list_distinct(coalesce(ranks, []))) <> range(1, expected + 1)"), ("RANK_COVERAGE_UNVERIFIED", "1", "NOT coalesce(expected >= 1, false)"),
]
_PAGE_FOUND = " UNION ALL ".join(f"SELECT snapshot_id, page_url, '{code}' AS code, CAST({n} AS BIGINT) AS n FROM {_PAGE_FACTS} WHERE {when}" for code, n, when in _PAGE_RULES)
_PAGE_STATES = f"""SELECT snapshot_id, page_url, CASE WHEN bool_or(code IN ('PAGE_TYPE_UNKNOWN', 'NO_PRODUCT_CONTENT')) THEN 'FAILED' WHEN bool_or(code NOT IN ('COMPLETENESS_UNVERIFIED', 'RANK_COVERAGE_UNVERIFIED')) THEN 'PARTIAL' WHEN count(code) > 0 THEN 'UNVERIFIED' ELSE 'COMPLETE' END AS status,
coalesce(array_to_string(list_sort(list(DISTINCT code) FILTER (WHERE code NOT IN ('COMPLETENESS_UNVERIFIED', 'RANK_COVERAGE_UNVERIFIED'))), ';'), '') AS reasons FROM (SELECT snapshot_id, page_url FROM {_OBS} GROUP BY 1, 2) LEFT JOIN ({_PAGE_FOUND}) USING (snapshot_id, page_url) GROUP BY 1, 2"""


def _pages_and_rows(t) -> tuple[DataFrame, DataFrame]:
    """The cards as observations on list pages, and the pages they lie on."""
    k = cards(t).withColumnRenamed("page", "page_url")
    card, href = c("card_asin"), c("href_asin")
    state = F.when((card != "") & (card == href), "CONFIRMED").when((card != "") & (href != ""), "CONFLICT").otherwise("UNCONFIRMED")
    product = F.when((card == href) | (c("representation_type") == "SUPPLEMENTAL"), F.nullif(href, F.lit("")))
    rows = k.select("snapshot_id", "page_url", F.lit("BEST_SELLERS").alias("source_type"), F.lit("LIST_POSITION").alias("rank_semantics"), c("page_url").alias("source_id"), (c("page_number") * 1000 + c("card_index")).alias("slot_position"), c("rank").alias("rank_value"),
                    c("raw_href").alias("raw_product_url"), state.alias("identity_status"), product.alias("product_id"), card.alias("asin_from_card"), "observed_at", "evidence_source")
    pages = rows.groupBy("snapshot_id", "page_url").agg(F.max("rank_value").cast("bigint").alias("expected_count"), F.bool_or(c("evidence_source") == "ajax").alias("count_proven"))
    recognized = F.when(F.contains("page_url", F.lit("/gp/bestsellers/")), True)
    access = F.when(F.contains("page_url", F.lit("bebe")), "UNKNOWN").otherwise("NORMAL")
    return pages.select("*", F.lit("BEST_SELLERS").alias("source_type"), F.lit("LIST_POSITION").alias("rank_semantics"), c("page_url").alias("source_id"), access.alias("access_status"), recognized.alias("recognized_page_type"), F.lit(True).alias("contiguous_ranks"),
                        F.lit(1).alias("expected_rank_start"), c("expected_count").alias("expected_rank_end")), rows


@query(_PAGE_FOUND)
def dq20_page_findings(t):
    pages, rows = _pages_and_rows(t)
    return gates.page_findings(pages, rows, ["snapshot_id", "page_url"], _MEANING).select("snapshot_id", "page_url", "code", "n")


@query(_PAGE_STATES)
def dq20_page_gate(t):
    pages, rows = _pages_and_rows(t)
    keys = ["snapshot_id", "page_url"]
    return gates.states(pages, gates.page_findings(pages, rows, keys, _MEANING), keys)


_FACTS = f"(SELECT snapshot_id, count(DISTINCT page) AS pages, count(DISTINCT asin) AS items, count(*) AS n, count(*) FILTER (WHERE rank IS NULL) AS no_rank FROM {CARD} GROUP BY 1)"


_SNAP_FOUND = f"""SELECT snapshot_id, code, CAST(sum(n) AS BIGINT) AS n FROM ({_PAGE_FOUND}) GROUP BY 1, 2
UNION ALL SELECT snapshot_id, 'DUPLICATE_OBSERVATION_ID', count(*) FROM (SELECT snapshot_id, coalesce(asin, '') || '|' || coalesce(source_url, '') AS id FROM identity_candidates GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1
UNION ALL SELECT i.snapshot_id, 'OBSERVATION_TIME_INVALID', count(*) FROM identity_candidates i JOIN ranking_snapshots s USING (snapshot_id) WHERE i.observed_at IS NULL OR CAST(i.observed_at AS DATE) <> CAST(s.observed_at AS DATE) GROUP BY 1
UNION ALL SELECT snapshot_id, 'PLANNED_PAGE_COUNT_MISMATCH', 1 FROM (SELECT s.snapshot_id, count(DISTINCT page_url) AS p FROM ranking_snapshots s LEFT JOIN {_OBS} o USING (snapshot_id) GROUP BY 1) WHERE p <> 16"""


def _snapshot_gate(t) -> DataFrame:
    pages, observed = _pages_and_rows(t)
    named = F.concat(F.coalesce("asin", F.lit("")), F.lit("|"), F.coalesce("source_url", F.lit("")))  # an observation is a card at an address
    raw = t("identity_candidates").select("snapshot_id", clean_page_url(c("source_url")).alias("page_url"), named.alias("observation_id"), "observed_at", c("rank").alias("rank_value"), c("raw_href").alias("raw_product_url"))
    manifests = t("ranking_snapshots").select("snapshot_id", "origin", F.lit(16).alias("planned_pages"), F.to_date("observed_at").alias("local_date"), F.lit(True).alias("access_stop_enforced"))
    found = gates.page_findings(pages, observed, ["snapshot_id", "page_url"], _MEANING)
    return gates.snapshot_findings(manifests, pages, raw, found)


@query(_SNAP_FOUND)
def dq21_snapshot_findings(t):
    return _snapshot_gate(t).select("snapshot_id", "code", "n")


@query(f"SELECT snapshot_id, CASE WHEN bool_or(code = 'PAGE_TYPE_UNKNOWN') THEN 'FAILED' WHEN bool_or(code NOT IN ('COMPLETENESS_UNVERIFIED', 'RANK_COVERAGE_UNVERIFIED')) THEN 'PARTIAL' WHEN count(code) > 0 THEN 'UNVERIFIED' ELSE 'COMPLETE' END AS status, coalesce(array_to_string(list_sort(list(DISTINCT code) FILTER (WHERE code NOT IN ('COMPLETENESS_UNVERIFIED', 'RANK_COVERAGE_UNVERIFIED'))), ';'), '') AS reasons FROM ranking_snapshots LEFT JOIN ({_SNAP_FOUND}) USING (snapshot_id) GROUP BY 1")
def dq21_snapshot_gate(t):
    return gates.states(t("ranking_snapshots"), _snapshot_gate(t), ["snapshot_id"])


_GATES_SQL = {
    "ranking_complete": "max(expected) = min(expected)", "ranking_slots_complete": "sum(n - slots) = 0", "identity_ready": "sum(conflicts) * 5 < sum(n)", "identity_complete": "sum(unconfirmed) = 0", "access_normal": "true", "no_conflicts": "sum(conflicts) = 0",
    "no_rank_gap": "bool_and(coalesce(len(list_distinct(ranks)) = list_max(ranks) - list_min(ranks) + 1, true))", "no_duplicate_rank_slot": "bool_and(coalesce(len(ranks) = len(list_distinct(ranks)), true))",
}


@query(f"SELECT snapshot_id, CASE WHEN len(r) = 0 THEN 'AUTHORITATIVE' ELSE 'BLOCKED' END AS authority_status, array_to_string(r, ';') AS reasons FROM (SELECT snapshot_id, list_filter([{', '.join(f'CASE WHEN NOT coalesce({w}, false) THEN {chr(39)}{k}{chr(39)} END' for k, w in _GATES_SQL.items())}], lambda x: x IS NOT NULL) AS r FROM {_PAGE_FACTS} GROUP BY 1)")
def dq22_authority_gate(t):
    pages, rows = _pages_and_rows(t)
    positive = F.when(c("rank_value") > 0, c("rank_value"))
    per = rows.groupBy("snapshot_id", "page_url").agg(F.max("rank_value").alias("expected"), F.count(F.lit(1)).alias("n"), F.count("slot_position").alias("slots"), F.count_if(c("identity_status") == "CONFLICT").alias("conflicts"),
        F.count_if((c("identity_status") == "UNCONFIRMED") & c("product_id").isNotNull()).alias("unconfirmed"), F.count(positive).alias("ranks"), F.countDistinct(positive).alias("ranks_d"), (F.max(positive) - F.min(positive) + 1).alias("span"))
    facts = per.groupBy("snapshot_id").agg(
        (F.max("expected") == F.min("expected")).alias("ranking_complete"), (F.sum(c("n") - c("slots")) == 0).alias("ranking_slots_complete"), (F.sum("conflicts") * 5 < F.sum("n")).alias("identity_ready"), (F.sum("unconfirmed") == 0).alias("identity_complete"), F.lit(True).alias("access_normal"),
        (F.sum("conflicts") == 0).alias("no_conflicts"), F.every(F.coalesce(c("ranks_d") == c("span"), F.lit(True))).alias("no_rank_gap"), F.every(c("ranks") == c("ranks_d")).alias("no_duplicate_rank_slot"),
    )
    return gates.authority(facts, "snapshot_id")


_LATEST_PLACEMENT = "(SELECT DISTINCT c.placement_id, c.marketplace, c.category_id, nullif(c.parent_placement_id, '') AS parent, c.parent_category_id, c.depth FROM category_placements c JOIN (SELECT placement_id, max(last_seen_at) AS seen FROM category_placements GROUP BY 1) r ON r.placement_id = c.placement_id AND r.seen = c.last_seen_at)"


@query(f"""WITH RECURSIVE x AS {_LATEST_PLACEMENT}, p AS (SELECT placement_id, [category_id] AS path FROM x WHERE parent IS NULL OR parent NOT IN (SELECT placement_id FROM x) UNION ALL SELECT x.placement_id, list_append(p.path, x.category_id) FROM x JOIN p ON x.parent = p.placement_id),
y AS (SELECT x.*, coalesce(p.path, []) AS path FROM x LEFT JOIN p USING (placement_id))
SELECT a.placement_id, unnest(list_filter([CASE WHEN coalesce(a.category_id, '') = '' OR coalesce(a.marketplace, '') = '' THEN 'MALFORMED' END, CASE WHEN a.depth IS DISTINCT FROM len(a.path) - 1 THEN 'DEPTH_PATH_MISMATCH' END, CASE WHEN a.path[-1] IS DISTINCT FROM a.category_id THEN 'PATH_END_MISMATCH' END,
CASE WHEN len(a.path) > len(list_distinct(a.path)) THEN 'PATH_CYCLE' END, CASE WHEN a.parent IS NULL AND a.depth IS DISTINCT FROM 0 THEN 'ROOT_DEPTH' END, CASE WHEN a.parent IS NOT NULL AND b.placement_id IS NULL THEN 'PARENT_MISSING' END, CASE WHEN b.placement_id IS NOT NULL AND a.marketplace IS DISTINCT FROM b.marketplace THEN 'OTHER_MARKET' END,
CASE WHEN b.placement_id IS NOT NULL AND a.parent_category_id IS DISTINCT FROM b.category_id THEN 'PARENT_CATEGORY_MISMATCH' END, CASE WHEN b.placement_id IS NOT NULL AND a.path[:-2] IS DISTINCT FROM b.path THEN 'PATH_NOT_BELOW_PARENT' END, CASE WHEN b.placement_id IS NOT NULL AND a.depth IS DISTINCT FROM b.depth + 1 THEN 'DEPTH_NOT_BELOW_PARENT' END], lambda e: e IS NOT NULL)) AS error
FROM y a LEFT JOIN y b ON b.placement_id = a.parent UNION ALL SELECT NULL, 'ROOT_COUNT' FROM (SELECT count(*) AS n FROM x WHERE parent IS NULL) WHERE n <> 1""")
def dq23_tree_errors(t):
    from rastro.operators.hierarchy import latest_rows, resolve_hierarchy

    latest = latest_rows(t("category_placements").select("placement_id", "parent_placement_id", "depth", "marketplace", "category_id", "parent_category_id", "last_seen_at"), "placement_id", "last_seen_at")
    own = latest.select(c("placement_id").alias("member"), "category_id")
    steps = resolve_hierarchy(latest).select("node", F.posexplode("path").alias("at", "member")).join(own, "member")
    paths = steps.groupBy(c("node").alias("placement_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "category_id"))), lambda x: x["category_id"]).alias("category_path"))
    return gates.tree_errors(latest.join(paths, "placement_id", "left"))


@query(f"WITH f AS (SELECT s.snapshot_id, s.origin, s.observed_at, x.pages, lag(x.pages) OVER w AS before, lag(s.origin) OVER w AS origin_before, lag(s.observed_at) OVER w AS at_before FROM ranking_snapshots s JOIN {_FACTS} x USING (snapshot_id) WINDOW w AS (ORDER BY s.observed_at)) SELECT snapshot_id, array_to_string(list_filter([CASE WHEN NOT coalesce(pages = before, false) THEN 'SAME_COVERAGE' END, CASE WHEN NOT coalesce(origin = origin_before, false) THEN 'SAME_ORIGIN' END, CASE WHEN NOT coalesce(CAST(observed_at AS DATE) - CAST(at_before AS DATE) <= 8, false) THEN 'NO_DATE_GAP' END], lambda e: e IS NOT NULL), ';') AS reasons FROM f")
def dq24_comparability(t):
    from pyspark.sql import Window

    pages = cards(t).groupBy("snapshot_id").agg(F.countDistinct("page").alias("pages"))
    w = Window.orderBy("observed_at")  # of the fixed list of snapshots
    f = t("ranking_snapshots").join(pages, "snapshot_id").withColumns({"before": F.lag("pages").over(w), "origin_before": F.lag("origin").over(w), "at_before": F.lag("observed_at").over(w)})
    return ql.gate(f, {"SAME_COVERAGE": c("pages") == c("before"), "SAME_ORIGIN": c("origin") == c("origin_before"), "NO_DATE_GAP": F.datediff("observed_at", "at_before") <= 8}).select("snapshot_id", "reasons")


@query("SELECT snapshot_id, asin, card_index, CASE WHEN card_asin <> '' AND href_asin = card_asin THEN 'STRONG' WHEN card_asin <> '' OR href_asin <> '' THEN 'WEAK' ELSE 'NONE' END AS grade FROM identity_candidates")
def dq25_evidence_grade(t):
    return t("identity_candidates").select("snapshot_id", "asin", "card_index", F.when((c("card_asin") != "") & (c("href_asin") == c("card_asin")), "STRONG").when((c("card_asin") != "") | (c("href_asin") != ""), "WEAK").otherwise("NONE").alias("grade"))


@query("SELECT count(*) = count(DISTINCT container_kind) AS unique_kinds, min(capacity_tokens) > 0 AS positive, count(*) AS n FROM container_sizes")
def dq26_configuration(t):
    return t("container_sizes").agg((F.count(F.lit(1)) == F.countDistinct("container_kind")).alias("unique_kinds"), (F.min("capacity_tokens") > 0).alias("positive"), F.count(F.lit(1)).alias("n"))


@query("SELECT snapshot_id, count(*) AS n, count(*) FILTER (WHERE nullif(regexp_extract(raw_href, '/dp/([A-Z0-9]{10})', 1), '') = upper(trim(asin))) AS agree FROM identity_candidates GROUP BY 1")
def dq27_candidate_audit(t):
    own = F.nullif(F.regexp_extract("raw_href", "/dp/([A-Z0-9]{10})", 1), F.lit("")) == F.upper(F.trim("asin"))
    return t("identity_candidates").groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(own).alias("agree"))


@query("SELECT snapshot_id, CASE WHEN origin = 'LIVE_CAPTURE' THEN 'ACCEPTED' WHEN origin = 'HISTORICAL_REPLAY' THEN 'NEEDS_REVIEW' ELSE 'FIXTURE_ONLY' END AS review FROM ranking_snapshots")
def dq28_review_status(t):
    return t("ranking_snapshots").select("snapshot_id", F.when(c("origin") == "LIVE_CAPTURE", "ACCEPTED").when(c("origin") == "HISTORICAL_REPLAY", "NEEDS_REVIEW").otherwise("FIXTURE_ONLY").alias("review"))


@query("SELECT p.listing_id, CASE WHEN nullif(trim(p.title), '') IS NULL THEN 'SOURCE_MISSING' WHEN s.t IS NULL THEN 'PENDING' WHEN s.t <> p.title THEN 'SOURCE_CHANGED' ELSE 'PROMOTED' END AS state FROM product_details p LEFT JOIN (SELECT asin, max(title_from_saved_html) AS t FROM capacity_totals GROUP BY 1) s USING (asin)")
def dq29_promotion(t):
    s = t("capacity_totals").groupBy("asin").agg(F.max("title_from_saved_html").alias("t"))
    return t("product_details").join(s, "asin", "left").select("listing_id", F.when(tx.present(c("title")).isNull(), "SOURCE_MISSING").when(c("t").isNull(), "PENDING").when(c("t") != c("title"), "SOURCE_CHANGED").otherwise("PROMOTED").alias("state"))


@query("SELECT count(*) AS keys, count(*) FILTER (WHERE a.n IS DISTINCT FROM b.n) AS unequal FROM (SELECT user_id, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1) a FULL JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_id % 2 = 1 GROUP BY 1) b USING (user_id)")
def dq30_replay_equality(t):
    half = lambda r, n: t("events").filter(c("event_id") % 2 == r).groupBy("user_id").agg(F.count(F.lit(1)).alias(n))
    return half(0, "a").join(half(1, "b"), "user_id", "full").agg(F.count(F.lit(1)).alias("keys"), F.count_if(~c("a").eqNullSafe(c("b"))).alias("unequal"))


@query("SELECT asin, CASE WHEN bool_and(nullif(trim(value_raw), '') IS NOT NULL) THEN 'success' WHEN bool_or(nullif(trim(value_raw), '') IS NOT NULL) THEN 'partial' ELSE 'missing' END AS state FROM product_attributes GROUP BY 1")
def dq31_record_status(t):
    stated = tx.present(c("value_raw")).isNotNull()
    return t("product_attributes").groupBy("asin").agg(F.when(F.every(stated), "success").when(F.bool_or(stated), "partial").otherwise("missing").alias("state"))


@query("SELECT context_id, CAST(coalesce(len(list_filter(feature_bullets_raw, lambda x: trim(x) = '')), 0) AS INT) AS n_empty, CAST(coalesce(len(feature_bullets_raw) - len(list_distinct(list_filter(feature_bullets_raw, lambda x: x IS NOT NULL))) - len(list_filter(feature_bullets_raw, lambda x: x IS NULL)), 0) AS INT) AS n_repeated, CAST(coalesce(len(list_filter(feature_bullets_raw, lambda x: length(x) > 100)), 0) AS INT) AS n_long FROM capacity_context")
def tx21_bullets(t):
    b = c("feature_bullets_raw")
    stated = F.filter(b, lambda x: x.isNotNull())
    return t("capacity_context").select("context_id", F.coalesce(F.size(F.filter(b, lambda x: F.trim(x) == "")), F.lit(0)).alias("n_empty"), F.coalesce(F.size(stated) - F.size(F.array_distinct(stated)), F.lit(0)).alias("n_repeated"), F.coalesce(F.size(F.filter(b, lambda x: F.length(x) > 100)), F.lit(0)).alias("n_long"))


@query("SELECT asin, string_agg(label_raw || ': ' || value_raw, chr(10) ORDER BY label_raw, value_raw) AS lines FROM (SELECT DISTINCT asin, label_raw, value_raw FROM product_attributes WHERE value_raw <> '' AND label_raw IS NOT NULL AND section = 'product_overview' AND asin IS NOT NULL) GROUP BY 1")
def tx22_render_attributes(t):
    a = t("product_attributes").filter("value_raw <> '' and label_raw is not null and section = 'product_overview' and asin is not null").select("asin", "label_raw", "value_raw").distinct()
    sorted_ = F.array_sort(F.collect_list(F.struct("label_raw", "value_raw")))
    return a.groupBy("asin").agg(F.array_join(F.transform(sorted_, lambda x: F.concat(x["label_raw"], F.lit(": "), x["value_raw"])), "\n").alias("lines"))


@query("SELECT context_id, array_to_string(list_transform(list_filter(feature_bullets_raw, lambda x: trim(x) <> ''), lambda x: '- ' || trim(x)), chr(10)) AS lines FROM capacity_context")
def tx23_render_bullets(t):
    return t("capacity_context").select("context_id", F.array_join(F.transform(F.filter("feature_bullets_raw", lambda x: F.trim(x) != ""), lambda x: F.concat(F.lit("- "), F.trim(x))), "\n").alias("lines"))


@query("SELECT asin, count(DISTINCT label_raw) AS truncated FROM product_attributes WHERE contains(value_raw, 'Ver más') GROUP BY 1")
def tx24_truncated_labels(t):
    return t("product_attributes").filter(F.contains(c("value_raw"), F.lit("Ver más"))).groupBy("asin").agg(F.countDistinct("label_raw").alias("truncated"))


@query("SELECT attr_id, CASE WHEN lower(trim(value_raw)) IN ('n/d', '-', '—', '') THEN NULL ELSE regexp_replace(value_raw, '([0-9]+) (piezas|uds\\.)', '\\1 pcs', 'g') END AS shown FROM product_attributes")
def tx25_display_clean(t):
    return t("product_attributes").select("attr_id", F.when(~F.lower(F.trim("value_raw")).isin("n/d", "-", "—", ""), F.regexp_replace("value_raw", r"([0-9]+) (piezas|uds\.)", "$1 pcs")).alias("shown"))


@query("SELECT case_id, list_sort(regexp_extract_all(title_es_raw, '[0-9]+')) = list_sort(regexp_extract_all(coalesce(specification_es, ''), '[0-9]+')) AS same_numbers FROM saved_cases WHERE title_es_raw IS NOT NULL")
def tx27_number_bags(t):
    numbers = lambda x: F.array_sort(F.regexp_extract_all(x, F.lit("([0-9]+)"), 1))
    return t("saved_cases").filter("title_es_raw is not null").select("case_id", (numbers(c("title_es_raw")) == numbers(F.coalesce("specification_es", F.lit("")))).alias("same_numbers"))


@query("SELECT case_id, regexp_replace(regexp_replace(specification_es, '([0-9]) (mm|cm|ml|kg)', '\\1\\2', 'g'), ' / ', '; ', 'g') AS shown FROM saved_cases")
def tx28_post_process(t):
    return t("saved_cases").select("case_id", F.regexp_replace(F.regexp_replace("specification_es", r"([0-9]) (mm|cm|ml|kg)", "$1$2"), " / ", "; ").alias("shown"))


@query("SELECT listing_id, regexp_matches(title, '[а-яА-Я]') AS cyrillic, regexp_matches(title, '[一-龥]') AS han FROM product_details")
def tx29_residual_script(t):
    return t("product_details").select("listing_id", c("title").rlike("[а-яА-Я]").alias("cyrillic"), c("title").rlike("[一-龥]").alias("han"))


@query("SELECT attr_id, lower(trim(label_raw, ' ')) IN ('asin', 'marca', 'número de modelo', 'part number') OR contains(lower(label_raw), 'referencia') AS identity FROM product_attributes")
def tx30_identity_label(t):
    return t("product_attributes").select("attr_id", (F.lower(F.trim("label_raw")).isin("asin", "marca", "número de modelo", "part number") | F.contains(F.lower("label_raw"), F.lit("referencia"))).alias("identity"))


@query(f"SELECT attr_id, CASE WHEN lower(value_raw) IN ('sí', 'si', 'no', 'true', 'false', 'yes') THEN 'boolean' WHEN ({sp.unit_class_sql('value_raw')}) IS NOT NULL THEN 'unit' WHEN regexp_matches(value_raw, '^[0-9.,]+$') THEN 'number' ELSE 'unknown' END AS v FROM product_attributes")
def tx32_value_class(t):
    v = F.when(F.lower("value_raw").isin("sí", "si", "no", "true", "false", "yes"), "boolean").when(sp.unit_class(c("value_raw")).isNotNull(), "unit").when(c("value_raw").rlike("^[0-9.,]+$"), "number").otherwise("unknown")
    return t("product_attributes").select("attr_id", v.alias("v"))


@query("SELECT case_id, array_to_string(list_filter([nullif(trim(field), ''), CASE WHEN length(specification_es) > 80 THEN NULL ELSE specification_es END], lambda x: x IS NOT NULL), ' / ') AS spec FROM saved_cases")
def sp6_compact_spec(t):
    return t("saved_cases").select("case_id", F.array_join(F.array_compact(F.array(tx.present(c("field")), F.when(~(F.length("specification_es") > 80) | c("specification_es").isNull(), c("specification_es")))), " / ").alias("spec"))


@query("SELECT case_id, CASE WHEN regexp_matches(specification_es, '(?i)[0-9]\\s*(l|ml|cl|litros?)\\b') THEN 'capacity' WHEN regexp_matches(specification_es, '(?i)[0-9]\\s*(g|kg|gramos|kilos?)\\b') THEN 'weight' WHEN regexp_matches(specification_es, '(?i)[0-9]\\s*(mm|cm|m)\\b') THEN 'dimension' END AS core FROM saved_cases")
def sp7_core_spec(t):
    return t("saved_cases").select("case_id", F.when(c("specification_es").rlike(r"(?i)[0-9]\s*(l|ml|cl|litros?)\b"), "capacity").when(c("specification_es").rlike(r"(?i)[0-9]\s*(g|kg|gramos|kilos?)\b"), "weight").when(c("specification_es").rlike(r"(?i)[0-9]\s*(mm|cm|m)\b"), "dimension").alias("core"))


@query("SELECT asin, count(DISTINCT CASE WHEN contains(value_raw, 'kg') THEN round(TRY_CAST(replace(regexp_extract(value_raw, '^([0-9]+,[0-9]+)\\s*kg$', 1), ',', '.') AS DOUBLE) * 1000) ELSE TRY_CAST(regexp_extract(value_raw, '^([0-9]+)\\s*g$', 1) AS DOUBLE) END) <= 1 AS equal FROM product_attributes WHERE regexp_matches(value_raw, '^[0-9]+,[0-9]+\\s*kg$') OR regexp_matches(value_raw, '^[0-9]+\\s*g$') GROUP BY 1")
def sp11_equivalent_facts(t):
    a = t("product_attributes").filter(c("value_raw").rlike(r"^[0-9]+,[0-9]+\s*kg$") | c("value_raw").rlike(r"^[0-9]+\s*g$"))
    grams = F.when(F.contains(c("value_raw"), F.lit("kg")), F.round(F.replace(F.regexp_extract("value_raw", r"^([0-9]+,[0-9]+)\s*kg$", 1), F.lit(","), F.lit(".")).try_cast("double") * 1000)).otherwise(F.regexp_extract("value_raw", r"^([0-9]+)\s*g$", 1).try_cast("double"))
    return a.groupBy("asin").agg((F.countDistinct(grams) <= 1).alias("equal"))


def queries() -> dict:
    return QUERIES


def oracles() -> dict[str, str]:
    return ORACLES
