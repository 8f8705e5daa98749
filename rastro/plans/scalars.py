"""Queries of the Column functions (text, numbers, dates, addresses, ids, arrays, specifications), one per survey id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.functions import arrays as ar
from rastro.functions import dates as dt
from rastro.functions import ids
from rastro.functions import numbers as nu
from rastro.functions import specs as sp
from rastro.functions import text as tx
from rastro.functions import urls as ur
from rastro.session import read

c = F.col
BLANK = r"[\s\x{85}\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+"
FOLDED = "translate(lower({0}), '" + tx.ACCENTED + "ºª', '" + tx.PLAIN + "oa')"
INVISIBLE = r"[\x{AD}\x{34F}\x{61C}\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{2064}\x{2066}-\x{2069}\x{FE00}-\x{FE0F}\x{FEFF}]"


def _fold_sql(x: str) -> str:
    return f"regexp_replace({FOLDED.format(x)}, '[\\x{{300}}-\\x{{36F}}]', '', 'g')"


def _price_sql(x: str) -> str:
    bare = f"regexp_replace(regexp_replace(upper(trim({x})), '[€\\s]|EUR', '', 'g'), '([0-9]),([0-9])', '\\1.\\2', 'g')"
    return f"CASE WHEN regexp_matches({bare}, '^[+-]?[0-9]+(\\.[0-9]+)?$') AND TRY_CAST({bare} AS DOUBLE) > 0 THEN TRY_CAST({bare} AS DOUBLE) END"


def _path_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '[?#].*$', ''), '^[a-z]+://[^/]*', '')"


def _kept_sql(x: str) -> str:
    listed = ", ".join(f"'{t}'" for t in ur.TRACKING)
    return f"nullif(array_to_string(list_filter(string_split(nullif(regexp_extract({x}, '\\?([^#]*)', 1), ''), '&'), lambda t: split_part(t, '=', 1) NOT IN ({listed})), '&'), '')"


_FULL = f"CASE WHEN starts_with(trim(raw_href), '/') THEN 'https://{ur.HOST}' || trim(raw_href) ELSE nullif(trim(raw_href), '') END"
_SAFE = f"(regexp_extract(f, '^https?://([^/?#]*)', 1) IN ('{ur.HOST}', '{ur.HOST.removeprefix('www.')}'))"
_PROD = r"/(?:dp|gp/product|gp/aw/d)/"
_ITEM = r"/(?:dp|gp/product|gp/aw/d)/([A-Za-z0-9]{10})(?:[/?#]|$)"
_REASON = (
    f"CASE WHEN f IS NULL THEN 'PRODUCT_LINK_MISSING' WHEN regexp_matches(f, '[\\x00-\\x20\\x7f\\\\]') THEN 'UNSAFE_URL_SYNTAX' WHEN NOT {_SAFE} THEN 'FOREIGN_HOST' "
    f"WHEN NOT regexp_matches({_path_sql('f')}, '{_PROD}') THEN 'NOT_PRODUCT_CARD_LINK' END"
)



def madrid_sql(t: str) -> str:
    """Local time in Madrid of a UTC time: one hour ahead, two from the last Sunday of March to that of October, 01:00 UTC."""
    sunday = lambda month: f"(make_date(CAST(year({t}) AS BIGINT), {month}, 31) - CAST(dayofweek(make_date(CAST(year({t}) AS BIGINT), {month}, 31)) AS INT) + INTERVAL 1 HOUR)"
    return f"({t} + CASE WHEN {t} >= {sunday(3)} AND {t} < {sunday(10)} THEN INTERVAL 2 HOUR ELSE INTERVAL 1 HOUR END)"


D, A, I, S, X, E, L, O = "product_details", "product_attributes", "identity_candidates", "saved_cases", "documents", "events", "lineitem", "orders"  # noqa: E741
# name, table, key columns, result columns, their SQL
SCALARS: list[tuple[str, str, list[str], dict[str, Callable[[], Column]], dict[str, str]]] = [
    ("tx1_decimal_point", D, ["listing_id"], {"v": lambda: tx.decimal_point(c("price_eur"))}, {"v": r"regexp_replace(price_eur, '([0-9]),([0-9])', '\1.\2', 'g')"}),
    ("tx2_strip_noise", A, ["attr_id"], {"v": lambda: tx.strip_noise(c("label_raw"))}, {"v": f"regexp_replace(label_raw, '{tx.NOISE}', '', 'g')"}),
    ("tx3_collapse_blanks", X, ["doc_id"], {"v": lambda: F.md5(tx.collapse(c("text")))}, {"v": f"md5(trim(regexp_replace(text, '{BLANK}', ' ', 'g')))"}),
    ("tx4_text_or_empty", D, ["listing_id"], {"v": lambda: tx.text_or_empty(c("seller"))}, {"v": "coalesce(trim(seller), '')"}),
    ("tx5_clean_brand", D, ["listing_id"], {"v": lambda: tx.clean_brand(c("brand"))}, {"v": f"coalesce(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(brand), '(?i)^visita\\s+la\\s+tienda\\s+de\\s+', ''), '(?i)^marca:\\s*', ''), '{tx.NOISE}', '', 'g'), '{BLANK}', ' ', 'g')), '')"}),
    ("tx6_brand_spelling", D, ["listing_id"], {"v": lambda: tx.brand_spelling(c("brand"))}, {"v": "CASE WHEN lower(trim(brand)) = 'bissell' THEN 'BISSELL' ELSE coalesce(trim(brand), '') END"}),
    ("tx7_doubtful_brand", D, ["listing_id"], {"v": lambda: tx.doubtful_brand(c("brand"))}, {"v": f"coalesce(regexp_matches(trim(brand), '(?i)\\b({'|'.join(tx.BRAND_STOP_WORDS)})\\b') OR len(string_split(trim(regexp_replace(brand, '{BLANK}', ' ', 'g')), ' ')) > 4, false)"}),
    ("tx8_lookup_key", A, ["attr_id"], {"v": lambda: tx.lookup_key(c("label_raw"))}, {"v": f"trim(regexp_replace({_fold_sql(f'''trim(regexp_replace(regexp_replace(label_raw, '{INVISIBLE}', '', 'g'), '{BLANK}', ' ', 'g'))''')}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"}),
    ("tx9_fold_accents", D, ["listing_id"], {"v": lambda: tx.fold(c("title"))}, {"v": _fold_sql("title")}),
    ("tx10_label_name", A, ["attr_id"], {"v": lambda: tx.label_name(c("label_raw"))}, {"v": f"regexp_replace(trim(regexp_replace(regexp_replace({_fold_sql(f'''regexp_replace(label_raw, '{INVISIBLE}', '', 'g')''')}, '[()]', ' ', 'g'), '[\\s\\x{{A0}}:/-]+', ' ', 'g')), ' ', '_', 'g')"}),
    ("tx11_clean_actions", X, ["doc_id"], {"n_tags": lambda: F.regexp_count(c("text"), F.lit(r"<[a-z/][^>]*>")), "n_invisible": lambda: F.regexp_count(c("text"), F.lit(tx.NOISE)), "v": lambda: F.md5(tx.collapse(F.regexp_replace(tx.strip_noise(c("text")), r"<[a-z/][^>]*>", " ")))}, {"n_tags": "CAST(len(regexp_extract_all(text, '<[a-z/][^>]*>')) AS INT)", "n_invisible": f"CAST(len(regexp_extract_all(text, '{tx.NOISE}')) AS INT)", "v": f"md5(trim(regexp_replace(regexp_replace(regexp_replace(text, '{tx.NOISE}', '', 'g'), '<[a-z/][^>]*>', ' ', 'g'), '{BLANK}', ' ', 'g')))"}),
    ("tx12_halves_once", D, ["listing_id"], {"v": lambda: tx.halves_once(F.concat("seller", "seller")), "w": lambda: tx.halves_once(c("title"))}, {"v": "seller", "w": "CASE WHEN length(title) % 2 = 0 AND length(title) > 0 AND substr(title, 1, length(title) // 2) = substr(title, length(title) // 2 + 1) THEN substr(title, 1, length(title) // 2) ELSE title END"}),
    ("tx13_expand_collapsed", D, ["listing_id"], {"v": lambda: tx.expand_collapsed(F.concat(c("seller"), F.lit(" "), F.substring("seller", 1, 6), F.lit(" Ver más")))["text"], "t": lambda: tx.expand_collapsed(c("title"))["truncated"]}, {"v": "CASE WHEN length(seller) < 6 OR substr(seller, 6, 1) <> ' ' THEN rtrim(seller) ELSE rtrim(seller) END", "t": "CASE WHEN title IS NULL THEN false ELSE false END"}),
    ("tx14_placeholder", A, ["attr_id"], {"v": lambda: tx.placeholder(c("value_raw"))}, {"v": "coalesce(rtrim(lower(trim(value_raw)), '.') IN ('', '-', '—', 'n/d', 'n/a', 'no aplicable', 'desconocido', 'consultar', 'ver descripción', 'null', 'none', '{}', '[]'), true)"}),
    ("tx15_replace_terms", D, ["listing_id"], {"v": lambda: tx.replace_terms(c("title"), {"azul marino": "navy", "azul": "blue", "rojo": "red"})}, {"v": r"regexp_replace(regexp_replace(regexp_replace(title, '(?i)(^|[^A-Za-z0-9])azul marino($|[^A-Za-z0-9])', '\1navy\2', 'g'), '(?i)(^|[^A-Za-z0-9])azul($|[^A-Za-z0-9])', '\1blue\2', 'g'), '(?i)(^|[^A-Za-z0-9])rojo($|[^A-Za-z0-9])', '\1red\2', 'g')"}),
    ("tx16_unit_once", S, ["case_id"], {"v": lambda: tx.unit_once(F.regexp_replace(c("specification_es"), " (kg|ml|cm|mm)", " $1 $1"))}, {"v": r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(specification_es, ' (kg|ml|cm|mm)', ' \1 \1', 'g'), 'mAh mAh\b', 'mAh', 'g'), 'kg kg\b', 'kg', 'g'), 'ml ml\b', 'ml', 'g'), 'cm cm\b', 'cm', 'g'), 'mm mm\b', 'mm', 'g')"}),
    ("tx17_value_terms", A, ["attr_id"], {"v": lambda: F.coalesce(sp.dimension_short(c("value_raw")), tx.replace_terms(c("value_raw"), {"algodón": "cotton", "vidrio": "glass"}))}, {"v": r"coalesce(" + sp.dimension_sql("value_raw") + r", regexp_replace(regexp_replace(value_raw, '(?i)(^|[^A-Za-z0-9])algodón($|[^A-Za-z0-9])', '\1cotton\2', 'g'), '(?i)(^|[^A-Za-z0-9])vidrio($|[^A-Za-z0-9])', '\1glass\2', 'g'))"}),
    ("tx18_protect_codes", D, ["listing_id"], {"n": lambda: F.size(tx.protect_codes(c("title"))["codes"]), "same": lambda: tx.restore_codes(tx.protect_codes(c("title"))["text"], tx.protect_codes(c("title"))["codes"]) == c("title")}, {"n": "CAST(len(list_distinct(regexp_extract_all(title, '([A-Z]{2}[ -]?[0-9]{4,}[ -]?[A-Z]?)', 1))) AS INT)", "same": "title = title"}),
    ("tx19_language", X, ["doc_id"], {"v": lambda: tx.language_name(c("text"))}, {"v": "CASE WHEN text IS NULL OR s[1].n = 0 THEN 'Unknown' WHEN s[2].n <= -2 AND s[2].n * 2 <= s[1].n THEN 'Mixed' ELSE s[1].name END"}),
    ("tx20_detail_rows", S, ["case_id"], {"n": lambda: F.size(tx.detail_rows(c("specification_es"))), "labelled": lambda: F.size(F.filter(tx.detail_rows(c("specification_es")), lambda r: r["value"].isNotNull()))}, {"n": r"CAST(len(r) AS INT)", "labelled": "CAST(len(list_filter(r, lambda x: contains(x, ':'))) AS INT)"}),
    ("tx26_product_kind", D, ["listing_id"], {"v": lambda: tx.product_kind(c("title"))}, {"v": "CASE " + " ".join(f"WHEN contains({_fold_sql('title')}, '{w}') THEN '{k}'" for w, k in tx.KINDS) + " END"}),
    ("tx31_protected_token", A, ["attr_id"], {"v": lambda: c("value_raw").rlike(r"^[A-Z0-9 .-]+$") | c("value_raw").rlike("[0-9]{4,}")}, {"v": "regexp_matches(value_raw, '^[A-Z0-9 .-]+$') OR regexp_matches(value_raw, '[0-9]{4,}')"}),
    ("tx33_title_residue", D, ["listing_id"], {"v": lambda: F.array_join(F.array_sort(F.array_except(F.filter(F.split("title", " "), lambda w: w.rlike("^[A-Z]{4,}$")), F.array(F.lit("NUEVO"), F.lit("OFERTA")))), " ")}, {"v": "array_to_string(list_sort(list_filter(list_distinct(string_split(title, ' ')), lambda x: regexp_matches(x, '^[A-Z]{4,}$') AND x NOT IN ('NUEVO', 'OFERTA'))), ' ')"}),
    ("nu1_price", D, ["listing_id"], {"v": lambda: nu.price(c("price_eur"))}, {"v": _price_sql("price_eur")}),
    ("nu2_discount", D, ["listing_id"], {"v": lambda: nu.discount(nu.price(c("price_eur")), nu.price(c("listprice_eur")))}, {"v": f"CASE WHEN {_price_sql('listprice_eur')} > {_price_sql('price_eur')} THEN round(({_price_sql('listprice_eur')} - {_price_sql('price_eur')}) / {_price_sql('listprice_eur')}, 4) END"}),
    ("nu3_locale_number", I, ["snapshot_id", "asin", "rank_raw"], {"v": lambda: nu.locale_number(c("rank_raw"))}, {"v": r"TRY_CAST(CASE WHEN regexp_matches(n, '\.[0-9]{3}$') OR regexp_matches(n, '\..*\.') THEN replace(n, '.', '') ELSE nullif(n, '') END AS DOUBLE)"}),
    ("nu4_monthly_bought", E, ["event_id"], {"v": lambda: nu.monthly_bought(F.concat(F.regexp_extract("props", r"(\d+)", 1), F.when(c("event_id") % 3 == 0, ",5 mil+").when(c("event_id") % 3 == 1, "+").otherwise("")))}, {"v": r"CASE event_id % 3 WHEN 0 THEN CAST(floor((CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) + 0.5) * 1000) AS BIGINT) WHEN 1 THEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) END"}),
    ("nu5_spanish_count", D, ["listing_id"], {"v": lambda: nu.spanish_count(F.concat(F.lit("("), c("reviews"), F.lit(")")))}, {"v": r"TRY_CAST(nullif(regexp_replace(regexp_extract('(' || reviews || ')', '^\(?\s*([0-9.,]+)', 1), '[.,]', '', 'g'), '') AS BIGINT)"}),
    ("nu6_rating", D, ["listing_id"], {"v": lambda: nu.rating(c("rating")).cast("double")}, {"v": r"CASE WHEN TRY_CAST(nullif(replace(regexp_extract(rating, '^\s*([0-9]+(?:[.,][0-9]+)?)', 1), ',', '.'), '') AS DOUBLE) BETWEEN 0 AND 5 THEN TRY_CAST(nullif(replace(regexp_extract(rating, '^\s*([0-9]+(?:[.,][0-9]+)?)', 1), ',', '.'), '') AS DOUBLE) END"}),
    ("nu7_grouped_count", D, ["listing_id"], {"v": lambda: nu.grouped_count(c("reviews"))}, {"v": "CASE WHEN regexp_matches(reviews, '^[0-9]{1,3}([. ][0-9]{3})+$') OR regexp_matches(reviews, '^[0-9]+$') THEN TRY_CAST(regexp_replace(reviews, '[. ]', '', 'g') AS BIGINT) END"}),
    ("nu8_positive_rank", D, ["listing_id"], {"v": lambda: nu.positive_rank(c("rank"))}, {"v": "CASE WHEN regexp_matches(trim(rank), '^[0-9]+$') AND TRY_CAST(trim(rank) AS BIGINT) > 0 THEN TRY_CAST(trim(rank) AS BIGINT) END"}),
    ("nu9_litres", L, ["l_orderkey", "l_linenumber"], {"v": lambda: nu.litres(c("l_quantity"), F.when(c("l_linestatus") == "O", "ml").otherwise("cl"))}, {"v": "l_quantity * CASE WHEN l_linestatus = 'O' THEN 0.001 ELSE 0.01 END"}),
    ("nu10_money_up", L, ["l_orderkey", "l_linenumber"], {"v": lambda: nu.money_up(c("l_extendedprice") / 7)}, {"v": "ceil(round(l_extendedprice / 7 * 1e6, 3)) / 1e6"}),
    ("nu11_export_number", D, ["listing_id"], {"v": lambda: nu.export_number(c("price_eur"))}, {"v": "TRY_CAST(replace(trim(price_eur), ',', '.') AS DOUBLE)"}),
    ("nu12_share_of", L, ["l_orderkey", "l_linenumber"], {"v": lambda: nu.share_of(c("l_quantity"), 0.25)}, {"v": "CAST(greatest(1, ceil(l_quantity * 0.25)) AS BIGINT)"}),
    ("nu13_reserve_seconds", L, ["l_orderkey", "l_linenumber"], {"v": lambda: nu.reserve_seconds(c("l_discount"), c("l_quantity"))}, {"v": "greatest(120.0, l_discount * l_quantity * 1.5 + 60.0)"}),
    ("dt1_spanish_date", A, ["attr_id"], {"v": lambda: dt.spanish_date(c("value_raw"))}, {"v": r"TRY_CAST(CASE WHEN list_position([" + ", ".join(f"'{m}'" for m in dt.MONTHS) + r"], lower(regexp_extract(value_raw, '^\s*([0-9]{1,2})\s+([A-Za-zñáéíóú]+)\s+([0-9]{4})\s*$', 2))) > 0 THEN concat(regexp_extract(value_raw, '([0-9]{4})\s*$', 1), '-', list_position([" + ", ".join(f"'{m}'" for m in dt.MONTHS) + r"], lower(regexp_extract(value_raw, '^\s*([0-9]{1,2})\s+([A-Za-zñáéíóú]+)\s+([0-9]{4})\s*$', 2))), '-', regexp_extract(value_raw, '^\s*([0-9]{1,2})', 1)) END AS DATE)"}),
    ("dt2_serial_timestamp", A, ["attr_id"], {"v": lambda: dt.serial_timestamp(F.when(c("value_raw").rlike("^[2-6][0-9]{4}$"), c("value_raw")))}, {"v": "CASE WHEN regexp_matches(value_raw, '^[2-6][0-9]{4}$') THEN CAST(DATE '1899-12-30' + CAST(value_raw AS INT) AS TIMESTAMP) END"}),
    ("dt3_seen_text", A, ["attr_id"], {"v": lambda: dt.seen_text(F.when(c("value_raw").rlike("^[2-6][0-9]{4}$") | c("value_raw").rlike("^[a-z]"), c("value_raw")))}, {"v": "CASE WHEN regexp_matches(value_raw, '^[2-6][0-9]{4}$') THEN strftime(CAST(DATE '1899-12-30' + CAST(value_raw AS INT) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') WHEN regexp_matches(value_raw, '^[a-z]') THEN trim(value_raw) ELSE '' END"}),
    ("dt4_local_date", E, ["event_id"], {"v": lambda: dt.local_date(F.timestamp_add("HOUR", c("event_id") % 9000, c("ts")))}, {"v": f"CAST({madrid_sql('t')} AS DATE)"}),  # hours of a whole year: both changes of the clock
    ("dt5_stale", D, ["listing_id"], {"v": lambda: dt.stale(F.lit("2026-05-01").cast("timestamp_ntz"), c("captured_at"), 7)}, {"v": "coalesce(epoch(TIMESTAMP '2026-05-01') - epoch(captured_at) > 7 * 86400, true)"}),
    ("dt7_deadline", O, ["o_orderkey"], {"v": lambda: dt.deadline(c("o_orderdate"), 36)}, {"v": "o_orderdate + INTERVAL 36 HOUR"}),
    ("dt8_release_date", A, ["attr_id"], {"v": lambda: dt.release_date(c("value_raw"))}, {"v": r"coalesce(TRY_CAST(CASE WHEN list_position([" + ", ".join(f"'{m}'" for m in dt.MONTHS) + r"], regexp_extract(lower(value_raw), '[0-9]{1,2} de ([a-zñ]+) de [0-9]{4}', 1)) > 0 THEN concat(regexp_extract(lower(value_raw), '[0-9]{1,2} de [a-zñ]+ de ([0-9]{4})', 1), '-', list_position([" + ", ".join(f"'{m}'" for m in dt.MONTHS) + r"], regexp_extract(lower(value_raw), '[0-9]{1,2} de ([a-zñ]+) de [0-9]{4}', 1)), '-', regexp_extract(lower(value_raw), '([0-9]{1,2}) de [a-zñ]+ de [0-9]{4}', 1)) END AS DATE), TRY_CAST(nullif(regexp_extract(value_raw, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), '') AS DATE))"}),
    ("ur1_item_id", I, ["snapshot_id", "raw_href"], {"v": lambda: ur.item_id(c("raw_href"))}, {"v": f"nullif(upper(regexp_extract(raw_href, '{_ITEM}', 1)), '')"}),
    ("ur2_page_url", I, ["snapshot_id", "source_url"], {"v": lambda: ur.page_url(c("source_url"))}, {"v": f"'https://{ur.HOST}' || regexp_replace({_path_sql('source_url')}, '/ref=[^/]*', '', 'g') || coalesce('?' || {_kept_sql('source_url')}, '')"}),
    ("ur3_product_url", I, ["snapshot_id", "raw_href"], {"normalized": lambda: ur.product_url(c("raw_href"))["normalized"], "reason": lambda: ur.product_url(c("raw_href"))["reason"], "review_key": lambda: ur.product_url(c("raw_href"))["review_key"]}, {"normalized": f"CASE WHEN {_REASON} IS NULL THEN 'https://{ur.HOST}' || regexp_replace({_path_sql('f')}, '/ref=[^/]*$', '') || coalesce('?' || {_kept_sql('f')}, '') || regexp_extract(f, '(#.*)$', 1) END", "reason": _REASON, "review_key": f"CASE WHEN {_REASON} IS NULL THEN coalesce(nullif(upper(regexp_extract(f, '{_ITEM}', 1)), ''), regexp_replace({_path_sql('f')}, '/ref=[^/]*$', '')) END"}),
    ("ur4_link_status", I, ["snapshot_id", "raw_href"], {"v": lambda: ur.link_status(c("raw_href"))}, {"v": f"CASE WHEN {_REASON} IS NOT NULL THEN 'INVALID_PRODUCT_LINK' WHEN {_kept_sql('f')} IS NOT NULL OR contains(f, '#') OR regexp_extract(regexp_replace({_path_sql('f')}, '/ref=[^/]*$', ''), '{_PROD}[A-Za-z0-9]{{10}}(.*)$', 1) <> '' THEN 'POSSIBLE_DUPLICATE' ELSE 'UNIQUE_LINK' END"}),
    ("ur5_source_url", I, ["snapshot_id", "source_url"], {"v": lambda: ur.source_url(c("source_url"))}, {"v": "regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(source_url), '[?#].*$', ''), '/ref=[^/]*', '', 'g'), '/-/[a-z]{2}/', '/', 'g'), '/+$', '')"}),
    ("ur6_list_type_node", I, ["snapshot_id", "source_url"], {"v": lambda: ur.list_type(c("source_url")), "node": lambda: ur.browse_node(c("source_url"))}, {"v": "CASE WHEN contains(source_url, '/bestsellers') THEN 'BEST_SELLERS' ELSE 'UNKNOWN' END", "node": f"nullif(regexp_extract({_path_sql('source_url')}, '/([0-9]+)(?:/[^/]*)?/?$', 1), '')"}),
    ("ur7_page_number", I, ["snapshot_id", "source_url"], {"v": lambda: ur.page_number(c("source_url"))}, {"v": "CAST(greatest(1, coalesce(TRY_CAST(nullif(regexp_extract(source_url, '[?&]pg=([0-9]+)', 1), '') AS INT), 1)) AS INT)"}),
    ("ur8_request_identity", I, ["snapshot_id", "source_url"], {"v": lambda: ur.request_identity(c("source_url"))}, {"v": "CASE WHEN q IS NOT NULL AND len(list_distinct(list_transform(string_split(q, '&'), lambda t: split_part(t, '=', 1)))) = len(string_split(q, '&')) THEN regexp_replace(source_url, '[?#].*$', '') || '?' || array_to_string(list_sort(string_split(q, '&')), '&') ELSE source_url END"}),
    ("ur9_request_url", I, ["snapshot_id", "asin"], {"url": lambda: F.coalesce(c("raw_href"), F.concat(F.lit("/dp/"), F.upper(F.trim("asin")))), "provenance": lambda: F.when(c("raw_href").isNotNull(), "HREF").otherwise("ASIN")}, {"url": "coalesce(raw_href, '/dp/' || upper(trim(asin)))", "provenance": "CASE WHEN raw_href IS NOT NULL THEN 'HREF' ELSE 'ASIN' END"}),
    ("ur11_first_page", I, ["snapshot_id", "source_url"], {"v": lambda: ur.first_page(c("source_url")), "grp": lambda: ur.list_group(c("source_url"))}, {"v": "regexp_replace(regexp_replace(source_url, '[?#].*$', ''), '/ref=[^/]*$', '') || coalesce('?' || nullif(array_to_string(list_filter(string_split(q, '&'), lambda t: split_part(t, '=', 1) <> 'pg'), '&'), ''), '')", "grp": f"nullif(regexp_extract({_path_sql('source_url')}, '/bestsellers/([^/]+)', 1), '')"}),
    ("ha2_uuid5", D, ["listing_id"], {"n": lambda: F.length(ids.uuid5(c("url"))), "shape": lambda: ids.uuid5(c("url")).rlike("^[0-9a-f]{8}-[0-9a-f]{4}-5[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")}, {"n": "CAST(36 AS INT)", "shape": "url = url"}),
    ("ha3_short_ids", D, ["listing_id"], {"v": lambda: ids.short_id("cand_", c("url")), "w": lambda: ids.placement_key(F.lit("ES"), c("asin"))}, {"v": "'cand_' || substr(sha256(url), 1, 24)", "w": "'pl_' || substr(sha1('ES|' || asin), 1, 16)"}),
    ("ha4_fingerprint", D, ["listing_id"], {"v": lambda: ids.fingerprint(c("asin"), c("brand"), c("seller"))}, {"v": "sha256(coalesce(length(asin) || ':' || asin, '~') || '|' || coalesce(length(brand) || ':' || brand, '~') || '|' || coalesce(length(seller) || ':' || seller, '~'))"}),
    ("ha5_text_hash", X, ["doc_id"], {"v": lambda: F.sha2("text", 256)}, {"v": "sha256(text)"}),
    ("ar1_category_levels", "category_placements", ["placement_id", "last_seen_at"], {"l1": lambda: ar.category_levels(F.split("category_name", " y "))["l1"], "l2": lambda: ar.category_levels(F.split("category_name", " y "))["l2"], "leaf": lambda: ar.category_levels(F.split("category_name", " y "))["leaf"]}, {"l1": "string_split(category_name, ' y ')[1]", "l2": "string_split(category_name, ' y ')[2]", "leaf": "CASE WHEN len(string_split(category_name, ' y ')) > 1 THEN string_split(category_name, ' y ')[-1] END"}),
    ("ar2_bsr_segments", D, ["listing_id"], {"n": lambda: F.size(ar.rank_segments(c("bsr"))), "rank": lambda: F.get(ar.rank_segments(c("bsr")), 0)["rank"], "cat": lambda: F.get(ar.rank_segments(c("bsr")), 0)["category"]}, {"n": r"CAST(CASE WHEN bsr IS NULL THEN 0 ELSE len(regexp_extract_all(bsr, 'n\.?º?\s*([0-9.,]+)\s+en\s+')) END AS INT)", "rank": r"nullif(regexp_replace(regexp_extract(bsr, 'n\.?º?\s*([0-9.,]+)\s+en\s+', 1), '[.,]', '', 'g'), '')", "cat": r"nullif(trim(regexp_extract(bsr, 'n\.?º?\s*[0-9.,]+\s+en\s+([^()\n]+)', 1)), '')"}),
    ("ar3_compatible_trail", "category_placements", ["placement_id", "last_seen_at"], {"v": lambda: ar.compatible(F.split("category_name", " "), F.split("canonical_url", "/"))}, {"v": "CASE WHEN category_name IS NULL OR canonical_url IS NULL THEN NULL ELSE string_split(category_name, ' ')[1] = string_split(canonical_url, '/')[1] END"}),
    ("ar7_path_parts", I, ["snapshot_id", "source_url"], {"n": lambda: F.size(ar.path_parts(c("source_url"), "/"))}, {"n": "CAST(len(list_filter(string_split(source_url, '/'), lambda x: trim(x) <> '')) AS INT)"}),
    ("ar8_family", D, ["listing_id"], {"v": lambda: F.array_join(ar.family(F.array("asin", F.lower("asin"), "seller")), ",")}, {"v": "array_to_string(list_sort(list_distinct(list_filter([upper(trim(asin)), upper(trim(seller))], lambda x: x IS NOT NULL AND x <> ''))), ',')"}),
    ("mp1_category_map", "category_placements", ["placement_id", "last_seen_at"], {"v": lambda: ar.mapped(c("category_name"), ar.CATEGORIES)}, {"v": "CASE lower(trim(category_name)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ar.CATEGORIES.items()) + " END"}),
    ("mp2_fill_missing", D, ["listing_id"], {"v": lambda: ar.fill_missing(F.create_map(F.lit("brand"), tx.present(c("brand"))), F.create_map(F.lit("brand"), c("seller"), F.lit("asin"), c("asin")))["brand"]}, {"v": "coalesce(nullif(trim(brand), ''), seller)"}),
    ("js1_json_fields", E, ["event_id"], {"v": lambda: F.get_json_object("props", "$.k").cast("bigint")}, {"v": "CAST(json_extract_string(props, '$.k') AS BIGINT)"}),
    ("js3_nested_to_json", D, ["listing_id"], {"v": lambda: F.to_json(F.struct("asin", "listing_id"))}, {"v": "'{\"asin\":\"' || asin || '\",\"listing_id\":' || listing_id || '}'"}),
    ("sp1_unit_class", A, ["attr_id"], {"v": lambda: sp.unit_class(c("value_raw"))}, {"v": sp.unit_class_sql("value_raw")}),
    ("sp2_short_forms", A, ["attr_id"], {"v": lambda: sp.capacity_short(c("value_raw")), "w": lambda: sp.dimension_short(c("value_raw"))}, {"v": sp.capacity_sql("value_raw"), "w": sp.dimension_sql("value_raw")}),
    ("sp3_suspicious_dimension", A, ["attr_id"], {"v": lambda: sp.suspicious_dimension(c("value_raw"))}, {"v": r"coalesce(regexp_matches(value_raw, '^\s*1\s*[xX×]\s*1(\s*[xX×]\s*1)?\s*([a-z]|$)'), false)"}),
    ("sp8_spec_terms", S, ["case_id"], {"v": lambda: tx.replace_terms(c("specification_es"), {"litros": "l", "kilogramos": "kg", "centímetros": "cm"})}, {"v": r"regexp_replace(regexp_replace(regexp_replace(specification_es, '(?i)(^|[^A-Za-z0-9])centímetros($|[^A-Za-z0-9])', '\1cm\2', 'g'), '(?i)(^|[^A-Za-z0-9])kilogramos($|[^A-Za-z0-9])', '\1kg\2', 'g'), '(?i)(^|[^A-Za-z0-9])litros($|[^A-Za-z0-9])', '\1l\2', 'g')"}),
]
# Sub-selects that some SQL above builds on, instead of the bare table.
_FROM = {
    "dt4_local_date": "(SELECT event_id, ts + (event_id % 9000) * INTERVAL 1 HOUR AS t FROM events)",
    "tx19_language": "(SELECT doc_id, text, list_sort([" + ", ".join(f"{{'n': -len(list_intersect(w, [{', '.join(repr(x) for x in own)}])), 'name': '{name}'}}" for name, own in tx.LANGUAGE_WORDS.items()) + "]) AS s FROM (SELECT doc_id, text, list_filter(regexp_split_to_array(lower(text), '[^a-záéíóúüñçãõâêôà]+'), lambda x: length(x) > 1) AS w FROM documents))",
    "tx20_detail_rows": r"(SELECT case_id, list_distinct(list_filter(list_transform(regexp_split_to_array(specification_es, '\n|; | / | \| '), lambda s: trim(s)), lambda s: s <> '')) AS r FROM saved_cases)",
    "nu3_locale_number": "(SELECT snapshot_id, asin, rank_raw, regexp_replace(regexp_extract(rank_raw, '([-+]?[0-9][0-9\\s.,]*)', 1), '\\s', '', 'g') AS n FROM identity_candidates)",
    "ur3_product_url": f"(SELECT snapshot_id, raw_href, {_FULL} AS f FROM identity_candidates)",
    "ur4_link_status": f"(SELECT snapshot_id, raw_href, {_FULL} AS f FROM identity_candidates)",
    "ur8_request_identity": "(SELECT snapshot_id, source_url, nullif(regexp_extract(source_url, '\\?([^#]*)', 1), '') AS q FROM identity_candidates)",
    "ur11_first_page": "(SELECT snapshot_id, source_url, nullif(regexp_extract(source_url, '\\?([^#]*)', 1), '') AS q FROM identity_candidates)",
}


def _query(table: str, keys: list[str], columns: dict[str, Callable[[], Column]]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: read(spark, sf_dir, table).select(*keys, *[make().alias(name) for name, make in columns.items()])


def queries() -> dict:
    return {name: _query(table, keys, columns) for name, table, keys, columns, _ in SCALARS}


def oracles() -> dict[str, str]:
    return {name: f"SELECT {', '.join(keys)}, {', '.join(f'{sql} AS {out}' for out, sql in sqls.items())} FROM {_FROM.get(name, table)}" for name, table, keys, _, sqls in SCALARS}
