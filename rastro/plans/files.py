"""Queries of sources, sinks, page extraction and streams: tables are written to the shared folder and read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.functions.dates import MADRID
from rastro.operators import joins
from rastro.operators.quality import chain_breaks
from rastro.plans.scalars import madrid_sql
from rastro.session import cut, passing_folder, read
from rastro.sources import html, readers, writers
from rastro.streaming import catalogue as st

c = F.col
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Place:
    """The tables of a folder, and a new folder to write to."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, table: str) -> DataFrame:
        return read(self.spark, self.sf_dir, table)

    def new(self) -> str:
        return passing_folder(self.spark, "files")


def query(sql: str | None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Place(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def listing_rows(t: Place) -> DataFrame:
    """The listings, each once, as small records."""
    p = t("product_details")
    return p.select(c("listing_id").cast("int").alias("number"), c("asin").alias("name"), (c("listing_id") % 5).cast("int").alias("part")).distinct()


def documents_of(rows: DataFrame, *keys: str, size: int = 500) -> DataFrame:
    """``rows`` with a ``chunk`` for about every ``size`` of them, so that a document written from a chunk is bounded."""
    return rows.withColumn("chunk", F.pmod(F.xxhash64(*rows.columns), F.lit(max(1, rows.count() // size))))


_LISTINGS = "(SELECT DISTINCT CAST(listing_id AS INT) AS number, asin AS name, CAST(listing_id % 5 AS INT) AS part FROM product_details)"
_ALL_LISTINGS = f"SELECT number, name, part FROM {_LISTINGS}"
_FIELDS = "number int, name string, part int"


@query(_ALL_LISTINGS)
def src1_json_list(t):
    path = t.new()
    chunks = documents_of(listing_rows(t)).groupBy("chunk").agg(F.to_json(F.collect_list(F.struct("number", "name", "part"))).alias("v"))
    chunks.select("v").write.option("maxRecordsPerFile", 1).text(path)
    return readers.json_records(t.spark, path, _FIELDS)


@query(_ALL_LISTINGS)
def src2_json_wrappers(t):
    path = t.new()
    row = F.struct("number", "name", "part")
    rows = documents_of(listing_rows(t))
    listed = rows.filter("part < 3").groupBy("part", "chunk").agg(F.to_json(F.struct(F.collect_list(row).alias("rankings"))).alias("v"))
    keyed = rows.filter("part >= 3").groupBy("part", "chunk").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(c("number").cast("string"), row)))).alias("v"))
    for i, v in enumerate((listed, keyed)):
        v.select("v").repartition(5, "v").write.mode("append").option("maxRecordsPerFile", 1).text(path)
    return readers.json_records(t.spark, path, _FIELDS)


@query("SELECT event_id, user_id, event_type, value FROM events")
def src3_json_lines(t):
    path = t.new()
    t("events").select("event_id", "user_id", "event_type", "value").write.json(path)
    return readers.json_lines(t.spark, path, "event_id bigint, user_id bigint, event_type string, value double")


@query("SELECT listing_id::VARCHAR AS listing_id, asin AS item, coalesce(nullif(trim(price_eur), ''), nullif(trim(listprice_eur), '')) AS price FROM product_details")
def src4_products_csv(t):
    path = t.new()
    t("product_details").select("listing_id", "asin", "price_eur", "listprice_eur", "title").write.csv(path, header=True, escape='"', quoteAll=True)
    rows = readers.product_csv(t.spark, path, {"item": ["asin", "ASIN"], "price": ["price_eur", "listprice_eur"]})
    return rows.select("listing_id", "item", "price")


@query(f"SELECT 'B' || lpad(number::VARCHAR, 9, '0') AS item, '<html>' || name || '</html>' AS body, true AS verified FROM {_LISTINGS}")
def src5_html_index(t):
    path = t.new()
    pages = listing_rows(t).select(F.concat(F.lit("B"), F.lpad(c("number").cast("string"), 9, "0")).alias("d"), F.concat(F.lit("<html>"), c("name"), F.lit("</html>")).alias("value"))
    for copy in ("run_1", "run_2"):
        pages.write.partitionBy("d").option("lineSep", "~").text(f"{path}/{copy}")
    index = readers.html_index(t.spark, path, r"d=(B[0-9]{9})/[^/]*\.txt$", "*.txt")
    return index.select("item", F.rtrim(c("body"), F.lit("~")).alias("body"), (F.sha2("body", 256) == c("sha256")).alias("verified"))


@query(_ALL_LISTINGS)
def src7_checkpoint_folder(t):
    path = t.new()
    listing_rows(t).repartition(4).write.json(path)
    return t.spark.read.schema(_FIELDS).json(path)


@query(f"SELECT number, number % 5 <> 0 OR number % 2 = 0 AS readable FROM {_LISTINGS}")
def src8_sealed(t):
    s = listing_rows(t)
    text = F.to_json(F.struct("number", "name"))
    good = F.sha2(text, 256)
    broken = c("number") % 5 == 0
    rows = s.select("number", F.when(broken, F.concat(text, F.lit(" "))).otherwise(text).alias("payload"), good.alias("payload_sha256"), text.alias("backup"), F.when(broken & (c("number") % 2 != 0), "").otherwise(good).alias("backup_sha256"))
    return readers.sealed(rows).select("number", c("verified").isNotNull().alias("readable"))


@query("SELECT event_id, user_id FROM events WHERE event_type = 'click'")
def src9_run_scan(t):
    return readers.run_rows(t("events").select("event_id", "user_id", "event_type"), "event_type", "click", "event_id").select("event_id", "user_id")


@query("SELECT event_id FROM events")
def src10_incremental(t):
    return st.run_to_end(readers.stream_table(t.spark, t.sf_dir, "events").select("event_id"), "append")


@query("SELECT event_id, value FROM events WHERE json_extract_string(props, '$.k') = '1'")
def src12_json_predicate(t):
    return readers.json_equals(t("events"), "props", "$.k", "1").select("event_id", "value")


@query(f"SELECT number::VARCHAR AS \"ASIN\", name AS \"Notas\" FROM {_LISTINGS}")
def src13_header_rows(t):
    top = t.spark.createDataFrame([(0, ["Informe", ""]), (1, ["", ""]), (2, ["ASIN", "Notas"])], "at bigint, cells array<string>")
    body = listing_rows(t).select((c("number") + 3).cast("bigint").alias("at"), F.array(c("number").cast("string"), "name").alias("cells"))
    return readers.header_rows(top.unionAll(body), "at", "cells", ["ASIN", "Notas"])


@query("SELECT asin, title, CAST(rank AS BIGINT) AS bestseller_rank, price_eur AS price_raw, CAST(NULL AS VARCHAR) AS detail_bsr FROM product_details")
def src14_legacy(t):
    return t("product_details").select("asin", "title", c("rank").try_cast("bigint").alias("bestseller_rank"), c("price_eur").alias("price_raw"), F.lit(None).cast("string").alias("detail_bsr"))


@query(f"SELECT name AS item, length(name) + 1 AS length FROM {_LISTINGS}")
def src15_binary_index(t):
    path = t.new()
    listing_rows(t).select(c("name").alias("value"), c("name").alias("d")).write.partitionBy("d").text(path)
    return readers.binary_by_item(t.spark, path, r"d=([^/]+)/.*\.txt$").select("item", c("length").cast("bigint").alias("length"))


@query("SELECT regexp_extract(source_html, '^(run_[0-9]+)/', 1) AS run, count(DISTINCT source_html) AS pages FROM saved_cases WHERE source_html IS NOT NULL GROUP BY 1")
def src16_evidence_groups(t):
    return t("saved_cases").filter("source_html is not null").groupBy(F.regexp_extract("source_html", "^(run_[0-9]+)/", 1).alias("run")).agg(F.countDistinct("source_html").alias("pages"))


@query("SELECT o_orderkey, o_totalprice FROM orders")
def snk1_committed_write(t):
    path = t.new()
    t("orders").select("o_orderkey", "o_totalprice").write.mode("errorifexists").parquet(path)
    return t.spark.read.parquet(path)


@query("SELECT true AS first, false AS again, true AS refused")
def snk2_write_once(t):
    path, rows = t.new(), t("orders").select("o_orderkey", "o_totalprice")
    first, again = writers.write_once(rows, path), writers.write_once(rows.repartition(3), path)
    try:
        writers.write_once(rows.withColumn("o_totalprice", c("o_totalprice") + 1), path)
        refused = False
    except ValueError:
        refused = True
    return t.spark.createDataFrame([(first, again, refused)], "first boolean, again boolean, refused boolean")


@query(f"SELECT 1 AS schema_version, '{{\"name\":\"' || name || '\",\"number\":' || number || '}}' AS payload, sha256('{{\"name\":\"' || name || '\",\"number\":' || number || '}}') AS payload_sha256 FROM {_LISTINGS}")
def snk3_seal(t):
    return writers.seal(listing_rows(t).select("number", "name"))


@query("SELECT count(*) AS n, 0 AS differences FROM product_details")
def snk4_twin(t):
    path, rows = t.new(), t("product_details").select("listing_id", "asin", "title", "brand", "price_eur")
    writers.write_twin(rows, path)
    schema = "listing_id bigint, asin string, title string, brand string, price_eur string"
    both = writers.twin_differences(t.spark, path, schema).agg(F.count(F.lit(1)).cast("int").alias("differences"))
    return rows.agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(both))


@query(f"SELECT name, number, part FROM {_LISTINGS}")
def snk5_preferred_columns(t):
    return writers.preferred_first(listing_rows(t), ["name"])


@query("SELECT 0 AS differences")
def snk6_round_trip(t):
    path, rows = t.new(), t("events").select("event_id", "event_type", "value")
    rows.write.json(path)
    again = t.spark.read.schema("event_id bigint, event_type string, value double").json(path)
    return joins.bag_difference(rows, again).agg(F.count(F.lit(1)).cast("int").alias("differences"))


@query("SELECT asin AS \"ASIN\", min(title) AS \"Título\", min(price_eur) AS \"Precio\" FROM product_details GROUP BY 1")
def snk7_sheet(t):
    return t("product_details").groupBy(c("asin").alias("ASIN")).agg(F.min("title").alias("Título"), F.min("price_eur").alias("Precio")).orderBy("ASIN")


@query("SELECT 's1' AS latest, 2 AS published")
def snk8_publish(t):
    path = t.new()
    writers.publish_snapshot(listing_rows(t), path, "s1", True)
    writers.publish_snapshot(listing_rows(t), path, "s2", False)
    latest = t.spark.read.parquet(f"{path}/_latest").head().snapshot_id
    parts = t.spark.read.option("basePath", path).parquet(f"{path}/snapshot_id=*").select("snapshot_id").distinct().count()
    return t.spark.createDataFrame([(latest, parts)], "latest string, published int")


@query(f"SELECT 'a' AS part, count(*) AS n FROM {_LISTINGS} UNION ALL SELECT 'b', count(*) FROM region")
def snk9_bundle(t):
    path = t.new()
    for name, df in (("a", listing_rows(t)), ("b", t("region"))):
        df.write.parquet(f"{path}/{name}")
    made = [t.spark.read.parquet(f"{path}/{n}").agg(F.lit(n).alias("part"), F.count(F.lit(1)).alias("n")) for n in "ab"]
    return made[0].unionAll(made[1])


@query("SELECT 5 + 4 AS lines")
def snk10_markdown(t):
    text = writers.markdown(t("region").orderBy("r_regionkey"), "Regions")
    return t.spark.createDataFrame([(len(text.split("\n")) - 1 + 0,)], "lines int")


@query("SELECT user_id, max(ts) AS ts FROM events GROUP BY 1")
def snk11_upsert(t):
    e = t("events").select("user_id", "ts", "event_id")
    latest = lambda df: df.groupBy("user_id").agg(F.max("ts").alias("ts"), F.max("event_id").alias("event_id"))
    old, new = latest(e.filter("event_id % 2 = 0")), latest(e.filter("event_id % 2 = 1"))
    return writers.upsert(old, new, "user_id", "ts").select("user_id", "ts")


@query("SELECT event_type, count(*) AS n, true AS verified FROM events GROUP BY 1")
def snk12_manifest(t):
    path, rows = t.new(), t("events").select("event_id", "event_type", "value")
    made = writers.manifest(rows, "event_type")
    rows.write.partitionBy("event_type").parquet(path)
    again = writers.manifest(t.spark.read.parquet(path).select("event_id", "event_type", "value"), "event_type").select("event_type", c("digest").alias("d2"))
    return made.join(again, "event_type").select("event_type", "n", (c("digest") == c("d2")).alias("verified"))


@query("SELECT doc_id, length(text) > 200 AS cut, length(substr(text, 1, 200)) AS kept FROM documents")
def snk13_bounded_fields(t):
    b = writers.bounded(c("text"), 200)
    return t("documents").select("doc_id", b["cut"].alias("cut"), F.length(b["text"]).cast("bigint").alias("kept"))


@query("SELECT 0 AS differences, true AS same_count")
def snk14_reconcile(t):
    path, rows = t.new(), t("category_placements").select("placement_id", "category_name", "depth")
    writers.write_twin(rows, path)
    schema = "placement_id string, category_name string, depth int"
    n, m = writers.read_twin_csv(t.spark, path, schema).count(), t.spark.read.schema(schema).json(f"{path}/jsonl").count()
    return writers.twin_differences(t.spark, path, schema).agg(F.count(F.lit(1)).cast("int").alias("differences")).withColumn("same_count", F.lit(n == m))


# ---- page extraction: pages are made of table rows, and the rows must come back --------------------------------


def escaped(column: str):
    return F.replace(F.replace(F.coalesce(c(column), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def card_pages(t: Place) -> DataFrame:
    rows = t("identity_candidates").withColumn("key", F.concat_ws("|", "snapshot_id", "source_url", "card_index", "ingested_at"))
    page = F.concat(
        F.lit('<html><script>var x = "<div data-asin=no>"</script><div class="ad card" data-asin="B000000000"><a href="/dp/X">ad</a></div><div class="card" data-asin="'), escaped("asin"), F.lit('"><span class="rank">'),
        F.coalesce(F.concat(F.lit("#"), c("rank").cast("string")), F.lit("")), F.lit('</span><a href="'), escaped("raw_href"), F.lit('">x</a><br></div></html>'),
    )
    return rows.select("key", page.alias("html"))


@query("SELECT concat_ws('|', snapshot_id, source_url, card_index, strftime(ingested_at, '%Y-%m-%d %H:%M:%S')) AS key, upper(trim(asin)) AS item, CAST(rank AS BIGINT) AS rank, coalesce(raw_href, '') AS href FROM identity_candidates")
def ht1_list_cards(t):
    return html.extract(card_pages(t), "key", "html", "cards").select("key", "item", "rank", "href")


def detail_pages(t: Place) -> DataFrame:
    page = F.concat(
        F.lit("<html><h1 class=title>"), escaped("title"), F.lit("</h1><span class='brand x'>"), escaped("brand"), F.lit("</span><b class=price>"), escaped("price_eur"), F.lit("</b><s data-a-strike=true>"),
        escaped("listprice_eur"), F.lit("</s><i class=rating>"), escaped("rating"), F.lit("</i><style>.seller{}</style></html>"),
    )
    return t("product_details").select("listing_id", page.alias("html"))


def _words(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '[\\s\\x{{A0}}]+', ' ', 'g')), '')"


@query(f"SELECT listing_id, {_words('title')} AS title, {_words('brand')} AS brand, {_words('price_eur')} AS price FROM product_details")
def ht2_detail_fields(t):
    return html.extract(detail_pages(t), "listing_id", "html", "details").select("listing_id", "title", "brand", "price")


@query("SELECT attr_id, 'tech' AS section, coalesce(trim(regexp_replace(value_raw, '[\\s\\x{A0}]+', ' ', 'g')), '') AS value, 0 AS position FROM product_attributes")
def ht3_attribute_tables(t):
    page = F.concat(F.lit("<table id=tech><tr><th>L</th><td>"), escaped("value_raw"), F.lit("</td></tr></table>"))
    return html.extract(t("product_attributes").select("attr_id", page.alias("html")), "attr_id", "html", "attributes").select("attr_id", "section", "value", "position")


@query("SELECT event_id, 'B000000001' AS item, CAST(user_id AS VARCHAR) AS previous_rank FROM events")
def ht4_movers(t):
    page = F.concat(F.lit('<div data-asin="b000000001"><span class=rank>1</span><em class=previous>'), c("user_id").cast("string"), F.lit("</em></div>"))
    from rastro.sources.html import list_cards

    def run(frames):
        import pandas as pd

        for f in frames:
            yield pd.DataFrame([(k, r[0], r[6]) for k, h in zip(f["event_id"], f["html"], strict=True) for r in list_cards(h, "MOVERS_SHAKERS")], columns=["event_id", "item", "previous_rank"])

    return t("events").select("event_id", page.alias("html")).mapInPandas(run, "event_id bigint, item string, previous_rank string")


@query("SELECT count(*) AS cards, count(rank) AS with_rank, count(*) FILTER (WHERE raw_href IS NULL) AS no_link FROM identity_candidates")
def ht5_page_statuses(t):
    return html.extract(card_pages(t), "key", "html", "cards").agg(F.count(F.lit(1)).alias("cards"), F.count("rank").alias("with_rank"), F.count_if(c("href") == "").alias("no_link"))


@query(f"SELECT listing_id, CASE WHEN {_words('rating')} IS NULL THEN 'ABSENT' WHEN regexp_matches(rating, '^\\s*[0-9]+([.,][0-9]+)?') THEN 'VALID' ELSE 'INVALID' END AS status FROM product_details")
def ht6_rating_status(t):
    r = html.extract(detail_pages(t), "listing_id", "html", "details")
    return r.select("listing_id", F.when(c("rating").isNull(), "ABSENT").when(c("rating").rlike(r"^\s*[0-9]+([.,][0-9]+)?"), "VALID").otherwise("INVALID").alias("status"))


@query("SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 1 AS place FROM events UNION ALL SELECT event_id, event_id, NULL, 2 FROM events")
def js4_client_list(t):
    """The records a list page keeps for its scripts in one attribute, as rows."""
    first = F.concat(F.lit('{"id":'), c("user_id").cast("string"), F.lit(',"k":"'), F.get_json_object("props", "$.k"), F.lit('"}'))
    listed = F.concat(F.lit("["), first, F.lit(',{"id":'), c("event_id").cast("string"), F.lit("}]"))
    page = F.concat(F.lit('<div class="p13n-desktop-grid" data-client-recs-list="'), F.replace(listed, F.lit('"'), F.lit("&quot;")), F.lit('"><div data-asin="B0AAAAAAA1"></div></div>'))
    found = html.extract(t("events").select("event_id", page.alias("html")), "event_id", "html", "records")
    return found.select("event_id", F.get_json_object("record", "$.id").cast("bigint").alias("user_id"), F.get_json_object("record", "$.k").cast("bigint").alias("k"), "place")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def ht7_embedded_json(t):
    page = F.concat(F.lit("<html><script data-client-list='["), c("props"), F.lit("]'></script></html>"))
    listed = F.regexp_extract("html", r"data-client-list='([^']*)'", 1)
    return t("events").select("event_id", page.alias("html")).select("event_id", F.get(F.from_json(listed, "array<struct<k:bigint>>"), 0)["k"].alias("k"))


@query(f"SELECT number, 1 AS depth, name AS name FROM {_LISTINGS} UNION ALL SELECT number, 2, 'child' FROM {_LISTINGS}")
def ht8_navigation(t):
    page = F.concat(F.lit("<nav><ul><li><a href='/b/1'>"), c("name"), F.lit("</a><ul><li><a href='/b/2'>child</a></li></ul></li></ul></nav>"))
    return html.extract(listing_rows(t).select("number", page.alias("html")), "number", "html", "navigation").select("number", "depth", "name")


@query(f"SELECT listing_id, {_words('listprice_eur')} AS struck_price FROM product_details")
def ht9_struck_price(t):
    return html.extract(detail_pages(t), "listing_id", "html", "details").select("listing_id", "struck_price")


@query(f"SELECT listing_id, {_words('title')} IS NOT NULL AND NOT regexp_matches(lower(title), '^(patrocinado|anuncio)') AS proven FROM product_details")
def ht10_title_proof(t):
    r = html.extract(detail_pages(t), "listing_id", "html", "details")
    return r.select("listing_id", (c("title").isNotNull() & ~F.coalesce(F.lower("title").rlike("^(patrocinado|anuncio)"), F.lit(False))).alias("proven"))


@query("SELECT event_id, props AS json FROM events")
def js2_embedded_json(t):
    from rastro.operators.capacities import embedded_json

    page = F.concat(F.lit("<script>var a = {}; window.data = "), c("props"), F.lit("; if (x) { y = [1] }</script>"))
    return embedded_json(t("events").select("event_id", page.alias("html")), "event_id", "html", "window.data =")


@query(f"SELECT number, sha256('{{\"name\":\"' || name || '\",\"number\":' || number || '}}') AS digest FROM {_LISTINGS}")
def ha1_canonical_digest(t):
    rows = listing_rows(t).select("number", "name")
    return rows.select("number", F.sha2(writers.row_text(rows), 256).alias("digest"))


_UNIT = "(?:mg|g|gr|kg|ml|cl|dl|l|L|mm|cm|m)"
_NUM = "[0-9]+(?:[.,][0-9]+)*"


@query(f"SELECT case_id, CAST(len(regexp_extract_all(specification_es, '{_NUM}')) AS INT) AS numbers, CAST(len(s) AS INT) AS with_unit, CAST(len(regexp_extract_all(specification_es, '{_NUM} ?{_UNIT}/')) AS INT) AS rates, CAST(len(s) - len(list_distinct(s)) AS INT) AS repeated, CAST(len(regexp_extract_all(specification_es, '[0-9]{_UNIT}\\b')) AS INT) AS glued FROM (SELECT *, regexp_extract_all(specification_es, '{_NUM} ?{_UNIT}\\b') AS s FROM saved_cases)")
def sp9_numeric_profile(t):
    from rastro.operators.capacities import numeric_profile

    return t("saved_cases").select("case_id", numeric_profile(c("specification_es")).alias("p")).select("case_id", "p.*")


@query(None)
def sp10_capacity_proofs(t):
    from rastro.operators.capacities import capacity_proofs

    return capacity_proofs(t("capacity_totals").select(c("total_id").alias("record_id"), c("source_text").alias("text")))


# ---- streams and folds ------------------------------------------------------------------------------------------


def stream(t: Place) -> DataFrame:
    return readers.stream_table(t.spark, t.sf_dir, "events")


@query("SELECT event_type, count(*) AS n, sum(value) AS total, max(ts) AS last_seen FROM events GROUP BY 1")
def sta1_running_counts(t):
    return st.run_to_end(st.running_counts(stream(t), ["event_type"], "value"), "complete")


@query("SELECT count(DISTINCT user_id) AS users, true AS each_once FROM events")
def sta2_first_only(t):
    timed = st.with_event_time(stream(t).select("user_id", "ts"), "ts", "40 days")
    out = st.run_to_end(st.first_only(timed, ["user_id"]), "append")
    return out.agg(F.count(F.lit(1)).alias("users"), (F.count(F.lit(1)) == F.countDistinct("user_id")).alias("each_once"))


_VERSIONS = "(SELECT user_id, event_type AS digest, event_id FROM events QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id))"


@query(f"SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INT) AS version, digest FROM {_VERSIONS}")
def sta3_slot_versions(t):
    return st.run_to_end(st.slot_versions(stream(t).select("user_id", c("event_type").alias("digest"), "event_id"), "user_id", "digest", "event_id"), "append")


@query("SELECT count(*) FILTER (WHERE event_id % 10 = 0) AS pending, count(*) FILTER (WHERE event_id % 10 <> 0) AS indexed FROM events")
def sta4_pending(t):
    journal = t("events").select("event_id")
    indexed = journal.filter("event_id % 10 <> 0")
    return journal.join(indexed, "event_id", "left_anti").agg(F.count(F.lit(1)).alias("pending")).join(F.broadcast(indexed.agg(F.count(F.lit(1)).alias("indexed"))))


@query("SELECT user_id, max(ts) AS last_seen FROM events GROUP BY 1")
def sta5_order_free_max(t):
    return st.run_to_end(stream(t).groupBy("user_id").agg(F.max("ts").alias("last_seen")), "complete")


_CLAIM = "(SELECT user_id, ts, event_id, CASE event_type WHEN 'view' THEN 'reserve' WHEN 'click' THEN 'save' WHEN 'purchase' THEN 'commit' WHEN 'error' THEN 'hold' ELSE 'skip' END AS k FROM events)"


@query(f"WITH o AS (SELECT user_id, k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS o FROM {_CLAIM}), r AS (SELECT user_id, min(o) FILTER (WHERE k = 'reserve') AS r, min(o) FILTER (WHERE k IN ('hold', 'skip')) AS f FROM o GROUP BY 1), s AS (SELECT r.*, (SELECT min(o) FROM o WHERE o.user_id = r.user_id AND k = 'save' AND o > r.r) AS s FROM r), c AS (SELECT s.*, (SELECT min(o) FROM o WHERE o.user_id = s.user_id AND k = 'commit' AND o > s.s) AS c FROM s) SELECT user_id, CASE WHEN c IS NOT NULL AND (f IS NULL OR c < f) THEN 'COMMITTED' WHEN f IS NOT NULL THEN (SELECT CASE k WHEN 'hold' THEN 'HELD' ELSE 'SKIPPED' END FROM o WHERE o.user_id = c.user_id AND o = f) WHEN s IS NOT NULL THEN 'SAVED' WHEN r IS NOT NULL THEN 'RESERVED' ELSE 'PENDING' END AS state FROM c")
def sta6_claim_states(t):
    e = t("events")
    kind = F.when(c("event_type") == "view", "reserve").when(c("event_type") == "click", "save").when(c("event_type") == "purchase", "commit").when(c("event_type") == "error", "hold").otherwise("skip")
    return st.claim_states(e.withColumn("k", kind), "user_id", "k", [c("ts"), c("event_id")])


@query("SELECT event_id, spent <= 200 AS fits FROM (SELECT event_id, sum(CASE WHEN event_type = 'error' THEN 20.0 ELSE value END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS spent FROM events)")
def sta7_budget(t):
    used = F.when(c("event_type") != "error", c("value"))
    return st.budget_states(t("events"), "user_id", [c("ts"), c("event_id")], F.lit(20.0), used, 200).select("event_id", "fits")


@query("SELECT event_type, count(DISTINCT user_id) AS batches FROM events GROUP BY 1")
def sta8_idempotent_batches(t):
    return t("events").select("event_type", "user_id").distinct().groupBy("event_type").agg(F.count(F.lit(1)).alias("batches"))


@query("WITH RECURSIVE b AS (SELECT user_id, event_type, count(DISTINCT event_id) AS observations, row_number() OVER (PARTITION BY user_id ORDER BY min(ts), event_type) AS o FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2), r AS (SELECT user_id, event_type, observations, o, CASE WHEN observations <= 30 THEN observations ELSE 0 END AS spent, observations <= 30 AS accepted FROM b WHERE o = 1 UNION ALL SELECT b.user_id, b.event_type, b.observations, b.o, r.spent + CASE WHEN r.spent + b.observations <= 30 THEN b.observations ELSE 0 END, r.spent + b.observations <= 30 FROM r JOIN b ON b.user_id = r.user_id AND b.o = r.o + 1) SELECT user_id, event_type, observations, spent, accepted FROM r")
def sta8_batch_budget(t):
    e = t("events").select("user_id", "event_type", "event_id", "ts")
    return st.accepted_batches(e.unionAll(e.filter("event_id % 3 = 0")), "event_type", "event_id", "user_id", "ts", 30)


@query("WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'error' THEN 'undo' WHEN 'purchase' THEN 'same' ELSE 'different' END AS k FROM events), w AS (SELECT *, sum(CASE WHEN k = 'undo' THEN -1 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS s FROM e), d AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY user_id ORDER BY event_id)) AS d FROM w), m AS (SELECT *, min(d) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM d) SELECT user_id, arg_max(k, event_id) AS decision FROM m WHERE k <> 'undo' AND coalesce(after, d) >= d GROUP BY 1")
def sta9_identity_replay(t):
    kind = F.when(c("event_type") == "error", "undo").when(c("event_type") == "purchase", "same").otherwise("different")
    return st.standing_decisions(t("events").withColumn("k", kind), "user_id", "k", "undo", [c("event_id")])


@query("SELECT event_id FROM events WHERE event_id % 50 = 0")
def sta10_hash_chain(t):
    from pyspark.sql import Window

    e = t("events").withColumn("digest", F.sha2(c("event_id").cast("string"), 256))
    linked = e.withColumn("previous", F.lag("digest").over(Window.partitionBy("user_id").orderBy("event_id")))
    damaged = linked.withColumn("previous", F.when(c("event_id") % 50 == 0, "broken").otherwise(c("previous")))
    return chain_breaks(damaged, "user_id", "event_id", "digest", "previous").select("event_id")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS \"end\", count(*) AS n FROM events GROUP BY 1, 2")
def sta11_windows(t):
    out = st.run_to_end(st.sliding_counts(st.with_event_time(stream(t), "ts", "1 hour"), "ts", "1 day", "1 day"), "complete")
    return out.select(c("start").cast("timestamp_ntz").alias("start"), c("end").cast("timestamp_ntz").alias("end"), "n")


@query("SELECT count(DISTINCT md5(text)) AS misses FROM documents WHERE text <> '' AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE lang = 'en' AND text IS NOT NULL)")
def sta12_cache_misses(t):
    d = t("documents").withColumn("k", F.md5("text"))
    return d.filter("text <> ''").join(d.filter("lang = 'en' and text is not null").select("k"), "k", "left_anti").agg(F.countDistinct("k").alias("misses"))


@query("SELECT count(DISTINCT source_url) AS in_flight FROM identity_candidates")
def sta13_in_flight(t):
    return t("identity_candidates").select("source_url").distinct().agg(F.count(F.lit(1)).alias("in_flight"))


@query("SELECT asin, label_raw, arg_max(value_raw, captured_at) AS value_raw, CAST(count(DISTINCT value_raw) AS BIGINT) AS versions FROM (SELECT asin, label_raw, captured_at, max(coalesce(value_raw, '')) AS value_raw FROM product_attributes WHERE asin IS NOT NULL AND label_raw IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2")
def sta14_merge_shards(t):
    rows = t("product_attributes").filter("asin is not null and label_raw is not null").groupBy("asin", "label_raw", "captured_at").agg(F.max(F.coalesce("value_raw", F.lit(""))).alias("value_raw"))
    return st.merge_shards(rows.withColumn("digest", F.lit("")), ["asin", "label_raw"], "digest", "captured_at", "value_raw").select("asin", "label_raw", "value_raw", "versions")


@query("SELECT asin, max(captured_at) AS captured_at FROM saved_cases WHERE asin IS NOT NULL GROUP BY 1")
def sta15_latest_state(t):
    best = t("saved_cases").filter("asin is not null").groupBy("asin").agg(F.max(F.struct("captured_at", "case_id")).alias("b"))
    return best.select("asin", "b.captured_at")


@query(f"SELECT CAST({madrid_sql('ts')} AS DATE) AS local_day, count(*) AS n FROM events GROUP BY 1")
def sta16_local_days(t):
    timed = stream(t).withColumn("ts", c("ts").cast("timestamp"))
    return st.run_to_end(st.local_day_counts(timed, "ts", MADRID), "complete")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def sta17_frontier_counts(t):
    return st.run_to_end(stream(t).groupBy("user_id").agg(F.count(F.lit(1)).alias("n")), "complete")


@query(f"WITH RECURSIVE p AS (SELECT placement_id, nullif(first_up, '') AS up, status, seen FROM (SELECT placement_id, parent_placement_id AS first_up, status, last_seen_at AS seen FROM category_placements WHERE placement_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY placement_id ORDER BY last_seen_at DESC, parent_placement_id DESC NULLS LAST, status DESC) = 1)), r AS (SELECT placement_id, CAST(0 AS BIGINT) AS level FROM p WHERE up IS NULL UNION ALL SELECT p.placement_id, r.level + 1 FROM r JOIN p ON p.up = r.placement_id) SELECT placement_id, level FROM r JOIN p USING (placement_id) WHERE status = 'PENDING' OR status = 'RETRY_WAIT' AND seen + INTERVAL 2 DAY <= TIMESTAMP '2026-05-08 00:00:00'")
def sta17_crawl_frontier(t):
    from rastro.operators.hierarchy import crawl_frontier

    best = t("category_placements").filter("placement_id is not null").groupBy("placement_id").agg(F.max(F.struct("last_seen_at", "parent_placement_id", "status")).alias("b")).select("placement_id", "b.*")
    due = best.withColumn("next_retry_at", c("last_seen_at") + F.expr("INTERVAL 2 DAYS"))
    return crawl_frontier(cut(due), F.lit("2026-05-08 00:00:00").cast("timestamp_ntz"))


@query("SELECT count(*) >= 5000 AS reached, count(*) FILTER (WHERE event_type = 'error') > 100 AS stop FROM events")
def sta18_stop_conditions(t):
    out = st.run_to_end(st.running_counts(stream(t), ["event_type"], "value"), "complete")
    return out.agg((F.sum("n") >= 5000).alias("reached"), (F.sum(F.when(c("event_type") == "error", c("n")).otherwise(0)) > 100).alias("stop"))


@query("SELECT status, count(*) AS n FROM category_placements WHERE status IN ('IN_PROGRESS', 'PENDING') GROUP BY 1")
def sta19_ambiguous(t):
    return t("category_placements").filter(c("status").isin("IN_PROGRESS", "PENDING")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS open FROM (SELECT DISTINCT asin FROM product_details) p WHERE NOT EXISTS (SELECT 1 FROM saved_cases s WHERE s.asin = p.asin)")
def sta20_open_tasks(t):
    return t("product_details").select("asin").distinct().join(t("saved_cases").select("asin"), "asin", "left_anti").agg(F.count(F.lit(1)).alias("open"))


@query("SELECT count(*) AS unresolved FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'O') o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def sta21_unresolved(t):
    return t("orders").filter("o_orderstatus = 'O'").select(c("o_orderkey").alias("l_orderkey")).distinct().join(t("lineitem").select("l_orderkey"), "l_orderkey", "left_anti").agg(F.count(F.lit(1)).alias("unresolved"))


def queries() -> dict:
    return QUERIES


def oracles() -> dict[str, str]:
    return ORACLES
