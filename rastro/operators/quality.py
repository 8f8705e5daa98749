"""Checks of records as tables of issues, and gates over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Severities and record states, the worst first.
SEVERITIES = ["P0", "P1", "P2", "P3"]
STATES = ["SOURCE_CONFLICT", "FAIL", "WARN", "PASS"]
Rule = tuple[str, str, str, Column]


def issues(rows: DataFrame, keys: list[str], rules: list[Rule]) -> DataFrame:
    """``keys, code, severity, field``: one row for each rule whose condition is true; null is not true."""
    found = F.array_compact(F.array(*[F.when(when, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(field).alias("field"))) for code, severity, field, when in rules]))
    return rows.select(*keys, F.inline(found))


def record_states(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """State of every record: conflict, then P0/P1 as FAIL, then WARN, else PASS; and whether it blocks an export."""
    n = found.groupBy(key).agg(F.bool_or(F.col("code") == "SOURCE_CONFLICT").alias("_c"), F.bool_or(F.col("severity").isin("P0", "P1")).alias("_f"), F.count(F.lit(1)).alias("issues"))
    state = F.when(F.col("_c"), "SOURCE_CONFLICT").when(F.col("_f"), "FAIL").when(F.col("issues") > 0, "WARN").otherwise("PASS")
    out = rows.select(key).distinct().join(n, key, "left").withColumn("state", state)
    return out.select(key, "state", F.coalesce("_f", F.lit(False)).alias("blocks"), F.coalesce("issues", F.lit(0)).alias("issues"))


def closure(rows: DataFrame, key: str, fields: dict[str, tuple[Column, Column, Column]]) -> DataFrame:
    """``key, field, class`` of each field's (source, parsed, shown) columns: where on the way a value was lost."""

    def stated(c: Column) -> Column:
        return F.coalesce(F.trim(c.cast("string")), F.lit("")) != ""

    cells = [
        F.struct(F.lit(name).alias("field"), F.when(~stated(s), "SOURCE_MISSING").when(~stated(p), "PARSER_MISSED").when(~stated(d), "MAPPING_MISSED").otherwise("PASS").alias("class"))
        for name, (s, p, d) in fields.items()
    ]
    return rows.select(key, F.inline(F.array(*cells)))


def gate(facts: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """``passed, reasons`` of a row of facts: the conditions that aren't true, null included."""
    reasons = F.array_compact(F.array(*[F.when(~F.coalesce(when, F.lit(False)), F.lit(name)) for name, when in conditions.items()]))
    return facts.withColumn("reasons", F.array_join(reasons, ";")).withColumn("passed", F.col("reasons") == "")


def url_asin(url: Column) -> Column:
    """The id an address names: after ``/dp/`` and the like in any case, else a last path part of ten capitals and digits."""
    named = F.nullif(F.regexp_extract(url, r"(?i)/(?:dp|gp/product|product)/([A-Z0-9]{10})", 1), F.lit(""))
    last = F.nullif(F.regexp_extract(url, r"/([A-Z0-9]{10})(?:[/?#]|$)", 1), F.lit(""))
    return F.upper(F.coalesce(named, last))


def identity_rules(asin: Column, url: Column, image_asin: Column) -> list[Rule]:
    """Rules on a record's id against those its address and picture name; what names none contradicts none."""
    own = F.upper(F.trim(F.coalesce(asin, F.lit(""))))
    return [
        ("ASIN_INVALID", "P0", "asin", ~own.rlike("^[A-Z0-9]{10}$")),
        ("URL_ASIN_MISMATCH", "P0", "product_url", (own != "") & (url_asin(url) != own)),
        ("IMAGE_ASIN_MISMATCH", "P0", "image_url", (own != "") & (F.nullif(F.upper(F.trim(image_asin)), F.lit("")) != own)),
        ("LIMITED_IDENTITY_EVIDENCE", "P2", "raw_href", url_asin(url).isNull()),
    ]


def evidence_agreement(listed: Column, detailed: Column) -> Column:
    """AGREED, CATEGORY_EVIDENCE_CONFLICT, ONE_SIDED or NONE of two statements of one category; missing ones contradict nothing."""
    a, b = F.nullif(F.trim(listed), F.lit("")), F.nullif(F.trim(detailed), F.lit(""))
    return F.when(a == b, "AGREED").when(a != b, "CATEGORY_EVIDENCE_CONFLICT").when(a.isNotNull() | b.isNotNull(), "ONE_SIDED").otherwise("NONE")


def rank_integrity(rows: DataFrame, page: list[str], rank: str, asin: str, card_asin: Column, url: Column) -> DataFrame:
    """``page, code, n``: slots with several ids, gaps in ranks (of pages with at least three), ranks and ids missing or contradicted.

    Ranks below 1 are none. A gap's size comes from the least, greatest and number of ranks, not from the ranks between.
    """
    ok, valid = F.col(rank) > 0, F.coalesce(F.col(asin), F.lit("")).rlike("^[A-Z0-9]{10}$")
    link, card = url_asin(url), F.nullif(F.upper(F.trim(card_asin)), F.lit(""))
    positive = F.when(ok, F.col(rank))
    per = rows.groupBy(*page).agg(
        F.count(positive).alias("_n"), (F.max(positive).cast("bigint") - F.min(positive) + 1 - F.countDistinct(positive)).alias("_gap"), F.count_if(~F.coalesce(ok, F.lit(False))).alias("_none"), F.count_if(~valid).alias("_bad"),
        F.count_if(valid & (F.coalesce(card != link, F.lit(False)) | F.coalesce(link != F.col(asin), F.lit(False)))).alias("_link"), F.count_if(valid & link.isNull()).alias("_weak"),
    )
    found = {"RANK_GAP": F.when(F.col("_n") >= 3, F.col("_gap")), "RANK_MISSING": F.col("_none"), "INVALID_ASIN": F.col("_bad"), "LINK_ASIN_MISMATCH": F.col("_link"), "LIMITED_IDENTITY_EVIDENCE": F.col("_weak")}
    counts = per.select(*page, F.inline(F.array_compact(F.array(*[F.when(n > 0, F.struct(F.lit(code).alias("code"), n.cast("bigint").alias("n"))) for code, n in found.items()]))))
    slots = rows.filter(ok).groupBy(*page, rank).agg(F.countDistinct(asin).alias("_d")).filter("_d > 1")
    return slots.groupBy(*page).agg(F.lit("DUPLICATE_RANK_SLOT").alias("code"), F.count(F.lit(1)).alias("n")).unionAll(counts)


def detail_structure(attributes: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """``key, code, n`` of ``attributes(section, label_raw, value_raw, position, source)``: what makes their order or origin doubtful.

    Positions are local to a section; ``order`` is the order in which they were saved. An item saved again is a duplicate,
    a label given again with another value is not.
    """
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    a = attributes.withColumns({"_s": F.lower(text("section")), "_l": text("label_raw"), "_v": text("value_raw"), "_o": text("source")})
    before = F.lag("position").over(Window.partitionBy(key, "_s").orderBy(*order))
    placed = a.filter("position is not null").withColumn("_before", before).groupBy(key, "_s")
    sections = placed.agg((F.count(F.lit(1)) > F.countDistinct("position")).alias("_twice"), F.bool_or(F.col("_before") > F.col("position")).alias("_back"))
    items = a.groupBy(key, "_s", F.lower("_l"), "_v").agg(F.count(F.lit(1)).alias("_n"))

    def counted(df: DataFrame, **codes: Column) -> DataFrame:
        per = df.groupBy(key).agg(*[F.count_if(when).alias(code) for code, when in codes.items()])
        return per.unpivot(key, list(codes), "code", "n").filter("n > 0")

    rows = counted(a, DETAIL_LABEL_VALUE_MISSING=(F.col("_l") == "") | (F.col("_v") == ""), DETAIL_PROVENANCE_INCOMPLETE=(F.col("_s") == "") | (F.col("_o") == ""), DETAIL_POSITION_MISSING=F.col("position").isNull())
    return rows.unionAll(counted(sections, DETAIL_POSITION_DUPLICATE=F.col("_twice"), DETAIL_POSITION_ORDER=F.col("_back"))).unionAll(counted(items, DETAIL_ITEM_DUPLICATED=F.col("_n") > 1))


def chain_breaks(events: DataFrame, stream: str, order: str, digest: str, previous: str) -> DataFrame:
    """Events of a hash-chained journal whose ``previous`` isn't the digest of the one before (null for the first)."""
    before = F.lag(digest).over(Window.partitionBy(stream).orderBy(order))
    return events.withColumn("_b", before).filter(~F.col(previous).eqNullSafe(F.col("_b"))).drop("_b")
