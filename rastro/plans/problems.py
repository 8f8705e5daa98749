"""The queries of the general training-data problems (p1, p3, p5, p6) over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rastro.operators.hierarchy import descendants, latest_rows, resolve_hierarchy
from rastro.operators.quantities import convert_quantities
from rastro.operators.snapshot_diff import snapshot_changes
from rastro.operators.wide_table import wide_table
from rastro.session import cut, read

# Labels of each column of this catalogue beside the one usual label that comes with the column list.
LABELS = {
    "peso_g": ["peso", "peso neto", "peso producto", "peso articulo", "peso del articulo", "peso del producto", "peso unitario", "item weight", "net weight", "product weight", "weight"],
    "peso_paquete_g": ["peso del paquete", "peso paquete", "peso bruto", "peso con embalaje", "peso de envio", "peso del envio", "package weight", "shipping weight", "gross weight"],
    "carga_max_g": ["peso maximo recomendado", "peso maximo soportado", "peso maximo", "carga maxima", "carga maxima recomendada", "capacidad de carga", "maximum weight recommendation", "maximum load", "weight capacity"],
    "capacidad_ml": ["capacidad", "capacidad del producto", "capacidad del recipiente", "capacidad total", "volumen", "volumen del articulo", "volumen del producto", "item volume", "capacity", "volume"],
    "diametro_mm": ["diametro", "diametro del producto", "diametro del articulo", "item diameter", "diameter"],
    "potencia_w": ["potencia", "potencia electrica", "potencia nominal", "wattage", "power"],
    "numero_piezas": ["numero de piezas", "n o de piezas", "no de piezas", "cantidad de piezas", "piezas", "number of pieces", "piece count"],
    "numero_pieza": ["numero de pieza", "n o de pieza", "no de pieza", "referencia del fabricante", "part number", "manufacturer part number"],
    "apto_lavavajillas": ["apto para lavavajillas", "apto lavavajillas", "lavable en lavavajillas", "dishwasher safe", "is dishwasher safe"],
    "fecha_disponible": ["disponible desde", "fecha de disponibilidad", "producto disponible desde", "date first available"],
    "color": ["color", "color del producto", "colour"],
    "material": ["material", "material principal", "tipo de material"],
}


def p1_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per asin with the typed columns of attribute_columns."""
    return wide_table(read(spark, sf_dir, "product_attributes"), read(spark, sf_dir, "attribute_columns"), labels=LABELS)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filled cells of the wide table's bigint, boolean and date columns."""
    wide = p1_wide(spark, sf_dir)
    kinds = dict(wide.dtypes)
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in wide.columns if kinds[c] in ("bigint", "boolean", "date")]
    if not cells:
        return wide.select("asin", F.lit("").alias("column_name"), F.lit("").alias("value")).limit(0)
    return wide.select("asin", F.inline(F.array(*cells))).filter("value is not null")


def _placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "category_placements").select("placement_id", "parent_placement_id", "depth", "last_seen_at")
    return latest_rows(rows, "placement_id", "last_seen_at")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placements whose recorded depth is wrong, and those in or below a circle."""
    latest = cut(_placements(spark, sf_dir))
    tree = resolve_hierarchy(latest, paths=False)
    wrong = F.col("in_circle") | (F.col("recorded") != F.col("depth"))
    return (
        tree.join(latest.select(F.col("placement_id").alias("node"), F.col("depth").alias("recorded")), "node")
        .filter(wrong)
        .select(F.col("node").alias("placement_id"), F.coalesce("root", F.lit("")).alias("root_placement_id"), F.col("depth").alias("true_depth"))
    )


def p3_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each placement's path, depth and root."""
    tree = resolve_hierarchy(_placements(spark, sf_dir))
    return tree.select("node", "root", "depth", "in_circle", F.array_join("path", "/").alias("path"))


def p3_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every placement's descendants with their distance."""
    return descendants(resolve_hierarchy(_placements(spark, sf_dir)))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards added, removed or changed since the delivery before."""
    cards = read(spark, sf_dir, "identity_candidates").select("snapshot_id", "asin", "rank", "rank_raw", "source_url", "ingested_at")
    return snapshot_changes(cards, read(spark, sf_dir, "ranking_snapshots"))


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of problem 6, with the field they come from as category and the record's other text beside them.

    Bullets are lines of one text: numbers never join across them.
    """
    fields = (
        ("capacity_totals", "source_text", "total_id", F.col("source_text"), "title_from_saved_html"),
        ("saved_cases", "specification_es", "case_id", F.col("specification_es"), "title_es_raw"),
        ("capacity_context", "feature_bullets_raw", "context_id", F.array_join("feature_bullets_raw", "\n"), "product_description_raw"),
    )
    parts = [
        read(spark, sf_dir, table).select(F.lit(field).alias("field_name"), F.col(key).alias("record_id"), text.alias("text"), F.col("field").alias("category"), F.col(beside).alias("beside"))
        for table, field, key, text, beside in fields
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct quantities stated in each field, in g, ml or mm."""
    found = convert_quantities(_statements(spark, sf_dir))
    return found.filter("status <> 'review'").select("field_name", "record_id", "dimension", "value").distinct()


def p6_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers whose missing unit the classifier is not sure of."""
    return convert_quantities(_statements(spark, sf_dir)).filter("status = 'review'")


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_wide, p3_found, p3_paths, p3_descendants, p5_found, p6_found, p6_review)}


_TREE = """
WITH RECURSIVE latest AS (
  SELECT placement_id, arg_max(nullif(parent_placement_id, ''), last_seen_at) AS parent0, arg_max(depth, last_seen_at) AS depth0,
         max(last_seen_at) AS seen
  FROM category_placements GROUP BY placement_id),
node AS (
  SELECT c.placement_id, r.parent_placement_id AS parent, r.depth AS recorded
  FROM latest c JOIN (SELECT DISTINCT placement_id, nullif(parent_placement_id, '') AS parent_placement_id, depth, last_seen_at FROM category_placements) r
    ON r.placement_id = c.placement_id AND r.last_seen_at = c.seen),
tree AS (
  SELECT placement_id, recorded, placement_id AS root, CAST(0 AS BIGINT) AS d, [placement_id] AS trail
  FROM node WHERE parent IS NULL OR parent NOT IN (SELECT placement_id FROM node)
  UNION ALL
  SELECT n.placement_id, n.recorded, t.root, t.d + 1, list_append(t.trail, n.placement_id) FROM node n JOIN tree t ON n.parent = t.placement_id)
"""


def oracles() -> dict[str, str]:
    return {
        "p3_found": _TREE
        + """SELECT placement_id, root AS root_placement_id, d AS true_depth FROM tree WHERE recorded <> d
UNION ALL SELECT placement_id, '', CAST(-1 AS BIGINT) FROM node WHERE placement_id NOT IN (SELECT placement_id FROM tree)""",
        "p3_paths": _TREE
        + """SELECT placement_id AS node, root, d AS depth, false AS in_circle, array_to_string(trail, '/') AS path FROM tree
UNION ALL SELECT placement_id, NULL, CAST(-1 AS BIGINT), true, NULL FROM node WHERE placement_id NOT IN (SELECT placement_id FROM tree)""",
        "p3_descendants": _TREE
        + """SELECT ancestor, placement_id AS node, CAST(d - place + 1 AS BIGINT) AS distance
FROM (SELECT placement_id, d, unnest(trail) AS ancestor, unnest(range(1, len(trail) + 1)) AS place FROM tree) WHERE place <= d""",
        "p5_found": """
WITH snap AS (SELECT snapshot_id, row_number() OVER (ORDER BY min(observed_at), snapshot_id) AS n FROM ranking_snapshots GROUP BY snapshot_id),
card AS (
  SELECT s.n, regexp_replace(regexp_replace(regexp_replace(trim(c.source_url), '[?#].*$', ''), '/ref=[^/]*', '', 'g'), '/+$', '') AS page_url,
         upper(trim(c.asin)) AS asin,
         coalesce(c.rank, TRY_CAST(nullif(regexp_replace(regexp_extract(c.rank_raw, '([0-9][0-9.,]*)', 1), '[.,]', '', 'g'), '') AS BIGINT)) AS rank, c.ingested_at
  FROM identity_candidates c JOIN snap s USING (snapshot_id)),
held AS (
  SELECT n, page_url, asin, rank FROM card WHERE page_url <> '' AND asin <> ''
  QUALIFY row_number() OVER (PARTITION BY n, page_url, asin ORDER BY ingested_at DESC, rank DESC NULLS LAST) = 1),
pair AS (
  SELECT coalesce(a.n, b.n + 1) AS n, coalesce(a.page_url, b.page_url) AS page_url, coalesce(a.asin, b.asin) AS asin,
         CASE WHEN b.n IS NULL THEN 'added' WHEN a.n IS NULL THEN 'removed' WHEN a.rank IS DISTINCT FROM b.rank THEN 'changed' END AS change
  FROM held a FULL JOIN held b ON a.n = b.n + 1 AND a.page_url = b.page_url AND a.asin = b.asin)
SELECT s.snapshot_id, p.page_url, p.asin, p.change FROM pair p JOIN snap s ON s.n = p.n WHERE p.change IS NOT NULL AND p.n > 1""",
    }
