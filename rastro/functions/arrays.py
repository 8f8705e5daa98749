"""Column functions on arrays and maps of catalogue fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Known category names and their names in the other language; unknown names give null.
CATEGORIES = {"hogar y cocina": "家居与厨房", "bricolaje": "五金工具", "baño": "浴室", "ferretería": "五金", "cocina": "厨房", "jardín": "花园", "mascotas": "宠物"}


def category_levels(trail: Column) -> Column:
    """``l1, l2, l3, leaf`` of a trail from the root: a trail of one level has no leaf; missing levels are null."""
    return F.struct(F.get(trail, 0).alias("l1"), F.get(trail, 1).alias("l2"), F.get(trail, 2).alias("l3"), F.when(F.size(trail) > 1, F.element_at(trail, -1)).alias("leaf"))


def rank_segments(c: Column) -> Column:
    """``category, rank`` of each ``n.º 12 en Hogar`` in a text; none for null."""
    pattern = r"n\.?º?\s*([\d.,]+)\s+en\s+([^()\n]+?)(?=\s*n\.?\s*º|\s*\(|\s*$)"
    pairs = F.arrays_zip(F.regexp_extract_all(c, F.lit(pattern), 2).alias("category"), F.regexp_extract_all(c, F.lit(pattern), 1).alias("rank"))
    made = F.transform(pairs, lambda p: F.struct(F.trim(F.regexp_replace(p["category"], r"\s*Ver( el| los)?\b.*$", "")).alias("category"), F.regexp_replace(p["rank"], "[.,]", "").alias("rank")))
    return F.coalesce(F.filter(made, lambda p: p["category"] != ""), F.array().cast("array<struct<category:string,rank:string>>"))


def compatible(a: Column, b: Column) -> Column:
    """Whether two trails agree on their first level; null if either is missing."""
    return F.get(a, 0) == F.get(b, 0)


def path_parts(c: Column, separator: str) -> Column:
    """The non-empty parts of a path."""
    return F.filter(F.split(c, separator), lambda x: F.trim(x) != "")


def family(members: Column) -> Column:
    """Members trimmed, in upper case, each once, in order; nulls and blanks left out."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(members, lambda x: F.upper(F.trim(x))), lambda x: x.isNotNull() & (x != ""))))


def mapped(c: Column, table: dict[str, str]) -> Column:
    """A value looked up without regard to case; unknown values give null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), F.lower(F.trim(c)))


def fill_missing(a: Column, b: Column) -> Column:
    """Map ``a`` with its missing and null entries taken from ``b``."""
    return F.map_from_entries(F.transform(F.array_union(F.map_keys(a), F.map_keys(b)), lambda k: F.struct(k, F.coalesce(F.try_element_at(a, k), F.try_element_at(b, k)))))


def first_wins(entries: Column) -> Column:
    """``array<struct<key,value>>`` to a map; of several entries for a key the first non-empty one."""
    stated = F.filter(entries, lambda e: F.coalesce(e["value"], F.lit("")) != "")
    return F.map_from_entries(F.filter(stated, lambda e, i: F.array_position(F.transform(stated, lambda x: x["key"]), e["key"]) == i + 1))
