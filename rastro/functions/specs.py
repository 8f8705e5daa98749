"""Column functions on specification values, with the SQL each is checked against."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of units by class, tried in this order.
UNIT_CLASSES = [
    ("capacity", r"(?i)[0-9]\s*(ml|mls|cl|l|lt|lts|litros?|mililitros?|centilitros?)\.?$"),
    ("dimension", r"(?i)[0-9]\s*(mm|cm|cms|m|metros?|cent[ií]metros?|mil[ií]metros?|pulgadas?)\.?$"),
    ("weight", r"(?i)[0-9]\s*(mg|g|gr|grs|kg|kgs|kilos?|gramos?|kilogramos?|libras?|lbs?|oz|onzas?)\.?$"),
]
_CAPACITY = r"(?i)^([0-9.,]+)\s*(ml|l)\s*$"
_BOX = r"(?i)^([0-9.,]+)\s*[x×]\s*([0-9.,]+)(?:\s*[x×]\s*([0-9.,]+))?\s*(cm|mm|m)$"


def unit_class(c: Column) -> Column:
    """``capacity``, ``dimension``, ``weight`` or null by the unit a value ends with."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(UNIT_CLASSES):
        out = F.when(c.rlike(pattern), name).otherwise(out)
    return out


def unit_class_sql(x: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{n}'" for n, p in UNIT_CLASSES) + " END"


def capacity_short(c: Column) -> Column:
    """``1,5 L`` as ``1,5L``, millilitres in small letters; null for other values."""
    number, unit = F.regexp_extract(c, _CAPACITY, 1), F.lower(F.regexp_extract(c, _CAPACITY, 2))
    return F.when(number != "", F.concat(number, F.when(unit == "l", "L").otherwise("ml")))


def capacity_sql(x: str) -> str:
    return f"CASE WHEN regexp_extract({x}, '{_CAPACITY}', 1) <> '' THEN regexp_extract({x}, '{_CAPACITY}', 1) || CASE WHEN lower(regexp_extract({x}, '{_CAPACITY}', 2)) = 'l' THEN 'L' ELSE 'ml' END END"


def dimension_short(c: Column) -> Column:
    """``20 x 30 x 5 cm`` as ``20×30×5 cm``; null for other values."""
    parts = [F.regexp_extract(c, _BOX, i) for i in (1, 2, 3, 4)]
    return F.when(parts[0] != "", F.concat(parts[0], F.lit("×"), parts[1], F.when(parts[2] != "", F.concat(F.lit("×"), parts[2])).otherwise(""), F.lit(" "), F.lower(parts[3])))


def dimension_sql(x: str) -> str:
    g = [f"regexp_extract({x}, '{_BOX}', {i})" for i in (1, 2, 3, 4)]
    return f"CASE WHEN {g[0]} <> '' THEN {g[0]} || '×' || {g[1]} || CASE WHEN {g[2]} <> '' THEN '×' || {g[2]} ELSE '' END || ' ' || lower({g[3]}) END"


def suspicious_dimension(c: Column) -> Column:
    """Whether a value is the placeholder ``1 x 1 x 1``."""
    return F.coalesce(c.rlike(r"^\s*1\s*[xX×]\s*1(\s*[xX×]\s*1)?\s*([a-z]|$)"), F.lit(False))


# Nouns of a count before it and after it.
COUNT_BEFORE = r"(?i)(\d{1,4})\s*(?:packs?|piezas?|unidad(?:es)?|uds?\b|pcs?|art[ií]culos?)"
COUNT_AFTER = r"(?i)\b(?:pack|paquete|juego|set)\s+(?:de\s+)?(\d{1,4})"


def _number(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("int")


def count_value(c: Column) -> Column:
    """The number a count field starts with; values with a unit of size or weight count nothing."""
    value = F.replace(F.regexp_extract(F.regexp_replace(c, r"\s", ""), r"^(\d+(?:[.,]\d+)?)", 1), F.lit(","), F.lit("."))
    return F.when(unit_class(F.trim(c)).isNull(), F.nullif(value, F.lit("")).try_cast("double"))


def text_count(c: Column) -> Column:
    """The count a text states before a noun ("6 piezas"), else after one ("pack de 6")."""
    return F.coalesce(_number(c, COUNT_BEFORE), _number(c, COUNT_AFTER))


def variant_count(c: Column) -> Column:
    """Pieces in all of a chosen variant, "N unidades (Paquete de M)": N times M, where either may be missing; null without both."""
    pack = _number(c, COUNT_AFTER)
    unit = _number(F.regexp_replace(c, COUNT_AFTER + ".*$", ""), COUNT_BEFORE)
    return F.when(unit.isNotNull() | pack.isNotNull(), F.coalesce(unit, F.lit(1)) * F.coalesce(pack, F.lit(1)))


def resolved_count(variant: Column, title: Column, size: Column, sets: Column, most: Column) -> Column:
    """The pieces of a product: its variant's, else the title's, the size's, the number of sets, the largest count field.

    1 is no evidence, but a variant that says 1 overrules what the others say: the result is null. ``most`` counts only
    if it is whole.
    """
    chosen = variant_count(variant)
    stated = [F.when(n > 1, n) for n in (text_count(title), text_count(size), F.floor(count_value(sets)).cast("int"), F.when(most == F.floor(most), most.cast("int")))]
    return F.when(chosen.isNotNull(), F.when(chosen > 1, chosen)).otherwise(F.coalesce(*stated))
