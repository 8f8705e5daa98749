"""Column functions on numbers and units written the Spanish way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folded spellings of units and their size in the base unit (g, ml, mm, W).
UNITS: dict[str, dict[str, float]] = {
    "g": {
        "mg": 0.001, "mgs": 0.001, "miligramo": 0.001, "miligramos": 0.001,
        "g": 1, "gr": 1, "grs": 1, "gs": 1, "gramo": 1, "gramos": 1, "gram": 1, "grams": 1,
        "kg": 1000, "kgs": 1000, "kilo": 1000, "kilos": 1000, "kilogramo": 1000, "kilogramos": 1000, "kilogram": 1000, "kilograms": 1000,
        "lb": 453.59237, "lbs": 453.59237, "libra": 453.59237, "libras": 453.59237, "pound": 453.59237, "pounds": 453.59237,
        "oz": 28.349523125, "onza": 28.349523125, "onzas": 28.349523125, "ounce": 28.349523125, "ounces": 28.349523125,
    },
    "ml": {
        "ml": 1, "mls": 1, "mililitro": 1, "mililitros": 1, "cc": 1, "c c": 1, "cm3": 1, "cm³": 1,
        "cl": 10, "cls": 10, "centilitro": 10, "centilitros": 10, "dl": 100, "dls": 100, "decilitro": 100, "decilitros": 100,
        "l": 1000, "lt": 1000, "lts": 1000, "litro": 1000, "litros": 1000, "liter": 1000, "liters": 1000,
        "fl oz": 29.5735295625, "onza liquida": 29.5735295625, "onzas liquidas": 29.5735295625,
    },
    "mm": {
        "mm": 1, "mms": 1, "milimetro": 1, "milimetros": 1, "cm": 10, "cms": 10, "centimetro": 10, "centimetros": 10,
        "dm": 100, "m": 1000, "mt": 1000, "mts": 1000, "metro": 1000, "metros": 1000,
        "in": 25.4, "inch": 25.4, "inches": 25.4, "pulgada": 25.4, "pulgadas": 25.4, '"': 25.4, "″": 25.4, "”": 25.4,
    },
    "W": {"w": 1, "watt": 1, "watts": 1, "vatio": 1, "vatios": 1, "kw": 1000, "kilovatio": 1000, "kilovatios": 1000},
}


def spanish_number(c: Column) -> Column:
    """A number text as double: commas are decimal, points group thousands or stand before one or two decimals.

    ``0.125`` is read as a decimal, as no group of thousands starts with 0; what fits neither writing gives null.
    """
    no_comma = F.when(c.rlike(r"^\d{1,3}(\.\d{3})*,\d+$") | c.rlike(r"^\d+,\d+$"), F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
    grouped = F.when(c.rlike(r"^[1-9]\d{0,2}(\.\d{3})+$"), F.replace(c, F.lit("."), F.lit("")))
    plain = F.when(c.rlike(r"^\d+(\.\d{1,2})?$") | c.rlike(r"^0\.\d+$"), c)
    return F.coalesce(no_comma, grouped, plain).try_cast("double")


def unit_factor(unit: Column, base: str) -> Column:
    """Size of a folded unit spelling in ``base``; null for other spellings."""
    table = F.create_map(*[F.lit(x) for kv in UNITS[base].items() for x in (kv[0], float(kv[1]))])
    return F.try_element_at(table, unit)
