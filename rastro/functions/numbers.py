"""Column functions on numbers in catalogue texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rastro.functions.text import decimal_point


def price(c: Column) -> Column:
    """A price text as a positive double; a text with two separators, as ``1.234,56``, is no price."""
    bare = decimal_point(F.regexp_replace(F.upper(F.trim(c)), r"[€\s]|EUR", ""))
    value = F.when(bare.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"), bare).try_cast("double")
    return F.when(value > 0, value)


def discount(current: Column, original: Column) -> Column:
    """``(original - current) / original`` to four places, if the original price is higher."""
    return F.when(original > current, F.round(F.try_divide(original - current, original), 4))


def locale_number(c: Column) -> Column:
    """The first number of a text: of two kinds of separators the last is decimal; a comma is decimal before one or two
    digits, a point groups thousands if it comes twice or before exactly three digits."""
    raw = F.regexp_replace(F.regexp_extract(c, r"([-+]?\d[\d\s\x{A0}\x{202F}.,]*)", 1), r"[\s\x{A0}\x{202F}]", "")
    comma, point = F.length(raw) - F.instr(F.reverse(raw), ","), F.length(raw) - F.instr(F.reverse(raw), ".")
    has_comma, has_point = F.contains(raw, F.lit(",")), F.contains(raw, F.lit("."))
    plain = (
        F.when(has_comma & has_point & (comma > point), F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(has_comma & has_point, F.replace(raw, F.lit(","), F.lit("")))
        .when(has_comma & raw.rlike(r",[0-9]{1,2}$"), F.regexp_replace(F.regexp_replace(raw, r",([0-9]{1,2})$", ".$1"), ",", ""))
        .when(has_comma, F.replace(raw, F.lit(","), F.lit("")))
        .when(raw.rlike(r"\..*\.") | raw.rlike(r"\.[0-9]{3}$"), F.replace(raw, F.lit("."), F.lit("")))
        .otherwise(raw)
    )
    return F.nullif(plain, F.lit("")).try_cast("double")


def monthly_bought(c: Column) -> Column:
    """Lower bound of ``1,5 mil+``; only texts with a plus state one."""
    digits, thousand = F.regexp_extract(c, r"(?i)^\s*([\d.,]+)\s*(mil|k)?\s*\+", 1), F.regexp_extract(c, r"(?i)^\s*([\d.,]+)\s*(mil|k)?\s*\+", 2)
    number = F.nullif(F.replace(F.replace(digits, F.lit("."), F.lit("")), F.lit(","), F.lit(".")), F.lit("")).try_cast("double")
    return F.floor(number * F.when(thousand != "", 1000).otherwise(1)).cast("bigint")


def spanish_count(c: Column) -> Column:
    """A whole number at the beginning of a text, bracketed or not; both separators are dropped."""
    return F.nullif(F.regexp_replace(F.regexp_extract(c, r"^\(?\s*([\d.,]+)", 1), r"[.,]", ""), F.lit("")).try_cast("bigint")


def rating(c: Column) -> Column:
    """A rating from 0 to 5 at the beginning of a text, with a decimal comma or point, as text."""
    value = F.nullif(F.replace(F.regexp_extract(c, r"^\s*([0-9]+(?:[.,][0-9]+)?)", 1), F.lit(","), F.lit(".")), F.lit("")).try_cast("double")
    return F.when(value.between(0, 5), value.cast("string"))


def grouped_count(c: Column) -> Column:
    """A count, with thousands only in full groups of three."""
    return F.when(c.rlike(r"^[0-9]{1,3}([. ][0-9]{3})+$") | c.rlike(r"^[0-9]+$"), F.regexp_replace(c, r"[. ]", "")).try_cast("bigint")


def positive_rank(c: Column) -> Column:
    """A positive whole number, else null."""
    value = F.when(F.trim(c).rlike(r"^[0-9]+$"), F.trim(c)).try_cast("bigint")
    return F.when(value > 0, value)


def litres(number: Column, unit: Column) -> Column:
    """An amount in litres, exact to nine places."""
    factor = F.when(unit == "ml", F.lit("0.001")).when(unit == "cl", F.lit("0.01")).when(unit == "l", F.lit("1")).cast("decimal(6,3)")
    return (number.cast("decimal(18,6)") * factor).cast("decimal(24,9)")


def money_up(c: Column) -> Column:
    """A cost rounded up to six places."""
    return (F.ceil(F.round(c * 1e6, 3)) / 1e6).cast("decimal(18,6)")


def export_number(c: Column) -> Column:
    """A number text with a decimal comma as double, else null."""
    return F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast("double")


def share_of(target: Column, share: float) -> Column:
    """``share`` of a target, rounded up, at least 1."""
    return F.greatest(F.lit(1), F.ceil(target * share)).cast("bigint")


def reserve_seconds(rate: Column, rows: Column, safety: float = 1.5, fixed: float = 60.0, least: float = 120.0) -> Column:
    """Time to keep for checks: measured seconds a row, with a safety factor and a fixed part."""
    return F.greatest(F.lit(least), rate * rows * safety + fixed)
