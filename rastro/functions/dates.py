"""Column functions on dates and instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish month names in order.
MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
MADRID = "Europe/Madrid"


def spanish_date(c: Column) -> Column:
    """``28 octubre 2023`` as a date; unknown months and impossible days give null."""
    pattern = r"^\s*(\d{1,2})\s+([A-Za-zñáéíóú]+)\s+(\d{4})\s*$"
    month = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(c, pattern, 2)))
    text = F.concat_ws("-", F.regexp_extract(c, pattern, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(c, pattern, 1), 2, "0"))
    return F.when(month > 0, text).try_cast("date")


def serial_timestamp(c: Column) -> Column:
    """A spreadsheet's day number (epoch 1899-12-30) as a zone-less timestamp."""
    days = F.replace(F.trim(c.cast("string")), F.lit(","), F.lit(".")).try_cast("double")
    return F.timestamp_seconds(F.round((days - 25569) * 86400)).cast("timestamp_ntz")


def seen_text(c: Column) -> Column:
    """A number read as a spreadsheet's day, anything else as it is; missing as the empty string."""
    return F.when(F.trim(c).rlike(r"^\d+(\.\d+)?$"), F.date_format(serial_timestamp(c), "yyyy-MM-dd HH:mm:ss")).otherwise(F.coalesce(F.trim(c), F.lit("")))


def local_date(utc: Column, zone: str = MADRID) -> Column:
    """The local calendar date of a UTC instant."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def stale(now: Column, seen: Column, days: int) -> Column:
    """Whether more than ``days`` days have passed; unknown times are stale."""
    return F.coalesce(F.timestamp_diff("SECOND", seen, now) > days * 86400, F.lit(True))


def release_date(c: Column) -> Column:
    """The date a card states, as ``d de mes de yyyy`` or ISO."""
    spoken = F.regexp_replace(F.regexp_extract(F.lower(c), r"(\d{1,2} de [a-zñ]+ de \d{4})", 1), " de ", " ")
    iso = F.nullif(F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    return F.coalesce(spanish_date(spoken), iso.try_cast("date"))


def deadline(start: Column, hours: int) -> Column:
    """The end of a task that may take ``hours``."""
    return F.timestamp_add("HOUR", F.lit(hours), start)
