"""Quantities in free text, converted to grams, millilitres and millimetres.

Numbers and units are found by patterns. The unit of a number that has none of its own ("20 x 30 cm", "4 x 250 ml",
"Peso: 480") is predicted by a calibrated forest of trees: as the unit of the number it is linked to, as a unit by name, or
as none. It is fitted on a bounded sample of numbers whose unit is written out, seen as if it were missing, from magnitude,
source field, category, the words before, neighbouring numbers and the record's neighbouring fields. Confident answers are
converted; the others come out for review.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.functions.quantities import UNITS
from rastro.functions.trees import Forest
from rastro.session import spread

SAMPLE_TEXTS = 4_000  # texts per field, about, of which labelled statements are taken
SAMPLE_ROWS = 20_000  # labelled statements at most
LINKED_ODDS = 8  # a number linked to another is that much likelier to be taken, as they are rarer
CONFIDENT = 0.9
DIMENSIONS = {"g": "mass", "ml": "volume", "mm": "length"}

# More spellings of units as they stand in running text, and number words.
_MORE = {
    "c.c.": ("ml", 1), "c.c": ("ml", 1), "fl. oz": ("ml", 29.5735295625), "fl.oz": ("ml", 29.5735295625), "floz": ("ml", 29.5735295625), "oz fl": ("ml", 29.5735295625), "oz. fl": ("ml", 29.5735295625),
    "onza líquida": ("ml", 29.5735295625), "onzas líquidas": ("ml", 29.5735295625), "fluid ounces": ("ml", 29.5735295625), "fluid ounce": ("ml", 29.5735295625),
    "m³": ("ml", 1e6), "m3": ("ml", 1e6), "dm³": ("ml", 1e3), "dm3": ("ml", 1e3), "mm³": ("ml", 1e-3), "hl": ("ml", 1e5), "hectolitros": ("ml", 1e5),
    "milímetro": ("mm", 1), "milímetros": ("mm", 1), "centímetro": ("mm", 10), "centímetros": ("mm", 10), "decímetros": ("mm", 100), "km": ("mm", 1e6), "kilómetros": ("mm", 1e6), "tonelada": ("g", 1e6), "toneladas": ("g", 1e6),
}
_WORDS = {
    "un": 1, "una": 1, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9, "diez": 10, "once": 11, "doce": 12, "trece": 13, "catorce": 14,
    "quince": 15, "dieciséis": 16, "diecisiete": 17, "dieciocho": 18, "diecinueve": 19, "veinte": 20, "veinticinco": 25, "treinta": 30, "cuarenta": 40, "cincuenta": 50, "sesenta": 60, "setenta": 70,
    "ochenta": 80, "noventa": 90, "cien": 100, "ciento": 100, "doscientos": 200, "doscientas": 200, "trescientos": 300, "trescientas": 300, "cuatrocientos": 400, "cuatrocientas": 400, "quinientos": 500,
    "quinientas": 500, "seiscientos": 600, "setecientos": 700, "ochocientos": 800, "novecientos": 900, "mil": 1000, "medio": 0.5, "media": 0.5, "un cuarto de": 0.25, "tres cuartos de": 0.75, "un tercio de": 1 / 3,
}
_FRACTIONS = {"½": 0.5, "¼": 0.25, "¾": 0.75, "⅓": 1 / 3, "⅔": 2 / 3, "⅛": 0.125, "⅜": 0.375, "⅝": 0.625, "⅞": 0.875}

_SPELLINGS = {s: (base, f) for base in DIMENSIONS for s, f in UNITS[base].items() if s not in ("c c", "gs", "dm")} | _MORE
_B = r"[^\S\n]"  # a blank within a line
_UNIT = "(?:" + "|".join(re.escape(s).replace(r"\ ", _B + "+") for s in sorted(_SPELLINGS, key=lambda s: (-len(s), s))) + ")"
# Not a quantity of its own: rates, areas, densities.
_END = rf"(?![\w²³/])(?!{_B}+/{_B}+(?:min|minuto|h|hora|s|seg|día|dia|m²|m2|m³|m3|cm²|cm2)(?!\w))(?!{_B}+(?:por|cada|al|a la){_B}+(?:minuto|min|hora|h|día|dia|segundo|s|semana|mes|metro|m2|m²|litro|kilo|kg)\b)"
_DIGITS = r"(?:\d{1,3}(?:\.\d{3})+(?:,\d+)?(?![\d])|\d+,\d+|\d+\.\d{1,2}(?!\d)|\d+(?![.,]\d))"
_FRAC = "[" + "".join(_FRACTIONS) + "]"
_NUMBER = rf"(?:{_DIGITS}{_B}*{_FRAC}|{_DIGITS}{_B}+\d/\d{{1,2}}(?!\d)|\d/\d{{1,2}}(?!\d)|{_FRAC}|{_DIGITS})"
_WORD = "(?:" + "|".join(sorted((w.replace(" ", _B + "+") for w in _WORDS), key=lambda w: (-len(w), w))) + ")"
_HALF = rf"(?P<half>{_B}+y{_B}+medi[oa]\b)?"
_TOKEN = re.compile(
    rf"(?P<num>(?:(?<![\w.,/])|(?<=\d[xX])){_NUMBER})(?:{_B}*(?P<unit>{_UNIT}){_END}{_HALF})?"
    rf"|\b(?P<word>{_WORD}){_B}+(?P<wunit>{_UNIT}){_END}(?P<whalf>{_B}+y{_B}+medi[oa]\b)?"
    rf"|\b(?P<alone>metro|litro|kilo|kilogramo){_B}+y{_B}+medi[oa]\b",
    re.IGNORECASE,
)
_SIDES = re.compile(rf"({_NUMBER}){_B}*l\.{_B}*[x×]{_B}*({_NUMBER}){_B}*an\.(?:{_B}*[x×]{_B}*({_NUMBER}){_B}*al\.)?", re.IGNORECASE)
_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
_LINK = re.compile(rf"{_B}*(?:(?P<x>[x×*])|(?P<range>[-–—]|\ba\b|\bhasta\b)|(?P<or>\bo\b|\bu\b|\bó\b)|(?P<and>\by\b|\be\b)|(?P<comma>,{_B})|(?P<of>\bde\b)){_B}*(?:(?:alto|ancho|fondo|largo){_B}+)?", re.IGNORECASE)
_COUNTED = re.compile(rf"{_B}+(?:unidades|unidad|uds?\.?|botes|botellas|paquetes|piezas|bolsas|cajas|latas|envases|sobres|rollos|pcs){_B}+de{_B}+", re.IGNORECASE)
_KINDS = ("x", "range", "or", "and", "comma", "of")
_BEFORE = re.compile(r"(?:([^\W\d]+)[^\w\n]+)?([^\W\d]+)[^\w\n]*$")
_AFTER = re.compile(rf"{_B}*(?:(?P<end>$|[\n.;|,)\]/:!?])|(?P<noun>[^\W\d_]+[²³]?|[%°º&€$²³]))")
_UNITS = sorted(set(_SPELLINGS.values()))
_UNIT_ID = {s: i for i, s in enumerate(_UNITS)}
NO_UNIT, SAME_UNIT, FIRST_UNIT = 0, 1, 2  # classes: no quantity, the linked number's unit, and one for each unit
_HASHED = 32


class Found(NamedTuple):
    """A number in a text; ``base`` and ``factor`` of its own unit, if it has one."""

    value: float
    start: int
    end: int
    base: str | None
    factor: float


def _value(text: str) -> float:
    text = text.strip()
    whole = re.fullmatch(rf"({_DIGITS})?\s*(?:({_FRAC})|(\d)/(\d{{1,2}}))?", text)
    if not whole:
        return math.nan
    digits, sign, over, under = whole.groups()
    value = 0.0
    if digits:
        value = float(digits.replace(".", "").replace(",", ".")) if "," in digits or re.fullmatch(r"[1-9]\d{0,2}(\.\d{3})+", digits) else float(digits) if digits.count(".") < 2 else math.nan
    return value + (_FRACTIONS[sign] if sign else int(over) / int(under) if over and int(under) else 0.0)


def _unit(text: str) -> tuple[str, float]:
    key = re.sub(r"\s+", " ", text.lower())
    return _SPELLINGS.get(key) or _SPELLINGS[key.replace(". ", " ")]


def scan(text: str) -> tuple[str, list[Found]]:
    """The numbers of ``text`` (returned as it was read), in their order."""
    text = _SIDES.sub(lambda m: " x ".join(g for g in m.groups() if g), _INVISIBLE.sub("", text))
    out: list[Found] = []
    for m in _TOKEN.finditer(text):
        if m["num"]:
            base, factor = _unit(m["unit"]) if m["unit"] else (None, 0.0)
            value = _value(m["num"]) + (0.5 if m["half"] else 0.0)
        elif m["word"]:
            base, factor = _unit(m["wunit"])
            value = _WORDS[re.sub(r"\s+", " ", m["word"].lower())] + (0.5 if m["whalf"] else 0.0)
        else:
            base, factor = _unit(m["alone"])
            value = 1.5
        if not math.isnan(value):
            out.append(Found(value, m.start(), m.end(), base, factor))
    return text, out


def _hashed(text: str | None) -> int:
    return zlib.crc32(text.lower().encode()) % _HASHED if text else _HASHED


class Setting(NamedTuple):
    """What a text's record tells beside the text: hashed source field and category, and the first quantity of the fields beside it."""

    source: int
    category: int
    unit: int
    size: float


def _setting(field: str, category: str | None, beside: str | None) -> Setting:
    first = next((n for n in scan(beside)[1] if n.base), None) if beside else None
    return Setting(_hashed(field), _hashed(category), _UNIT_ID[(first.base, first.factor)] if first else -1, math.log10(first.value + 1e-3) if first else -9.0)


def _features(setting: Setting, text: str, number: Found, link: str, steps: int, last: Found | None, previous: Found | None) -> list[float]:
    """A number as if it had no unit. ``last``: the number with a unit that ``link`` leads to; ``previous``: the quantity before it."""
    before = _BEFORE.search(text[max(0, number.start - 40) : number.start])
    kind = _KINDS.index(link) if link else -1
    near, dimension = (_UNIT_ID[(last.base, last.factor)], list(DIMENSIONS).index(last.base)) if last else (-1, -1)
    size, other = math.log10(number.value + 1e-3), math.log10(last.value + 1e-3) if last else -9.0
    return [
        kind * len(DIMENSIONS) + dimension, kind, dimension, near, size, other, size - other if last else -9.0, float(number.value == int(number.value)), steps, *setting,
        _hashed(before[2] if before else None), _hashed(before[1] if before else None),
        _UNIT_ID[(previous.base, previous.factor)] if previous else -1, math.log10(previous.value + 1e-3) if previous else -9.0,
    ]


def _after(text: str, end: int) -> str:
    """What follows a number: ``end`` (of its statement), ``noun`` (a counted thing or another measure), or nothing known."""
    found = _AFTER.match(text, end)
    return found.lastgroup if found else ""


def _questions(text: str, numbers: list[Found]) -> Iterator[tuple[int, int, str, int]]:
    """(i, j, kind, steps): number i without a unit; the number j with one that links lead to, or -1; kind of i's link.

    Numbers that count something or have another measure ("5 niveles", "220-240 V") are no questions.
    """
    for i, number in enumerate(numbers):
        if number.base:
            continue
        kind, j = "", i
        while j + 1 < len(numbers) and not numbers[j].base and (link := _LINK.fullmatch(text, numbers[j].end, numbers[j + 1].start)):
            kind = kind or link.lastgroup
            j += 1
        if numbers[j].base:
            yield i, j, kind, j - i
        elif _after(text, numbers[j].end) == "end":
            yield i, -1, kind, j - i


def labelled(setting: Setting, text: str) -> Iterator[tuple[list[float], int]]:
    """Numbers of ``text`` whose answer is written out, as features without it and the class."""
    text, numbers = scan(text)
    previous = None
    for at, a in enumerate(numbers):
        b = numbers[at + 1] if at + 1 < len(numbers) else None
        gap = text[a.end : b.start] if b else ""
        link = _LINK.fullmatch(gap) if b else None
        kind = link.lastgroup if link and b.base else ""
        near = b if kind else None
        if a.base:
            same = near is not None and (a.base, a.factor) == (b.base, b.factor)
            if same and kind in ("x", "comma"):
                yield _features(setting, text, a, kind, 1, b, previous), SAME_UNIT  # "20 cm x 30 cm"
            for known in () if near else {previous, None}:  # where one unit is missing, those before it may be, too
                yield _features(setting, text, a, "", 0, None, known), FIRST_UNIT + _UNIT_ID[(a.base, a.factor)]
            previous = a
        elif b and b.base and (_COUNTED.fullmatch(gap) or kind == "of"):
            for said in ("of", "x"):  # "6 botes de 250 ml" and "pack de 6 de 250 ml" say what "6 x 250 ml" says, and so do 24
                for count in (a, a._replace(value=4 * a.value)):
                    yield _features(setting, text, count, said, 1, b, previous), NO_UNIT
        elif kind in ("range", "or", "and"):
            before = _BEFORE.search(text[: a.start])
            if before and (before[2].lower(), kind) in (("de", "range"), ("entre", "and")):
                for said in ("range", "or", "and"):  # "de 2 a 3 kg", "entre 2 y 3 kg": both ends are quantities
                    yield _features(setting, text, a, said, 1, b, previous), SAME_UNIT
        elif not link and _after(text, a.end) == "noun":
            for known in {previous, None}:
                yield _features(setting, text, a, "", 0, None, known), NO_UNIT  # "24 unidades", "1800 W"


_SAMPLE = "x array<double>, y int"
_COLUMNS = ["field_name", "record_id", "dimension", "value", "confidence", "status"]


def _sampled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = [row for field, category, beside, text in zip(frame["field_name"], frame["category"], frame["beside"], frame["text"], strict=True) for row in labelled(_setting(field, category, beside), text)]
        if rows:
            yield pd.DataFrame({"x": [r[0] for r in rows], "y": [r[1] for r in rows]})


def _told(texts: DataFrame) -> DataFrame:
    """``texts`` with the columns the forest looks at; those not given are null."""
    extra = [(F.col(c) if c in texts.columns else F.lit(None)).cast("string").alias(c) for c in ("category", "beside")]
    return texts.select("field_name", F.col("record_id").cast("bigint").alias("record_id"), "text", *extra)


def fit_units(texts: DataFrame, sample_texts: int = SAMPLE_TEXTS, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """The forest, fitted on at most ``sample_rows`` labelled numbers from about ``sample_texts`` texts of every field.

    Which texts and numbers are taken depends on hashes of their content only. Without any labelled number nothing is
    learnt, and every question goes to review.
    """
    told = _told(texts).filter("text is not null")
    sizes = told.groupBy("field_name").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(float(sample_texts)) / F.col("n")) * (1 << 20)
    few = told.join(F.broadcast(sizes), "field_name").filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share).select("field_name", "category", "beside", "text")
    rank = F.shiftrightunsigned(F.xxhash64("x", "y"), 1) / F.when(F.get("x", F.lit(1)) < 0, 1).otherwise(LINKED_ODDS)
    rows = few.mapInPandas(_sampled, _SAMPLE).orderBy(rank, "x", "y").limit(sample_rows).toPandas()
    return Forest().fit(np.array(rows["x"].tolist(), float).reshape(len(rows), -1 if len(rows) else 1), rows["y"].to_numpy(np.int64) if len(rows) else np.empty(0, np.int64))


def _answers(forest: Forest, x: list[list[float]], confident: float) -> Iterator[tuple[str, int, float]]:
    """(status, class of the likeliest unit or -1, confidence) of each question; status is empty for what surely is none."""
    top, sure, votes = forest.predict(np.array(x, float).reshape(len(x), -1 if x else 1))
    best = votes[:, SAME_UNIT:].argmax(axis=1) + SAME_UNIT if votes.shape[1] > SAME_UNIT else np.full(len(x), -1)
    for question, kind, p, unit in zip(x, top, sure, best, strict=True):
        linked = question[3] >= 0
        unit = SAME_UNIT if linked and kind in (NO_UNIT, SAME_UNIT, -1) else int(kind) if kind >= FIRST_UNIT else -1 if kind < 0 or unit == SAME_UNIT else int(unit)
        status = "review" if p < confident or (kind == SAME_UNIT and not linked) else "" if kind == NO_UNIT else "predicted"
        yield status, unit, float(p)


def _extract(frames: Iterator[pd.DataFrame], forest: Forest, confident: float) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out: list[tuple] = []
        ask: list[tuple] = []
        x: list[list[float]] = []
        for field, key, text, category, beside in zip(frame["field_name"], frame["record_id"], frame["text"], frame["category"], frame["beside"], strict=True):
            if not text:
                continue
            text, numbers = scan(text)
            seen: set[tuple[str, int]] = set()
            for n in numbers:
                if n.base and (q := (DIMENSIONS[n.base], math.floor(n.value * n.factor + 0.5))) not in seen:
                    seen.add(q)
                    out.append((field, key, *q, 1.0, "stated"))
            setting = None
            for i, j, kind, steps in _questions(text, numbers):
                setting = setting or _setting(field, category, beside)
                last = numbers[j] if j >= 0 else None
                ask.append((field, key, numbers[i].value, last))
                x.append(_features(setting, text, numbers[i], kind, steps, last, next((n for n in reversed(numbers[:i]) if n.base), None)))
        for (field, key, value, last), (status, unit, p) in zip(ask, _answers(forest, x, confident), strict=True):
            if not status:
                continue
            base, factor = (last.base, last.factor) if unit == SAME_UNIT and last else _UNITS[unit - FIRST_UNIT] if unit >= FIRST_UNIT else (None, 0.0)
            out.append((field, key, DIMENSIONS[base] if base else None, math.floor(value * factor + 0.5) if base else None, p, status))
        yield pd.DataFrame(out, columns=_COLUMNS).astype({"value": "Int64"})


def convert_quantities(texts: DataFrame, *, forest: Forest | None = None, confident: float = CONFIDENT) -> DataFrame:
    """Quantities stated in ``texts(field_name, record_id, text)``; ``category`` and ``beside`` (text of neighbouring fields) help if given.

    Returns ``field_name, record_id, dimension, value, confidence, status``: ``stated`` with a unit of its own,
    ``predicted`` by at least ``confident``, ``review`` where the forest is less sure, with the likeliest unit (null if
    none was learnt); what surely is no quantity is left out. ``value`` is rounded to whole g, ml or mm, halves up. Null,
    empty and blank texts state nothing; a quantity repeated in a text comes once per text, one repeated over rows of a
    record once per row; extra columns are ignored; empty tables give an empty result. Fits a forest if none is given.
    """
    forest = forest or fit_units(texts)
    schema = "field_name string, record_id bigint, dimension string, value bigint, confidence double, status string"
    return spread(_told(texts), "record_id").mapInPandas(lambda it: _extract(it, forest, confident), schema)
