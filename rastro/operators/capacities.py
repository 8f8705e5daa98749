"""Profiles of numbers with units, and proofs that stated capacities agree."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastro.operators.quantities import scan

# Nouns of containers and numerals that count them.
_NOUN = r"(?:contenedor(?:es)?|recipientes?|compartimentos?|bolsas?|cajas?|tazas?|cubos?|botellas?|vasos?|cuencos?|frascos?|unidades|unidad|piezas?|botes?)"
_NUMERALS = {"un": 1, "una": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9, "diez": 10, "once": 11, "doce": 12}
_COUNTED = re.compile(rf"\b(\d{{1,3}}|{'|'.join(_NUMERALS)})\s+{_NOUN}\s+(?:de\s+)?$|\b(\d{{1,3}})\s*[x×]\s*$", re.IGNORECASE)
_TOTAL = re.compile(r"(?:capacidad|volumen|contenido)\s+total\s*(?:de|:)?\s*$|\ben\s+total\s*:?\s*$", re.IGNORECASE)
_DENIED = re.compile(r"\b(?:no\s+(?:incluye|contiene|tiene)|sin\s+incluir|por\s+ejemplo)(?![^\W\d])", re.IGNORECASE)
_CLAUSE_END = re.compile(r"[.;\n]")
NUMBER = r"[0-9]+(?:[.,][0-9]+)*"


def numeric_profile(c: Column) -> Column:
    """``numbers, with_unit, rates, repeated, glued`` of a text: how many numbers it has, how many with a unit, as a rate, said
    twice, or written without a blank before the unit."""
    unit = r"(?:mg|g|gr|kg|ml|cl|dl|l|L|mm|cm|m)"
    stated = F.regexp_extract_all(c, F.lit(rf"({NUMBER} ?{unit})\b"), 1)
    return F.struct(
        F.regexp_count(c, F.lit(NUMBER)).alias("numbers"),
        F.size(stated).alias("with_unit"),
        F.regexp_count(c, F.lit(rf"{NUMBER} ?{unit}/")).alias("rates"),
        (F.size(stated) - F.size(F.array_distinct(stated))).alias("repeated"),
        F.regexp_count(c, F.lit(rf"[0-9]{unit}\b")).alias("glued"),
    )


def capacity_proof(text: str | None) -> tuple[str, int | None, int | None]:
    """``status, total, parts`` in ml: whether a declared total is the sum of the counted parts of the same text.

    ``PROVEN`` and ``CONFLICT`` need exactly one distinct total and at least one counted part; what is denied or an example
    counts for nothing; anything else is ``UNPROVEN``, never guessed.
    """
    if not text:
        return "UNPROVEN", None, None
    read, numbers = scan(text)
    denials, ends = ([m.end() for m in p.finditer(read)] for p in (_DENIED, _CLAUSE_END))
    totals: set[int] = set()
    parts: list[int] = []
    for n in numbers:
        if n.base != "ml":
            continue
        before = read[max(0, n.start - 80) : n.start]
        denial, end = bisect_right(denials, n.start), bisect_right(ends, n.start)
        if denial and (not end or denials[denial - 1] > ends[end - 1]):  # denied since the clause began
            continue
        amount = int(n.value * n.factor + 0.5)
        counted = _COUNTED.search(before)
        if _TOTAL.search(before):
            totals.add(amount)
        elif counted:
            word = (counted[1] or counted[2]).lower()
            parts.append(amount * (_NUMERALS.get(word) or int(word)))
    if len(totals) != 1 or not parts:
        return "UNPROVEN", next(iter(totals)) if len(totals) == 1 else None, sum(parts) or None
    total = totals.pop()
    return ("PROVEN" if total == sum(parts) else "CONFLICT"), total, sum(parts)


def _prove(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        made = [(k, *capacity_proof(t)) for k, t in zip(frame["record_id"], frame["text"], strict=True)]
        out = pd.DataFrame(made, columns=["record_id", "status", "total_ml", "parts_ml"])
        yield out.astype({"total_ml": "Int64", "parts_ml": "Int64"})


def capacity_proofs(texts: DataFrame) -> DataFrame:
    """``record_id, status, total_ml, parts_ml`` of each of ``texts(record_id, text)``."""
    return texts.select("record_id", "text").mapInPandas(_prove, "record_id bigint, status string, total_ml bigint, parts_ml bigint")


def json_after(text: str | None, marker: str) -> str | None:
    """The balanced JSON object or list that follows ``marker`` in a page; None if there is none or it doesn't close."""
    at = text.find(marker) if text else -1
    if at < 0:
        return None
    start = next((i for i in range(at + len(marker), len(text)) if text[i] in "{["), -1)
    if start < 0:
        return None
    depth, quoted, skip = 0, False, False
    for i in range(start, len(text)):
        ch = text[i]
        if skip:
            skip = False
        elif quoted:
            skip, quoted = ch == "\\", ch != '"'
        elif ch == '"':
            quoted = True
        elif ch in "{[":
            depth += 1
        elif ch in "}]":
            depth -= 1
            if not depth:
                return text[start : i + 1]
    return None


def embedded_json(pages: DataFrame, key: str, text: str, marker: str) -> DataFrame:
    """``key, json`` of each page's object after a marker."""
    kind = dict(pages.dtypes)[key]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({key: frame[key], "json": [json_after(t, marker) for t in frame[text]]})

    return pages.select(key, text).mapInPandas(run, f"{key} {kind}, json string")
