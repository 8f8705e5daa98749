"""Reading level of documents.

Method: familiar-word formula. The words that stand in a large share of a language's documents are its familiar words;
a document's level follows from the share of its words outside that list and from its average sentence length. The
formula's weights, and which share of the documents makes a word familiar, are fitted on rated documents.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastro.session import cut, spread

NOT_STATED = ("", "und")
MIN_DOCUMENTS = 5  # a language with fewer documents has no familiar words
SHARES = (0.2, 0.25, 0.3, 0.35, 0.4)  # candidates: a word in at least this share of the documents is familiar
LABEL_ROWS = 20_000  # rated documents the formula is fitted on, at most
# A language's words in a fifth of its documents are at most five times as many as a document has different words on
# average, however large the corpus is; their number is checked all the same, then they are broadcast.
MAX_FAMILIAR = 1_000_000
_FLUSH = 200_000

_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿]")
_MARKS = re.compile("[\u0300-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")  # combining accents of alphabets read word by word
_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?…。！？]+(?=\s|$)|\n+|[✓✔•●▪■◦‣]")
_HEAD = re.compile(r"\s*(.{1,400}?)(?::\s|\n|\.\s)", re.DOTALL)
_HAN = re.compile("[㐀-鿿豈-﫿]")


def _folded(text: str) -> str:
    """Compatibility forms resolved, accents and invisible characters removed."""
    flat = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text))
    return flat if flat.isascii() else _MARKS.sub("", flat)


def without_heading(text: str) -> str:
    """``text`` after a product heading: a first line or clause with a number, bars or quoted name in it."""
    head = _HEAD.match(text)
    if head and head.end() < len(text) and re.search(r"\d|\||«", head[1]):
        return text[head.end() :]
    return text


def read_text(text: str | None) -> tuple[list[str], int]:
    """(words, sentences) of a text without its heading; no words for null, blank and mostly Chinese texts."""
    if not text or not text.strip():
        return [], 0
    flat = without_heading(_folded(text))
    words = _WORD.findall(flat.lower())
    letters = sum(map(len, words))
    if not letters or len(_HAN.findall(flat)) > 0.3 * letters:
        return [], 0
    return words, sum(1 for s in _END.split(flat) if s and _WORD.search(s)) or 1


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Document counts of words, summed within the task before they are shuffled."""
    counts: Counter = Counter()

    def out() -> pd.DataFrame:
        frame = pd.DataFrame([(lang, word, n) for (lang, word), n in counts.items()], columns=["lang", "word", "n"])
        counts.clear()
        return frame

    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"], strict=True):
            words, _ = read_text(text)
            if words:
                counts[lang, ""] += 1
                counts.update((lang, w) for w in set(words))
        if len(counts) > _FLUSH:
            yield out()
    yield out()


def familiar_words(documents: DataFrame, share: float = min(SHARES)) -> dict[str, dict[str, float]]:
    """Per language, the words in at least ``share`` of its documents, with that share; over all documents."""
    stated = F.coalesce("lang", F.lit(""))
    known = documents.filter(~stated.isin(*NOT_STATED)).select("doc_id", "lang", "text")
    counts = cut(spread(known, "doc_id").select("lang", "text").mapInPandas(_count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = counts.filter((F.col("word") == "") & (F.col("n") >= MIN_DOCUMENTS)).select("lang", F.col("n").alias("documents"))
    rows = counts.join(totals, "lang").filter(F.col("n") >= share * F.col("documents")).select("lang", "word", "n", "documents").limit(MAX_FAMILIAR + 1).collect()
    if len(rows) > MAX_FAMILIAR:
        raise ValueError(f"more than {MAX_FAMILIAR} familiar words: raise the share that makes a word familiar")
    lists: dict[str, dict[str, float]] = {r.lang: {} for r in rows}
    for r in rows:
        if r.word:
            lists[r.lang][r.word] = r.n / r.documents
    return lists


def _measure(frames: Iterator[pd.DataFrame], shared) -> Iterator[pd.DataFrame]:
    lists = shared.value
    for frame in frames:
        out = []
        for doc, lang, text in zip(frame["doc_id"], frame["lang"], frame["text"], strict=True):
            words, sentences = read_text(text)
            stated = lang is not None and lang not in NOT_STATED
            if not words or not lists or (stated and lang not in lists):
                out.append((doc, None, 0, 0, None))
                continue
            if not stated:  # the language whose familiar words make up most of the text
                lang = max(sorted(lists), key=lambda k: sum(lists[k].get(w, 0.0) for w in words))
            own = lists[lang]
            degree = np.fromiter((own.get(w, 0.0) for w in words), float, len(words))
            out.append((doc, lang, len(words), sentences, [float((degree < s).mean()) for s in SHARES]))
        yield pd.DataFrame(out, columns=["doc_id", "lang", "n_words", "n_sentences", "unfamiliar"])


def measure(documents: DataFrame, lists: dict[str, dict[str, float]]) -> DataFrame:
    """``doc_id, lang, n_words, n_sentences, unfamiliar``: shares of words outside the list of each of ``SHARES``.

    ``lang`` is null and the counts 0 where there is nothing to rate: null, empty, blank or Chinese texts, and texts in a
    language without a list.
    """
    shared = documents.sparkSession.sparkContext.broadcast(lists)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text")
    schema = "doc_id bigint, lang string, n_words bigint, n_sentences bigint, unfamiliar array<double>"
    return spread(rows, "doc_id").mapInPandas(lambda it: _measure(it, shared), schema)


@dataclass(frozen=True)
class Formula:
    """Log-odds of a level of at least 2, 3, 4 and 5, each from intercept, unfamiliar share, log sentence length."""

    cutoff: int
    weights: tuple[tuple[float, float, float], ...]

    def at_least(self, level: int) -> Column:
        a, b, c = self.weights[level - 2]
        length = F.log(F.col("n_words") / F.col("n_sentences"))
        odds = F.lit(a) + F.lit(b) * F.col("unfamiliar")[self.cutoff] + F.lit(c) * length
        return 1 / (1 + F.exp(-odds))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z, w = np.c_[np.ones(len(x)), x], np.zeros(x.shape[1] + 1)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w = w + np.linalg.solve(h, z.T @ (y - p) - 1e-2 * w)
    return w


def fit_formula(measures: DataFrame, labels: DataFrame, rows: int = LABEL_ROWS) -> Formula | None:
    """The formula, fitted on at most ``rows`` rated documents (median of a document's ratings, each given once); None without any."""
    ratings = labels.select(*[c for c in ("doc_id", "rater", "reading_level", "rated_at") if c in labels.columns])
    rated = ratings.filter("reading_level between 1 and 5").distinct().groupBy("doc_id").agg(F.percentile("reading_level", F.lit(0.5)).alias("level"))
    sample = (
        measures.filter("n_words > 0").join(rated, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("n_words", "n_sentences", "unfamiliar", "level").toPandas()
    )
    if sample.empty:
        return None
    level = sample["level"].to_numpy(float)
    length = np.log(sample["n_words"].to_numpy(float) / sample["n_sentences"].to_numpy(float))
    shares = np.stack(sample["unfamiliar"].to_numpy())
    fold = np.arange(len(sample)) % 5
    clear = level != 3.5
    y = level >= 4

    def errors(k: int) -> int:
        x = np.c_[shares[:, k], length]
        wrong = 0
        for f in range(5):
            fit, held = (fold != f) & clear, (fold == f) & clear
            w = _logistic(x[fit], y[fit].astype(float))
            wrong += int(((np.c_[np.ones(held.sum()), x[held]] @ w > 0) != y[held]).sum())
        return wrong

    best = min(range(len(SHARES)), key=lambda k: (errors(k), k))
    x = np.c_[shares[:, best], length]
    weights = []
    for k in (2, 3, 4, 5):
        sure = level != k - 0.5
        weights.append(tuple(map(float, _logistic(x[sure], (level[sure] >= k).astype(float)))))
    return Formula(best, tuple(weights))


def reading_levels(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, lang, n_words, sentence_length, unfamiliar, level, demanding`` of each row of ``documents``.

    ``level`` is the expected level on the scale of the labels (1 to 5), ``demanding`` whether 4 or 5 is more likely than
    not. Both are null where there is nothing to rate (null, empty or blank texts, Chinese ones, texts in a language with
    fewer than ``MIN_DOCUMENTS`` documents), and for all documents if none is rated. Documents without a stated language
    (null, empty or ``und``) are rated in the language whose familiar words they use most. Repeated rows give a row each,
    null ratings count for nothing, extra columns are ignored, empty tables give an empty result.
    """
    lists = familiar_words(documents)
    measures = cut(measure(documents, lists))
    formula = fit_formula(measures, labels)
    rated = F.col("n_words") > 0
    level, demanding, share = F.lit(None).cast("double"), F.lit(None).cast("boolean"), F.lit(None).cast("double")
    if formula:
        level, demanding, share = F.lit(1.0), formula.at_least(4) >= 0.5, F.col("unfamiliar")[formula.cutoff]
        for k in (2, 3, 4, 5):
            level = level + formula.at_least(k)
    return measures.select(
        "doc_id",
        "lang",
        "n_words",
        F.when(rated, F.col("n_words") / F.col("n_sentences")).alias("sentence_length"),
        F.when(rated, share).alias("unfamiliar"),
        F.when(rated, level).alias("level"),
        F.when(rated, demanding).alias("demanding"),
    )
