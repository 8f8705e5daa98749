"""One consistent form for texts that look the same but are stored with different characters.

Method: script-aware repair. Invisible characters, blanks, full-width forms, ligatures and combining accents are put into
one form first. Then the dominant script of each token is determined, and letters of another script are replaced by their
look-alikes of the dominant one only in mixed-script tokens, and only when the result exists in the corpus' vocabulary.

Two steps of their own follow, each marked in the result. ``whole``: a token wholly in a script other than its text's,
whose look-alike in that script exists in the vocabulary of the whole corpus ("сор" for "cop"), is the method's rule one
level up, with the text in place of the token. ``agreed``: a result that no text holds, but that two different mixed
tokens propose, is taken so that two spoilt copies of one unseen word still meet.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.session import cut

BROADCAST_REPAIRS = 100_000  # more accepted repairs than this are joined without a broadcast
_FLUSH = 200_000

# Letters that look like Latin ones, by script; each string pairs with the Latin letters before it.
_LOOK = {
    "Cyrillic": ("aeopcyxijshdqwlABEKMHOPCTXIJSYQW", "аеорсухіјѕһԁԛԝӏАВЕКМНОРСТХІЈЅҮԚԜ"),
    "Greek": ("ovaipukxyABEZHIKMNOPTYX", "οναιρυκχγΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"),
}
# Single characters shown like another one (beside full-width forms, ligatures and canonical equivalents).
_SAME = {"µ": "μ", "‐": "-", "‑": "-"}

_TO_LATIN = {s: dict(zip(foreign, latin, strict=True)) for s, (latin, foreign) in _LOOK.items()}
_FROM_LATIN = {s: {b: a for a, b in t.items()} for s, t in _TO_LATIN.items()}
_SCRIPTS = ("Latin", "Cyrillic", "Greek")
_SCRIPT_OF = {s: regex.compile(rf"\p{{Script={s}}}") for s in _SCRIPTS}
_TOKEN = regex.compile(r"[\p{L}\p{M}]+")
_NOT_SHOWN = regex.compile("[­͏؜᠎​‎‏‪-‮⁠-⁤⁦-⁯﻿]")
_JOINERS = regex.compile("[\u200c\u200d]+")
_PICTURE = regex.compile(r"[\p{Emoji_Presentation}\p{Extended_Pictographic}\p{Emoji_Modifier}\ufe0f]")
_JOINED = regex.compile(r"[\p{Script=Arabic}\p{Script=Devanagari}]")  # scripts whose letters change their shape at joiners
_BLANK = regex.compile(r"[\p{Zs}\t\r\n\f\v\x85  ]")
_WIDE = regex.compile("[！-￮ﬀ-ﬆ]")
_PLAIN = regex.compile(r"[\x20-\x7e]*")
_FOREIGN = regex.compile(r"[\p{Script=Cyrillic}\p{Script=Greek}]")


def _kept_joiner(run: regex.Match) -> str:
    """Of a run of joiners what is seen: one between two pictures, the first beside a letter that it shapes, else none."""
    before, after = run.string[run.start() - 1 : run.start()], run.string[run.end() : run.end() + 1]
    if "\u200d" in run[0] and _PICTURE.match(before) and _PICTURE.match(after):
        return "\u200d"
    return run[0][0] if _JOINED.match(before) or _JOINED.match(after) else ""


def shown(text: str) -> str:
    """``text`` without characters that aren't displayed, blanks as spaces, and each visible sign in one encoding."""
    if _PLAIN.fullmatch(text):
        return text
    text = _JOINERS.sub(_kept_joiner, _NOT_SHOWN.sub("", text))
    text = _WIDE.sub(lambda m: unicodedata.normalize("NFKC", m[0]), _BLANK.sub(" ", text))
    return unicodedata.normalize("NFC", "".join(_SAME.get(c, c) for c in text))


def _dominant(text: str) -> str | None:
    counts = {s: len(p.findall(text)) for s, p in _SCRIPT_OF.items()}
    best = max(_SCRIPTS, key=lambda s: counts[s])
    return best if counts[best] else None


def _swap(token: str, script: str) -> str | None:
    """``token`` with every letter of another script replaced by its look-alike in ``script``; None if one has none.

    Accents are taken off their letters for this and put back after it, so that they compose with the new letters.
    """
    out = []
    for c in unicodedata.normalize("NFD", token):
        own = next((s for s, p in _SCRIPT_OF.items() if p.match(c)), None)
        if own in (None, script):
            out.append(c)
            continue
        latin = c if own == "Latin" else _TO_LATIN[own].get(c)
        to = latin if script == "Latin" or latin is None else _FROM_LATIN[script].get(latin)
        if to is None:
            return None
        out.append(to)
    return unicodedata.normalize("NFC", "".join(out))


def suspicions(text: str) -> dict[str, list[tuple[str, str]]]:
    """Tokens of a shown text that may be repaired, with what they would become and the step that does it.

    ``mixed``: a token of several scripts, into its dominant one, or the text's. ``whole``: a token of one script other
    than the text's, into that.
    """
    if not _FOREIGN.search(text):
        return {}
    main, out = _dominant(text), {}
    for token in set(_TOKEN.findall(text)):
        scripts = {s for s, p in _SCRIPT_OF.items() if p.search(token)}
        if not scripts or (scripts == {main}):
            continue
        step, into = ("mixed", (main, _dominant(token))) if len(scripts) > 1 else ("whole", (main,))
        tries = [(t, step) for s in dict.fromkeys(into) if (t := _swap(token, s)) and t != token]
        if tries:
            out[token] = tries
    return out


def _vocabulary(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tokens of one script, each once per task; and suspect tokens as proposals (``raw`` and ``step`` not null)."""
    columns = ["token", "raw", "step"]
    seen: set[tuple[str, str | None, str | None]] = set()
    for frame in frames:
        for text in frame["shown"]:
            doubtful = suspicions(text)
            seen.update((t, None, None) for t in _TOKEN.findall(text) if t not in doubtful)
            seen.update((to, raw, step) for raw, tries in doubtful.items() for to, step in tries)
        if len(seen) > _FLUSH:
            yield pd.DataFrame(list(seen), columns=columns)
            seen.clear()
    yield pd.DataFrame(list(seen), columns=columns)


def _show(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        frame["shown"] = [shown(t) for t in frame["text"]]
        frame["doubtful"] = [sorted(suspicions(t)) or None for t in frame["shown"]]
        yield frame


def _repair(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        fixed, marks = [], []
        for text, repairs in zip(frame["shown"], frame["repairs"], strict=True):
            found = list(repairs) if repairs is not None else []
            known = {r["raw"]: r["token"] for r in found}
            fixed.append(_TOKEN.sub(lambda m, k=known: k.get(m[0], m[0]), text) if known else text)
            marks.append(sorted({r["step"] for r in found}))
        frame["canonical"], frame["steps"] = fixed, marks
        yield frame[["text_id", "canonical", "steps"]]


def accepted_repairs(shown_texts: DataFrame) -> DataFrame:
    """``raw, token, step`` of the tokens to be repaired, from all texts (``shown``) of the corpus.

    A repair is accepted if its result stands in some text as it is; of several results one that stands there, proposed
    by most tokens, is taken. What only two different mixed tokens propose is marked ``agreed``.
    """
    proposals = cut(shown_texts.select("shown").mapInPandas(_vocabulary, "token string, raw string, step string").distinct())
    wanted = proposals.filter("raw is not null")
    backed = proposals.join(wanted.select("token").distinct(), "token", "left_semi")
    backed = backed.groupBy("token").agg(F.max(F.col("raw").isNull()).alias("stands"), F.count_distinct(F.when(F.col("step") == "mixed", F.col("raw"))).alias("proposers"))
    step = F.when(F.col("stands"), F.col("step")).otherwise("agreed")
    kept = wanted.join(backed, "token").filter((F.col("stands")) | ((F.col("proposers") > 1) & (F.col("step") == "mixed")))
    return kept.groupBy("raw").agg(F.max(F.struct("stands", "proposers", "token", step.alias("step"))).alias("best")).select("raw", "best.token", "best.step")


def canonical_texts(texts: DataFrame) -> DataFrame:
    """``texts(field_name, record_id, text)`` with the column ``canonical``: equal exactly for texts that look the same.

    ``steps`` names what was done to letters of other scripts: ``mixed`` by the method, ``whole`` and ``agreed`` by the
    steps beside it (see above), empty if nothing was. One row per distinct (field, record, text); null, empty and blank
    texts are left out, as they show nothing. Texts of any length are treated whole; extra columns are ignored; an empty
    table gives an empty result. The vocabulary is that of all texts given.
    """
    named = texts.select("field_name", F.col("record_id").cast("bigint").alias("record_id"), "text").filter(F.col("text").rlike(r"[^\p{Z}\s]"))
    rows = named.withColumn("text_id", F.sha2("text", 256)).dropDuplicates(["field_name", "record_id", "text_id"])
    shape = "field_name string, record_id bigint, text string, text_id string, shown string, doubtful array<string>"
    base = cut(rows.mapInPandas(_show, shape))
    doubtful = base.filter("doubtful is not null")
    accepted = cut(accepted_repairs(base))
    side = F.broadcast(accepted) if accepted.count() <= BROADCAST_REPAIRS else accepted
    spoilt = doubtful.dropDuplicates(["text_id"])  # a text many records share is repaired once
    wanted = spoilt.select("text_id", F.explode("doubtful").alias("raw")).join(side, "raw")
    repairs = wanted.groupBy("text_id").agg(F.collect_list(F.struct("raw", "token", "step")).alias("repairs"))
    fixed = spoilt.select("text_id", "shown").join(repairs, "text_id", "left").mapInPandas(_repair, "text_id string, canonical string, steps array<string>")
    columns = ["field_name", "record_id", "text", "canonical", "steps"]
    plain = base.filter("doubtful is null").select("field_name", "record_id", "text", F.col("shown").alias("canonical"), F.array().cast("array<string>").alias("steps"))
    return plain.unionAll(doubtful.join(fixed, "text_id").select(columns))


def same_looking_pairs(texts: DataFrame) -> DataFrame:
    """``field_name, id_a, id_b``: records of one field whose stored texts differ but look the same (``id_a < id_b``).

    Different stored texts are paired first, and only then their records: a text that a third of all records share makes
    no pairs with itself on the way, so no more rows come up than the result has.
    """
    canon = canonical_texts(texts).select("field_name", "record_id", F.sha2("text", 256).alias("stored"), F.sha2("canonical", 256).alias("look"))
    canon = cut(canon)
    forms = canon.select("field_name", "look", "stored").distinct()
    several = forms.groupBy("field_name", "look").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("field_name", "look")
    forms = cut(forms.join(several, ["field_name", "look"]))
    one, other = forms.withColumnRenamed("stored", "one"), forms.withColumnRenamed("stored", "other")
    pairs = one.join(other, ["field_name", "look"]).filter("one < other").select("field_name", "one", "other")
    members = canon.join(forms.select("field_name", "stored"), ["field_name", "stored"], "left_semi").select("field_name", "record_id", "stored")
    first = pairs.join(members.select("field_name", F.col("stored").alias("one"), F.col("record_id").alias("x")), ["field_name", "one"])
    both = first.join(members.select("field_name", F.col("stored").alias("other"), F.col("record_id").alias("y")), ["field_name", "other"]).filter("x <> y")
    return both.select("field_name", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()
