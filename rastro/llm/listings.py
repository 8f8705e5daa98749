"""Listings of the same product.

Method: prefix-filtered set-similarity join on normalised tokens ordered by rarity, with length and positional filters;
exact weighted-containment verification; star clustering.

A listing is normalised to what tells products apart. Size (in base units), colour and number of pieces must agree, so they
are part of every token's key. The tokens are model codes in one spelling and words that stand with few makers (product
lines); words that stand with many makers (kinds, materials, advertising) carry no identity. Without a common code, the
makers must agree as far as they are named, and no two words may exclude each other: words that divide the listings of one
line and size between them, and never stand in one listing nor beside one code, are learnt from the corpus as names of
different variants (colours no list knows, scents, patterns). Equal listings are one class; classes, not listings, are joined.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.operators.hierarchy import latest_rows
from rastro.operators.quantities import scan
from rastro.session import cut

CONTAINED = 0.45  # share of the lighter set's weight that must stand in the other
ONE_MAKER = 0.5  # a word with this share of its listings at one maker, beyond that maker's share of all, identifies a line
RARE_ROWS = 12  # so does a word in at most so many listings
FEW_MAKERS = 0.7  # ... if it stands with fewer makers than this share of its listings
CODE_WEIGHT = 2.0  # a model code weighs as much as two words of its rarity
EXCLUSIVE = 0.02  # words of different variants stand together in at most this share of the rarer one's listings, or codes
VARIANT_SHARE = 1 / 64  # and each in at least this share, and in two, of the listings of a line and size
BROADCAST_WORDS = 100_000
HOT_BLOCK = 2_000  # more classes than this with one token and the same facts: the join on them is salted
COMPACT_ROUNDS = 20  # after so many rounds of clustering their results become one table

# Colour names in both languages, folded.
COLOURS = {
    "negro": "black", "negra": "black", "black": "black", "blanco": "white", "blanca": "white", "white": "white", "rojo": "red", "roja": "red", "red": "red", "azul marino": "navy", "navy blue": "navy",
    "navy": "navy", "azul": "blue", "blue": "blue", "verde": "green", "green": "green", "gris": "grey", "grey": "grey", "gray": "grey", "rosa": "pink", "pink": "pink", "beige": "beige",
    "amarillo": "yellow", "amarilla": "yellow", "yellow": "yellow", "marron": "brown", "brown": "brown", "naranja": "orange", "orange": "orange", "morado": "purple", "purple": "purple", "lila": "lilac",
    "dorado": "gold", "gold": "gold", "plateado": "silver", "silver": "silver", "turquesa": "turquoise", "turquoise": "turquoise",
}
# Brand texts that name no maker.
NO_MAKER = {"", "generico", "generica", "marca blanca", "sin marca", "generic", "unbranded", "na", "nd", "no aplicable"}

_CODE = re.compile(r"(?<![a-z0-9])(?!(?:de|del|con|por|para|hasta|sin|los|las|of|for|with|to|and) \d{1,4}(?!\d))([a-z]{2,4})[ -]?(\d{4,10})[ -]?([a-z])?(?![a-z0-9])")
_MIXED = re.compile(r"(?<![\w-])(?=[a-z-]*\d)[a-z0-9]+(?:-[a-z0-9]+)*(?![\w-])")  # letters and digits in one token
_MEASURE = re.compile(r"\d+[a-z]{1,12}|\d+(?:x\d+)+[a-z]*")
_AFTER_UNIT = re.compile(r"[ -]\d{4,10}(?:[ -]?[a-z])?(?![a-z0-9])", re.IGNORECASE)
_COLOUR = re.compile(r"\b(" + "|".join(sorted(COLOURS, key=lambda c: (-len(c), c))) + r")\b")
_PIECES = re.compile(r"\bx ?(\d{1,4})\b|\b(?:pack|set|juego|lote|kit) (?:de |of )?(\d{1,4})\b|\b(\d{1,4}) ?(?:pcs?|uds?|unidad(?:es)?|piezas?|pieces?)\b")
_WORD = re.compile(r"[^\W\d_]{4,}")
_INVISIBLE = re.compile("[­​-‏‪-‮⁠-⁤﻿]")


def _fold(text: str) -> str:
    flat = unicodedata.normalize("NFKD", _INVISIBLE.sub("", text))
    return re.sub(r"\s+", " ", "".join(c for c in flat if unicodedata.category(c) != "Mn")).lower().strip()


def maker_key(brand: str | None) -> str | None:
    """The maker a brand text names, without decoration; None if it names none."""
    text = re.sub(r"^(?:marca|brand)\s*:?\s+(?!blanca)", "", _fold(brand or ""))
    text = re.sub(r"\b(?:espana|oficial|official|s\.?l\.?u?\.?|s\.?a\.?|store)(?=\s|$)|[®™©]", " ", text)
    text = re.sub(r"[^\w]+", " ", text).strip()
    return None if text in NO_MAKER else text


def _is_code(token: str) -> bool:
    """Whether a token of letters and digits reads as a model code: at least 5 signs, and 3 digits or 3 changes between letters and digits."""
    flat = token.replace("-", "")
    runs = len(re.findall(r"[a-z]+|\d+", flat))
    return len(flat) > 4 and runs > 1 and not _MEASURE.fullmatch(token) and (sum(c.isdigit() for c in flat) > 2 or (runs > 3 and "-" not in token))


def parse_title(title: str | None) -> tuple[str, list[str], list[str]]:
    """(size, colour and pieces as a key; model codes; other words) of a title.

    A model code is a token of letters and digits, in whatever order, or a few letters before a long number; case, hyphens
    and blanks in it don't count. What could be a unit is none if a code goes on after it ("pack de 6 GR-1234567").
    """
    if not title or not title.strip():
        return "", [], []
    read, numbers = scan(title)
    starts = {n.start for n in numbers if n.base}
    sized = [n for n in numbers if n.base and not ((m := _AFTER_UNIT.match(read, n.end)) and not any(n.end <= i < m.end() for i in starts))]
    sizes = sorted({f"{n.base}{int(n.value * n.factor + 0.5)}" for n in sized})
    for n in reversed(sized):
        read = f"{read[: n.start]} {read[n.end :]}"
    text = _fold(read)
    codes = {"".join(g or "" for g in m).upper() for m in _CODE.findall(text)}
    text = _CODE.sub(" ", text)
    mixed = [t for t in _MIXED.findall(text) if _is_code(t)]
    codes = sorted(codes | {t.replace("-", "").upper() for t in mixed})
    if mixed:
        text = _MIXED.sub(lambda m: " " if _is_code(m[0]) else m[0], text)
    pieces = max([int(g) for m in _PIECES.findall(text) for g in m if g] or [1])
    colours = sorted({COLOURS[c] for c in _COLOUR.findall(text)})
    words = sorted({w for w in _WORD.findall(_PIECES.sub(" ", _COLOUR.sub(" ", text)))})
    return f"{'+'.join(sizes)}|{'+'.join(colours)}|{max(pieces, 1)}", codes, words


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        parsed = [parse_title(t) for t in frame["title"]]
        yield pd.DataFrame({"listing_id": frame["listing_id"], "maker": [maker_key(b) for b in frame["brand"]], "facts": [p[0] for p in parsed], "codes": [p[1] for p in parsed], "words": [p[2] for p in parsed]})


def _with_title_makers(parsed: DataFrame) -> DataFrame:
    """``parsed`` with the maker the title names where the brand names none."""
    makers = parsed.filter("maker is not null").groupBy(F.col("maker").alias("word")).agg(F.count(F.lit(1)).alias("n")).filter("n > 2")
    silent = parsed.filter("maker is null").select("listing_id", F.explode("words").alias("word")).join(makers, "word")
    named = silent.groupBy("listing_id").agg(F.max(F.struct("n", "word")).alias("best")).select("listing_id", F.col("best.word").alias("named"))
    return parsed.join(named, "listing_id", "left").withColumn("maker", F.coalesce("maker", "named")).drop("named")


def _line_words(parsed: DataFrame, rows: int) -> DataFrame:
    """``word, df`` of the words that identify product lines and stand in at least two listings."""
    words = _makers_of(parsed, "words", rows).withColumnRenamed("token", "word")
    makers = parsed.filter("maker is not null").select(F.col("maker").alias("word")).distinct()
    rare = (F.col("df") <= RARE_ROWS) & (F.col("makers") <= FEW_MAKERS * F.col("known"))
    return words.filter((F.col("df") > 1) & (F.col("one_maker") | rare)).join(makers, "word", "left_anti").select("word", "df")


def _makers_of(parsed: DataFrame, column: str, rows: int) -> DataFrame:
    """``token, df, known, makers, one_maker`` of the tokens in an array column: listings, those with a maker, makers.

    ``one_maker``: the maker with most of them has a share as far above its share of all listings as ``ONE_MAKER`` is above none.
    """
    sizes = parsed.groupBy("maker").agg((F.count(F.lit(1)) / F.lit(max(rows, 1))).alias("share"))
    by_maker = parsed.select("maker", F.explode(column).alias("token")).groupBy("token", "maker").agg(F.count(F.lit(1)).alias("n"))
    shared = by_maker.join(sizes, by_maker["maker"].eqNullSafe(sizes["maker"]), "left").select("token", by_maker["maker"], "n", "share")
    known = F.when(F.col("maker").isNotNull(), F.col("n"))
    best = F.max(F.when(F.col("maker").isNotNull(), F.struct("n", (-F.col("share")).alias("low"))))
    tokens = shared.groupBy("token").agg(F.sum("n").alias("df"), F.coalesce(F.sum(known), F.lit(0)).alias("known"), best.alias("best"), F.count("maker").alias("makers"))
    top, base = F.coalesce("best.n", F.lit(0)), F.coalesce(-F.col("best.low"), F.lit(0.0))
    # The maker's own share counts where words are frequent enough to show it, and not in a table of one maker.
    needed = F.when((F.col("df") > RARE_ROWS) & (base < 1), ONE_MAKER + (1 - ONE_MAKER) * base).otherwise(F.lit(ONE_MAKER))
    return tokens.select("token", "df", "known", "makers", (top >= needed * F.col("known")).alias("one_maker"))


def _variants(parsed: DataFrame, lines: DataFrame) -> DataFrame:
    """``word, against``: words that name different variants, with the words each excludes.

    Blocks are the listings with one line word and the same facts. Two words of a block exclude each other if each stands
    in at least two of its listings and ``VARIANT_SHARE`` of them, but, over all listings, they stand together in at most
    ``EXCLUSIVE`` of the rarer one's listings and beside the same codes as rarely: words of one meaning ("granate",
    "burgundy") share codes, freely added ones share listings.
    """
    makers = parsed.filter("maker is not null").select(F.col("maker").alias("word")).distinct()
    worded = parsed.select("listing_id", "facts", F.explode("words").alias("word")).join(makers, "word", "left_anti")
    common = cut(worded.groupBy("word").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"))
    keyed = worded.join(lines.select("word"), "word").select("listing_id", "facts", F.col("word").alias("line"))
    size = keyed.groupBy("facts", "line").agg(F.count(F.lit(1)).alias("size")).filter("size > 3")
    in_block = keyed.join(size, ["facts", "line"]).join(worded.select("listing_id", "word"), "listing_id").groupBy("facts", "line", "size", "word").agg(F.count(F.lit(1)).alias("n"))
    divides = (F.col("n") > 1) & (F.col("n") >= VARIANT_SHARE * F.col("size")) & (F.col("n") <= F.col("size") - 2)
    split = cut(in_block.filter(divides).select("facts", "line", "word"))
    other = split.withColumnRenamed("word", "other")
    pairs = cut(split.join(other, ["facts", "line"]).filter("word < other").select("word", "other").distinct())
    members = cut(pairs.select("word").union(pairs.select("other")).distinct())
    asked = parsed.select("listing_id", "codes", F.explode("words").alias("word")).join(members, "word")

    def together(rows: DataFrame, key: str, name: str) -> DataFrame:
        """How many values of ``key`` both words of a pair have."""
        counted = rows.join(rows.withColumnRenamed("word", "other"), key).filter("word < other")
        return counted.join(pairs, ["word", "other"], "left_semi").groupBy("word", "other").agg(F.count(F.lit(1)).alias(name))

    coded = cut(asked.select(F.explode("codes").alias("code"), "word").distinct())
    code_df = coded.groupBy("word").agg(F.count(F.lit(1)).alias("codes"))
    seen = members.join(common, "word").join(code_df, "word", "left").select("word", "df", F.coalesce("codes", F.lit(0)).alias("codes"))
    both = pairs.join(seen, "word").join(seen.toDF("other", "other_df", "other_codes"), "other")
    both = both.join(together(asked.select("listing_id", "word"), "listing_id", "met"), ["word", "other"], "left").join(together(coded, "code", "shared"), ["word", "other"], "left")
    apart = F.coalesce("met", F.lit(0)) <= EXCLUSIVE * F.least("df", "other_df")
    meant = F.coalesce("shared", F.lit(0)) <= EXCLUSIVE * F.least("codes", "other_codes")
    found = cut(both.filter(apart & meant).select("word", "other"))
    return found.union(found.select("other", "word")).groupBy("word").agg(F.collect_set("other").alias("against"))


def _with_variants(parsed: DataFrame, lines: DataFrame) -> DataFrame:
    """``listing_id, variants, against``: the words of a listing that name a variant, and those its variant excludes."""
    known = cut(_variants(parsed, lines))
    side = F.broadcast(known) if known.count() <= BROADCAST_WORDS // 10 else known
    named = parsed.select("listing_id", F.explode("words").alias("word")).join(side, "word")
    held = named.groupBy("listing_id").agg(F.array_sort(F.collect_set("word")).alias("variants"), F.array_distinct(F.flatten(F.collect_list("against"))).alias("against"))
    return held.select("listing_id", "variants", F.array_sort(F.array_except("against", "variants")).alias("against"))


def _tokens(parsed: DataFrame, rows: int) -> DataFrame:
    """``listing_id, facts, maker, tokens, variants, against``: identifying tokens from the rarest on, each with its weight."""
    lines = cut(_line_words(parsed, rows))
    side = F.broadcast(lines) if lines.count() <= BROADCAST_WORDS else lines
    weight = F.log(F.lit(float(rows + 1)) / F.col("df"))
    words = parsed.select("listing_id", F.explode("words").alias("word")).join(side, "word").select("listing_id", F.struct(F.col("df"), F.concat(F.lit("w:"), "word").alias("token"), weight.alias("weight")).alias("t"))
    coded = parsed.select("listing_id", F.explode("codes").alias("code"))
    makers = _makers_of(parsed, "codes", rows)  # a standard's number ("CR2032") stands with many makers and names no model
    known = makers.filter(F.col("one_maker") | (F.col("df") <= RARE_ROWS)).select(F.col("token").alias("code"), "df")
    codes = coded.join(known, "code").select("listing_id", F.struct(F.col("df"), F.concat(F.lit("c:"), "code").alias("token"), (CODE_WEIGHT * weight).alias("weight")).alias("t"))
    sets = words.unionAll(codes).groupBy("listing_id").agg(F.array_sort(F.collect_list("t")).alias("tokens"))
    variants = _with_variants(parsed, lines)
    return parsed.select("listing_id", "facts", "maker").join(sets, "listing_id", "left").join(variants, "listing_id", "left")


def _weight(tokens: str) -> object:
    return F.aggregate(tokens, F.lit(0.0), lambda a, t: a + t["weight"])


def same_product_edges(classes: DataFrame, contained: float = CONTAINED, hot_block: int = HOT_BLOCK) -> DataFrame:
    """``a, b`` of classes (``class_id, facts, maker, tokens, variants, against``) of which the lighter stands in the other by at least ``contained``.

    The lighter class probes with its prefix: its rarest tokens up to the point where those left weigh less than
    ``contained`` of the set, so that a match must share one of them. Only heavier classes are looked at (length filter),
    and only where the weight left from the common token on can still suffice on either side (positional filter). Up to
    here only numbers move; the sets are fetched for the pairs left, and compared. Blocks of one token and the same facts
    with more than ``hot_block`` classes are split over several tasks.
    """
    sized = cut(classes.withColumn("total", _weight("tokens")))
    each = sized.select("class_id", "facts", "total", F.posexplode("tokens").alias("at", "t"), "tokens").select(
        "class_id", "facts", "total", F.col("t.token").alias("token"), _weight(F.slice("tokens", F.col("at") + 1, F.size("tokens"))).alias("rest")
    )
    blocks = each.groupBy("facts", "token").agg(F.ceil(F.count(F.lit(1)) / hot_block).cast("int").alias("parts"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    each = each.join(blocks, ["facts", "token"])
    probe = each.filter(F.col("rest") >= contained * F.col("total") - 1e-9).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    heavy = each.select(F.col("class_id").alias("b"), "facts", "token", F.pmod(F.xxhash64("class_id"), F.col("parts")).cast("int").alias("part"), F.col("total").alias("b_total"), F.col("rest").alias("b_rest"))
    met = probe.select(F.col("class_id").alias("a"), "facts", "token", "part", "total", "rest").join(heavy, ["facts", "token", "part"])
    lighter = (F.col("total") < F.col("b_total")) | ((F.col("total") == F.col("b_total")) & (F.col("a") < F.col("b")))
    possible = F.least("rest", "b_rest") >= contained * F.col("total") - 1e-9
    pairs = met.filter((F.col("a") != F.col("b")) & lighter & possible).select("a", "b").distinct()
    sets = sized.select("class_id", "maker", "tokens", "total", "variants", "against")
    both = pairs.join(sets.withColumnRenamed("class_id", "a"), "a").join(sets.select(F.col("class_id").alias("b"), F.col("maker").alias("b_maker"), F.col("tokens").alias("b_tokens"), F.col("variants").alias("b_variants")), "b")
    names = F.transform("b_tokens", lambda t: t["token"])
    shared = F.aggregate(F.filter("tokens", lambda t: F.array_contains(names, t["token"])), F.lit(0.0), lambda s, t: s + t["weight"])
    coded = F.exists("tokens", lambda t: t["token"].startswith("c:") & F.array_contains(names, t["token"]))
    near = F.levenshtein("maker", "b_maker", 2).between(0, 1) | (F.array_sort(F.split("maker", "")) == F.array_sort(F.split("b_maker", "")))  # one letter, or two swapped
    one_maker = F.col("maker").isNull() | F.col("b_maker").isNull() | near
    one_variant = ~F.coalesce(F.arrays_overlap("against", "b_variants"), F.lit(False))
    return both.filter((coded | (one_maker & one_variant)) & (shared >= contained * F.col("total") - 1e-9)).select("a", "b")


def star_clusters(edges: DataFrame) -> DataFrame:
    """``class_id, centre``: in rounds, every class with more neighbours than any free neighbour becomes a centre, and its
    free neighbours its satellites (of several centres they take the one with most neighbours). Ties go to the lower id.

    Every round settles at least the first of the free classes, and rounds go on until none is free. Edges of a class with
    itself, or with a null, are ignored.
    """
    edges = edges.filter("a <> b")
    both = cut(edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    degree = both.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    rank = degree.select(F.col("a").alias("class_id"), F.struct(F.col("n"), (-F.col("a")).alias("low")).alias("rank"))
    free = cut(both.join(rank.withColumnRenamed("class_id", "a").withColumnRenamed("rank", "rank_a"), "a").join(rank.withColumnRenamed("class_id", "b").withColumnRenamed("rank", "rank_b"), "b"))
    done: DataFrame | None = None
    nodes = cut(rank)
    for round_no in itertools.count(1):
        top = free.groupBy("a").agg(F.max("rank_b").alias("best"))
        centres = nodes.join(top, nodes["class_id"] == top["a"], "left").filter(F.col("best").isNull() | (F.col("rank") > F.col("best"))).select("class_id")
        taken = free.join(centres.withColumnRenamed("class_id", "b"), "b").groupBy("a").agg(F.max("rank_b").alias("best")).select(F.col("a").alias("class_id"), (-F.col("best.low")).alias("centre"))
        round_ = cut(centres.select("class_id", F.col("class_id").alias("centre")).unionAll(taken))
        done = round_ if done is None else done.unionAll(round_)
        if round_no % COMPACT_ROUNDS == 0:
            done = cut(done.coalesce(8))
        gone = round_.select("class_id")
        nodes = cut(nodes.join(gone, "class_id", "left_anti"))
        if not nodes.take(1):
            return done
        free = cut(free.join(gone.withColumnRenamed("class_id", "a"), "a", "left_anti").join(gone.withColumnRenamed("class_id", "b"), "b", "left_anti"))


def group_listings(listings: DataFrame, contained: float = CONTAINED) -> DataFrame:
    """``listing_id, class_id, group_id``: listings of one product share ``group_id`` (a listing's id), exact equals ``class_id``.

    Of several rows of a listing the one ingested last holds; rows without ``listing_id`` are left out. A listing without
    identifying tokens (null or empty title, no code and no line) is a group of its own. A null brand names no maker.
    Extra columns are ignored; an empty table gives an empty result.
    """
    rows = listings.select(F.col("listing_id").cast("string").alias("listing_id"), "title", "brand", "ingested_at")
    latest = latest_rows(rows, "listing_id", "ingested_at").select(F.col("listing_id").cast("bigint").alias("listing_id"), "title", "brand")
    parsed = cut(latest.mapInPandas(_parse, "listing_id bigint, maker string, facts string, codes array<string>, words array<string>"))
    parsed = cut(_with_title_makers(parsed))
    sets = cut(_tokens(parsed, parsed.count()))
    named = F.array_join(F.transform("tokens", lambda t: t["token"]), " ")
    varied = F.array_join(F.coalesce("variants", F.array().cast("array<string>")), " ")
    keyed = sets.withColumn("key", F.when(F.size("tokens") > 0, F.sha2(F.concat_ws("|", F.col("facts"), F.coalesce("maker", F.lit("")), named, varied), 256)))
    carried = [F.first(c).alias(c) for c in ("facts", "maker", "tokens", "variants", "against")]  # alike in all listings of a class
    classes = cut(keyed.filter("key is not null").groupBy("key").agg(F.min("listing_id").alias("class_id"), *carried))
    stars = star_clusters(same_product_edges(classes, contained))
    grouped = classes.select("key", "class_id").join(stars, "class_id", "left").select("key", "class_id", F.coalesce("centre", "class_id").alias("group_id"))
    return keyed.select("listing_id", "key").join(grouped, "key", "left").select("listing_id", F.coalesce("class_id", "listing_id").alias("class_id"), F.coalesce("group_id", "listing_id").alias("group_id"))


def same_product_pairs(groups: DataFrame) -> DataFrame:
    """``listing_a, listing_b``: all pairs of different listings of a group."""
    a, b = groups.select("group_id", F.col("listing_id").alias("listing_a")), groups.select("group_id", F.col("listing_id").alias("listing_b"))
    return a.join(b, "group_id").filter("listing_a < listing_b").select("listing_a", "listing_b")
