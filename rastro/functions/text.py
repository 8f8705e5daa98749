"""Column functions on text: invisible characters, blanks, accents, lookup keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their plain forms, position by position.
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüñçýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncyy"

_INVISIBLE = r"[­͏؜᠎​-‏‪-‮⁠-⁤⁦-⁯︀-️﻿]"
_BLANKS = r"[\s\u0085   -     　]+"


def drop_invisible(c: Column) -> Column:
    """Without zero-width, direction and joiner characters."""
    return F.regexp_replace(c, _INVISIBLE, "")


def one_space(c: Column) -> Column:
    """Every run of blanks, no-break ones included, as one space; trimmed."""
    return F.trim(F.regexp_replace(c, _BLANKS, " "))


def fold(c: Column) -> Column:
    """Lower case, Latin accents and combining marks removed, ordinal signs as letters."""
    low = F.translate(F.lower(c), ACCENTED + "ºª", PLAIN + "oa")
    return F.regexp_replace(low, r"[̀-ͯ]", "")


def clean(c: Column) -> Column:
    """Visible text with single spaces."""
    return one_space(drop_invisible(c))


def lookup_key(c: Column) -> Column:
    """Folded words and numbers with single spaces: what labels are looked up by."""
    return F.trim(F.regexp_replace(fold(clean(c)), r"[^\p{L}\p{N}]+", " "))


# ---- cleaning rules of catalogue fields ------------------------------------------------------------------------

NOISE = r"[\x{200B}-\x{200F}\x{2060}\x{FEFF}\x{202A}-\x{202E}\x{202F}\x{A0}]+"  # removed, not spaced, by strip_noise
# Words that no brand consists of, and the fixed spellings of known brands.
BRAND_STOP_WORDS = [
    "limpiador", "limpiadora", "barrera", "brazo", "sombrerete", "marca", "toallas", "renovador", "recambios", "lote", "desechable", "accesorio", "accesorios", "set", "pack", "paquete", "juego",
    "juegos", "bolsa", "caja", "recipiente", "recipientes", "universal", "portatil", "profesional",
]
BRAND_SPELLINGS = {"bissell": "BISSELL"}
# Product kinds by the words that announce them, first hit wins.
KINDS = [("freidora", "fryer"), ("almohada", "pillow"), ("cafe", "coffee"), ("vela", "candle"), ("sarten", "pan"), ("tabla", "board"), ("jarra", "jug"), ("manta", "blanket"), ("molde", "mould"), ("detergente", "detergent")]
# Words that tell languages apart; words that several languages share are in none of the lists.
LANGUAGE_WORDS = {
    "Spanish": ["el", "los", "las", "con", "muy", "agua", "cada", "para", "uso", "por"],
    "English": ["the", "with", "and", "very", "water", "each", "for", "is", "it", "of"],
    "Portuguese": ["os", "com", "muito", "água", "não", "uma", "dos", "são", "pelo", "chegou"],
}


def decimal_point(c: Column) -> Column:
    """A comma between two digits becomes a point."""
    return F.regexp_replace(c, r"(\d),(?=\d)", "$1.")


def strip_noise(c: Column) -> Column:
    """Without zero-width, direction, byte-order and no-break characters."""
    return F.regexp_replace(c, NOISE, "")


def collapse(c: Column) -> Column:
    """Runs of blanks as one space, trimmed; null stays null."""
    return F.trim(F.regexp_replace(c, r"[\s\x{85}\x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]+", " "))


def present(c: Column) -> Column:
    """Trimmed text; null for missing, that is null, empty or blank."""
    return F.nullif(F.trim(c), F.lit(""))


def text_or_empty(c: Column) -> Column:
    """Trimmed text; missing as the empty string."""
    return F.coalesce(F.trim(c), F.lit(""))


def clean_brand(c: Column) -> Column:
    """A brand without its shop or label prefix and noise; missing as the empty string."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(c), r"(?i)^visita\s+la\s+tienda\s+de\s+", ""), r"(?i)^marca:\s*", "")
    return F.coalesce(collapse(strip_noise(bare)), F.lit(""))


def brand_spelling(c: Column) -> Column:
    """The fixed spelling of a known brand; others as they are."""
    table = F.create_map(*[F.lit(x) for kv in BRAND_SPELLINGS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.lower(F.trim(c))), F.trim(c), F.lit(""))


def doubtful_brand(c: Column) -> Column:
    """Whether a brand holds a stop word or has more than four words."""
    stop = r"(?i)\b(" + "|".join(BRAND_STOP_WORDS) + r")\b"
    return F.coalesce(F.trim(c).rlike(stop) | (F.size(F.split(collapse(c), " ")) > 4), F.lit(False))


def label_name(c: Column) -> Column:
    """A label as a snake-case name: no accents, brackets as blanks, blanks, slashes and hyphens as one underscore."""
    bare = F.regexp_replace(fold(drop_invisible(c)), r"[()]", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(bare, r"[\s\x{A0}:/-]+", " ")), " ", "_")


def halves_once(c: Column) -> Column:
    """A text that is one text twice, as that text once."""
    half = (F.length(c) / 2).cast("int")
    twice = (F.length(c) % 2 == 0) & (F.length(c) > 0) & (F.substring(c, F.lit(1), half) == F.substring(c, half + 1, half))
    return F.when(twice, F.substring(c, F.lit(1), half)).otherwise(c)


def expand_collapsed(c: Column) -> Column:
    """(text, truncated) of ``"<full text> <beginning of it> Ver más"``: the full text if the beginning is one, else the rest."""
    rest = F.trim(F.regexp_replace(c, r"\s*Ver m[aá]s\s*$", ""))
    cut_at = F.filter(F.sequence(F.lit(1), F.greatest(F.length(rest), F.lit(1))), lambda i: (F.substring(rest, i, 1) == " ") & F.startswith(rest, F.substring(rest, i + 1, F.length(rest))) & (i < F.length(rest)))
    full = F.when(F.size(cut_at) > 0, F.substring(rest, F.lit(1), F.get(cut_at, 0) - 1)).otherwise(rest)
    return F.when(c.rlike(r"Ver m[aá]s\s*$"), F.struct(full.alias("text"), (F.size(cut_at) == 0).alias("truncated"))).otherwise(F.struct(c.alias("text"), F.lit(False).alias("truncated")))


def placeholder(c: Column) -> Column:
    """Whether a value states nothing."""
    return F.coalesce(F.rtrim(F.lower(F.trim(c)), F.lit(".")).isin("", "-", "—", "n/d", "n/a", "no aplicable", "desconocido", "consultar", "ver descripción", "null", "none", "{}", "[]"), F.lit(True))


def replace_terms(c: Column, terms: dict[str, str]) -> Column:
    """Whole words replaced by a dictionary, longest first."""
    for term in sorted(terms, key=lambda t: (-len(t), t)):
        c = F.regexp_replace(c, rf"(?i)(^|[^A-Za-z0-9]){term}($|[^A-Za-z0-9])", f"$1{terms[term]}$2")
    return c


def unit_once(c: Column) -> Column:
    """A unit written twice in a row, once."""
    out = c
    for unit in ("mAh", "kg", "ml", "cm", "mm"):
        out = F.regexp_replace(out, rf"{unit} {unit}\b", unit)
    return out


def codes_in(c: Column) -> Column:
    """Technical codes in a text: at least two capitals and four digits."""
    return F.regexp_extract_all(c, F.lit(r"([A-Z]{2}[ -]?[0-9]{4,}[ -]?[A-Z]?)"), 1)


def protect_codes(c: Column) -> Column:
    """``text, codes``: codes replaced by numbered marks, to be restored by :func:`restore_codes`."""
    codes = F.array_distinct(codes_in(c))
    return F.struct(
        F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(codes) - 1, F.lit(0))), c, lambda t, i: F.when(F.size(codes) > 0, F.replace(t, F.get(codes, i), F.concat(F.lit("__T"), F.lpad(i.cast("string"), 4, "0"), F.lit("__")))).otherwise(t)).alias("text"),
        codes.alias("codes"),
    )


def restore_codes(text: Column, codes: Column) -> Column:
    """Marks of :func:`protect_codes` replaced by their codes."""
    return F.aggregate(F.sequence(F.lit(0), F.greatest(F.size(codes) - 1, F.lit(0))), text, lambda t, i: F.when(F.size(codes) > 0, F.replace(t, F.concat(F.lit("__T"), F.lpad(i.cast("string"), 4, "0"), F.lit("__")), F.get(codes, i))).otherwise(t))


def language_name(c: Column) -> Column:
    """The language whose own words a text uses most; ``Mixed`` if a second one comes to half of it, ``Unknown`` without any."""
    words = F.array_distinct(F.filter(F.split(F.lower(c), r"[^a-záéíóúüñçãõâêôà]+"), lambda w: F.length(w) > 1))

    def scores(w: Column) -> Column:
        return F.array_sort(F.array(*[F.struct((-F.size(F.array_intersect(w, F.array(*map(F.lit, own))))).alias("n"), F.lit(name).alias("name")) for name, own in LANGUAGE_WORDS.items()]))

    def verdict(s: Column) -> Column:
        first, second = F.get(s, 0), F.get(s, 1)
        return F.when(first["n"] == 0, "Unknown").when((second["n"] <= -2) & (second["n"] * 2 <= first["n"]), "Mixed").otherwise(first["name"])

    # Arrays of one element bind the words and the scores, so that each is made once per row.
    scored = F.transform(F.array(words), scores)
    return F.when(c.isNull(), "Unknown").otherwise(F.get(F.transform(scored, verdict), 0))


def detail_rows(c: Column) -> Column:
    """Lines of a text as ``label, value`` split at the first colon; lines without one have a null value; repeated lines once."""
    lines = F.array_distinct(F.filter(F.transform(F.split(c, r"\n|; | / | \| "), lambda s: F.trim(s)), lambda s: s != ""))
    return F.transform(
        lines,
        lambda s: F.struct(
            F.when(F.contains(s, F.lit(":")), F.trim(F.substring_index(s, ":", 1))).otherwise(s).alias("label"),
            F.when(F.contains(s, F.lit(":")), F.trim(F.substring(s, F.instr(s, ":") + 1, F.length(s)))).alias("value"),
        ),
    )


def product_kind(c: Column) -> Column:
    """The first product kind whose word a text holds."""
    out, folded = F.lit(None).cast("string"), fold(c)
    for word, kind in reversed(KINDS):
        out = F.when(F.contains(folded, F.lit(word)), kind).otherwise(out)
    return out
