"""Column functions on product and list addresses. URLs are taken as text: nothing is decoded, followed or guessed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOST = "www.tienda.example"
# Query parameters that only track.
TRACKING = ["ref", "ref_", "tag", "linkCode", "camp", "creative", "ascsubtag"]
_PRODUCT = r"/(?:dp|gp/product|gp/aw/d)/([A-Za-z0-9]{10})(?:[/?#]|$)"


def absolute(url: Column, host: str = HOST) -> Column:
    """A path completed to an address; missing stays null."""
    text = F.nullif(F.trim(url), F.lit(""))
    return F.when(F.startswith(text, F.lit("/")), F.concat(F.lit(f"https://{host}"), text)).otherwise(text)


def item_id(url: Column) -> Column:
    """The ten-character id of a product path, in upper case."""
    return F.nullif(F.upper(F.regexp_extract(url, _PRODUCT, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """The path of an address, without query and fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[a-z]+://[^/]*", "")


def query_of(url: Column) -> Column:
    """The query of an address; null if it has none."""
    return F.nullif(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))


def kept_query(url: Column) -> Column:
    """The query without tracking parameters, in its order."""
    tokens = F.filter(F.split(query_of(url), "&"), lambda t: ~F.substring_index(t, "=", 1).isin(TRACKING))
    return F.nullif(F.array_join(tokens, "&"), F.lit(""))


def page_url(url: Column, host: str = HOST) -> Column:
    """A list page's address: https and host, no ``/ref=`` part, tracking parameters or fragment."""
    path = F.regexp_replace(path_of(url), r"/ref=[^/]*", "")
    return F.concat(F.lit(f"https://{host}"), path, F.coalesce(F.concat(F.lit("?"), kept_query(url)), F.lit("")))


def product_url(url: Column, host: str = HOST) -> Column:
    """``normalized, reason, review_key`` of a product link: tracking dropped, unknown parameters and fragment kept."""
    full = absolute(url, host)
    known = F.regexp_extract(full, r"^https?://([^/?#]*)", 1).isin(host, host.removeprefix("www."))
    path = F.regexp_replace(path_of(full), r"/ref=[^/]*$", "")
    fragment = F.regexp_extract(full, r"(#.*)$", 1)
    normalized = F.concat(F.lit(f"https://{host}"), path, F.coalesce(F.concat(F.lit("?"), kept_query(full)), F.lit("")), fragment)
    reason = (
        F.when(full.isNull(), "PRODUCT_LINK_MISSING")
        .when(full.rlike(r"[\x00-\x20\x7f\\]"), "UNSAFE_URL_SYNTAX")
        .when(~known, "FOREIGN_HOST")
        .when(~path_of(full).rlike(r"/(?:dp|gp/product|gp/aw/d)/"), "NOT_PRODUCT_CARD_LINK")
    )
    return F.struct(F.when(reason.isNull(), normalized).alias("normalized"), reason.alias("reason"), F.when(reason.isNull(), F.coalesce(item_id(full), path)).alias("review_key"))


def link_status(url: Column, host: str = HOST) -> Column:
    """``UNIQUE_LINK``, or ``POSSIBLE_DUPLICATE`` where unknown parameters, a fragment or more path follow, or invalid."""
    full = absolute(url, host)
    rest = F.regexp_extract(F.regexp_replace(path_of(full), r"/ref=[^/]*$", ""), r"/(?:dp|gp/product|gp/aw/d)/[A-Za-z0-9]{10}(.*)$", 1)
    doubtful = kept_query(full).isNotNull() | F.contains(full, F.lit("#")) | (rest != "")
    return F.when(product_url(url, host)["reason"].isNotNull(), "INVALID_PRODUCT_LINK").when(F.coalesce(doubtful, F.lit(False)), "POSSIBLE_DUPLICATE").otherwise("UNIQUE_LINK")


def source_url(url: Column) -> Column:
    """A source without query, fragment, ``/ref=`` part, locale prefix and trailing slash."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"[?#].*$", ""), r"/ref=[^/]*", "")
    return F.regexp_replace(F.regexp_replace(bare, r"/-/[a-z]{2}/", "/"), r"/+$", "")


def list_type(url: Column) -> Column:
    """The kind of list a page shows."""
    return (
        F.when(F.contains(url, F.lit("/bestsellers")), "BEST_SELLERS").when(F.contains(url, F.lit("/new-releases")), "NEW_RELEASES").when(F.contains(url, F.lit("/movers-and-shakers")), "MOVERS_SHAKERS")
        .when(F.contains(url, F.lit("/most-wished-for")), "MOST_WISHED").when(F.contains(url, F.lit("/most-gifted")), "MOST_GIFTED").otherwise("UNKNOWN")
    )


def browse_node(url: Column) -> Column:
    """The last all-digit part of a path."""
    return F.nullif(F.regexp_extract(path_of(url), r"/(\d+)(?:/[^/]*)?/?$", 1), F.lit(""))


def page_number(url: Column) -> Column:
    """The ``pg`` parameter, at least 1; 1 if there is none."""
    return F.greatest(F.lit(1), F.coalesce(F.nullif(F.regexp_extract(url, r"[?&]pg=(\d+)", 1), F.lit("")).try_cast("int"), F.lit(1)))


def request_identity(url: Column) -> Column:
    """An address whose query parameters don't depend on their order; kept as it is if a parameter comes twice."""
    tokens = F.split(query_of(url), "&")
    keys = F.transform(tokens, lambda t: F.substring_index(t, "=", 1))
    sorted_ = F.concat(F.regexp_replace(url, r"[?#].*$", ""), F.lit("?"), F.array_join(F.array_sort(tokens), "&"))
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), sorted_).otherwise(url)


def first_page(url: Column) -> Column:
    """A list without its ``/ref=`` tail and page number: what all its pages share."""
    tokens = F.filter(F.split(query_of(url), "&"), lambda t: F.substring_index(t, "=", 1) != "pg")
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"/ref=[^/]*$", "")
    return F.concat(bare, F.coalesce(F.concat(F.lit("?"), F.nullif(F.array_join(tokens, "&"), F.lit(""))), F.lit("")))


def list_group(url: Column) -> Column:
    """The part of the path after the kind of list."""
    return F.nullif(F.regexp_extract(path_of(url), r"/bestsellers/([^/]+)", 1), F.lit(""))
