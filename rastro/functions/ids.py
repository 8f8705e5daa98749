"""Column functions that make identifiers and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"  # RFC 4122


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """The version-5 UUID of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "utf-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("bigint").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def fingerprint(*columns: Column) -> Column:
    """SHA-256 over values; null and the empty string differ, and no two different rows run together."""
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("~")) for c in columns]), 256)


def short_id(prefix: str, c: Column, size: int = 24) -> Column:
    """A prefix and the beginning of the SHA-256 of a text."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(c, 256), 1, size))


def placement_key(marketplace: Column, *parts: Column) -> Column:
    """The beginning of the SHA-1 of a marketplace and path parts."""
    return F.concat(F.lit("pl_"), F.substring(F.sha1(F.concat_ws("|", marketplace, *parts)), 1, 16))
