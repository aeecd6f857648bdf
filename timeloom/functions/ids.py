"""Content-derived identifiers, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The UUID namespace for URLs (RFC 4122), as hex.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column) -> Column:
    """The name-based (SHA-1) UUID of a text in the URL namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12)
    )


def stable_id(prefix: str, *parts: Column) -> Column:
    """One id for equal parts; a null part counts as empty."""
    return uuid5(F.concat(F.lit(prefix), *[F.concat(F.lit("|"), F.coalesce(p.cast("string"), F.lit(""))) for p in parts]))


def file_artifact_id(kind: Column, path: Column, user: Column, device: Column) -> Column:
    return stable_id("tl-artifact", kind, path, user, device)
