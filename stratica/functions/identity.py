"""Deterministic identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name space of URL-named UUIDs, RFC 9562 (fixed value).
URL_NAMESPACE_HEX = "6ba7b8119dad11d180b400c04fd430c8"
_VARIANT_NIBBLES = "89ab"


def uuid5(name: Column, namespace_hex: str = URL_NAMESPACE_HEX) -> Column:
    """RFC 9562 version-5 UUID of a text, computed in the JVM."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), name.cast("binary")))
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3)
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        F.substring(F.lit(_VARIANT_NIBBLES), variant + 1, F.lit(1)), F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )
