"""Name-based identifiers computed with built-in hashing only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the URL namespace of RFC 4122, as hex digits.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column, namespace_hex: str = URL_NAMESPACE) -> Column:
    """RFC 4122 version 5 id of ``name``: SHA-1 with version and variant bits set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    high = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int")
    variant = F.lower(F.hex((high.bitwiseAND(3) + 8).cast("long")))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def millis(seconds: Column) -> Column:
    return F.round(seconds * 1000).cast("bigint")


def span_id(media_path: Column, start_s: Column, end_s: Column) -> Column:
    """Stable id of one time span of one file."""
    return uuid5(F.concat_ws("_", media_path, millis(start_s), millis(end_s)))
