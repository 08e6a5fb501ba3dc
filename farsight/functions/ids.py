"""Stable point ids: version-5 UUIDs as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DNS namespace of RFC 4122, in which point ids are made.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def point_id(original_id: Column) -> Column:
    """UUIDv5 of the id text; the same id always gives the same point."""
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(original_id, "UTF-8")))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )
