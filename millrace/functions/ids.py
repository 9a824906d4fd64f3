"""Name-based identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DNS namespace of RFC 4122.
DNS_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def uuid5_dns(name: Column) -> Column:
    """Version-5 UUID in the DNS namespace, from the JVM's own SHA-1."""
    digest = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE_HEX)), F.encode(name, "UTF-8")))
    variant = F.conv(F.substring(digest, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lower(F.hex(variant)), F.substring(digest, 19, 2)),
        F.substring(digest, 21, 12),
    )


def chunk_uuid(category: Column, content: Column) -> Column:
    return uuid5_dns(F.concat(category, F.lit("-"), content))
