"""Dotted IPv4 validity, as a JVM-side regex (no Python in the hot path).

Rule: not empty, exactly four parts split on '.', each an integer 0..255, no trailing dot. Parts are
parsed like Java's ``Integer.parseInt``: leading zeros and a '+' sign are accepted, and "-0" is zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:\+?0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])|-0+)"
IPV4_PATTERN = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def is_valid_ipv4(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    # `$` in Java also matches before a final line break; exclude line breaks explicitly
    return F.coalesce(col.rlike(IPV4_PATTERN) & ~col.contains("\n"), F.lit(False))
