"""Hex text <-> 64-bit hash (P3, P4) and Hamming distance (M1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a hex hash is at most 16 significant digits, leading zeros allowed.
HEX_HASH_PATTERN = "^0*[0-9a-fA-F]{1,16}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_hex_hash(c) -> Column:
    """Base-16 text -> BIGINT bits of the unsigned value; NULL when invalid.

    The pattern guard is needed: ``conv`` parses a valid prefix and overflows on
    long input.
    """
    s = _col(c)
    return F.when(s.rlike(HEX_HASH_PATTERN),
                  F.conv(s, 16, -10).cast("bigint"))


def format_hex_hash(c) -> Column:
    """Lower-case hex of the unsigned value, no padding (Go ``%x``)."""
    return F.lower(F.hex(_col(c)))


def hamming(a, b) -> Column:
    """M1: number of differing bits of two 64-bit values."""
    return F.bit_count(_col(a).bitwiseXOR(_col(b))).cast("int")
