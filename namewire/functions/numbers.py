"""Column functions on numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(c, base: float = 0.001, digits: int = 3) -> Column:
    """Nearest multiple of ``base`` (halves to even), then ``digits`` decimals."""
    return F.round(F.lit(base) * F.bround(_col(c) / F.lit(base), 0), digits)


def encode_long(c) -> Column:
    """Big-endian 8-byte form of a long, as message brokers carry it."""
    return F.unhex(F.lpad(F.hex(_col(c).cast("bigint")), 16, "0"))


def decode_long(c) -> Column:
    """Long out of its big-endian 8 bytes."""
    return F.conv(F.hex(_col(c)), 16, -10).cast("bigint")
