"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from namewire.schema import FIELD_SEPARATOR, OFFSET_SEPARATOR


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_utf8(c) -> Column:
    """Drop bytes that are not UTF-8 (and any literal U+FFFD)."""
    return F.replace(F.make_valid_utf8(_col(c)), F.lit("�"), F.lit(""))


def line_field(line, position: int) -> Column:
    """Field of a line by position, without splitting what follows it."""
    return F.substring_index(F.substring_index(_col(line), FIELD_SEPARATOR, position + 1), FIELD_SEPARATOR, -1)


def record_key(line) -> Column:
    """First field of a line: the key under which it is published."""
    return F.substring_index(_col(line), FIELD_SEPARATOR, 1)


def mention_name(entry) -> Column:
    """Name in a ``name,offset`` entry: the text before the first comma."""
    return F.substring_index(_col(entry), OFFSET_SEPARATOR, 1)


def parse_record_id(c) -> Column:
    """``stamp-number`` as two longs; both 0 unless exactly two whole numbers.

    Trailing separators do not count as parts.
    """
    parts = F.split(F.regexp_replace(_col(c), "-+$", ""), "-", -1)

    def number(i: int) -> Column:
        part = F.get(parts, F.lit(i))
        return F.when(part.rlike(r"^\+?[0-9]+$"), part.try_cast("bigint"))

    stamp, serial = number(0), number(1)
    ok = F.coalesce((F.size(parts) == 2) & stamp.isNotNull() & serial.isNotNull(), F.lit(False))
    zero = F.lit(0).cast("bigint")
    return F.struct(
        F.when(ok, stamp).otherwise(zero).alias("stamp"),
        F.when(ok, serial).otherwise(zero).alias("serial"),
    )


NUMBER = r"^\s*([0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]*)?|\.[0-9]+)"


def leading_number(c) -> Column:
    """Number at the start of a text with a unit, with or without thousands separators; null where there is none."""
    return F.replace(F.regexp_extract(_col(c), NUMBER, 1), F.lit(","), F.lit("")).try_cast("double")
