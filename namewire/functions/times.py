"""Column functions on publish times and segment boundaries. All times are UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from namewire.schema import (
    DAY_FORMAT, SEGMENT_EXTENSION, SEGMENT_FORMAT, SEGMENT_MINUTES, STAMP_FORMAT,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def publish_day(c) -> Column:
    """Day of a publish stamp as ``yyyyMMdd`` text; null where there is no such day."""
    day = F.substring(_col(c), 1, 8)
    return F.when(F.try_to_date(day, DAY_FORMAT).isNotNull(), day)


def publish_date(c) -> Column:
    """Day of a publish stamp as a DATE."""
    return F.try_to_date(F.substring(_col(c), 1, 8), DAY_FORMAT)


def publish_time(c, unit: str | None = None) -> Column:
    """Publish stamp as a timestamp, cut to ``unit`` (such as 'minute') where given."""
    ts = F.try_to_timestamp(_col(c), F.lit(STAMP_FORMAT))
    return F.date_trunc(unit, ts) if unit else ts


def epoch_floor(c, seconds: int) -> Column:
    """Epoch second of the start of the ``seconds``-wide slot that holds a timestamp."""
    epoch = F.unix_seconds(_col(c).cast("timestamp"))
    return epoch - F.pmod(epoch, F.lit(seconds).cast("bigint"))


def minute_shift(c, minutes) -> Column:
    """A timestamp moved by a number of minutes (literal or column)."""
    minutes = minutes if isinstance(minutes, Column) else F.lit(minutes)
    epoch = F.unix_seconds(_col(c).cast("timestamp"))
    return F.timestamp_seconds(epoch + minutes.cast("bigint") * 60)


def interval_floor(c, minutes: int = SEGMENT_MINUTES) -> Column:
    """Start of the interval inside the hour that holds a timestamp."""
    ts = _col(c).cast("timestamp")
    return minute_shift(F.date_trunc("minute", ts), -(F.minute(ts) % minutes))


def next_boundary(c, minutes: int = SEGMENT_MINUTES) -> Column:
    """Next multiple of ``minutes`` in the hour, strictly after the current minute.

    A multiple past the hour counts from the start of this hour.
    """
    ts = _col(c).cast("timestamp")
    ahead = F.ceil((F.minute(ts) + 1) / F.lit(minutes)) * minutes
    return minute_shift(F.date_trunc("hour", ts), ahead)


def segment_name(c, extension: str = SEGMENT_EXTENSION) -> Column:
    """File name of the segment that starts at a timestamp."""
    return F.concat(F.date_format(_col(c).cast("timestamp"), SEGMENT_FORMAT), F.lit(extension))


def segment_start(record_id) -> Column:
    """Start of a segment, to the minute, from a record id or a segment name."""
    return F.try_to_timestamp(F.substring(_col(record_id), 1, 12), F.lit("yyyyMMddHHmm"))
