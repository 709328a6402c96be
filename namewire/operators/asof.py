"""Values as of a time, and their integral over intervals, by blocks of time.

A series (all points of one key) may be of any length and hot. It is cut into blocks of
time. What a block needs from before it is its *head*: the last value of an earlier block. Heads
are carried over one row a key and block, never over the points themselves, so the tasks are
as many as there are blocks, and none sees a whole series.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from namewire.operators.sizing import lookup_join

HOUR = 3600
_MICRO = 1_000_000


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _block(at: Column, width: int) -> Column:
    return F.floor(at / F.lit(width * _MICRO)).cast("bigint")


def _known(by: list[str]) -> Column:
    return reduce(and_, (F.col(c).isNotNull() for c in by))


def _points(series: DataFrame, by: list[str], ts: str, value: str, tie: str | None, width: int) -> DataFrame:
    """(by, _at, _block, _value): one value a key and instant; of equal times the one of highest ``tie``, else the highest."""
    last = F.max_by(value, F.col(tie)) if tie else F.max(value)
    return (
        series.where(_known([*by, ts, value]))
        .groupBy(*by, _micros(ts).alias("_at")).agg(last.alias("_value"))
        .withColumn("_block", _block(F.col("_at"), width))
    )


def carried_heads(points: DataFrame, wanted: DataFrame, by: list[str]) -> DataFrame:
    """(by, _block, _head): for each wanted block the last value before it; null where there is none.

    Both sides come as one row a key and block, so the running value is over blocks.
    """
    ends = points.groupBy(*by, "_block").agg(F.max_by("_value", "_at").alias("_end"))
    rows = ends.unionByName(wanted.select(*by, "_block").distinct(), allowMissingColumns=True)
    rows = rows.groupBy(*by, "_block").agg(F.max("_end").alias("_end"))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select(*by, "_block", F.last("_end", ignorenulls=True).over(before).alias("_head"))


def asof_join(
    facts: DataFrame, series: DataFrame, by: list[str], at: str, ts: str = "ts", value: str = "price",
    name: str = "price", tie: str | None = None, width: int = HOUR,
) -> DataFrame:
    """Every row of ``facts`` with the last value of its key at or before its time (``name``).

    Null where the key has no point by then, or the row no time or key. ``width`` is the
    length of a block in seconds: a key's facts and points of one block meet in one task, and are sorted there.
    """
    points = _points(series, by, ts, value, tie, width)
    known = _known(by) & F.col(at).isNotNull()
    probes = facts.where(known).select(
        *by, _block(_micros(at), width).alias("_block"), _micros(at).alias("_at"), F.struct(*facts.columns).alias("_row"))
    heads = carried_heads(points, probes, by)
    # points stand before facts of the same time
    both = probes.withColumn("_side", F.lit(1)).unionByName(points.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    upto = Window.partitionBy(*by, "_block").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_last", F.last("_value", ignorenulls=True).over(upto)).where("_side = 1")
    found = inside.join(heads, [*by, "_block"], "left").select("_row.*", F.coalesce("_last", "_head").alias(name))
    kind = found.schema[name].dataType
    return found.unionByName(facts.where(~known).withColumn(name, F.lit(None).cast(kind)))


def integrate_over(
    intervals: DataFrame, series: DataFrame, by: list[str], start: str, end: str, ts: str = "ts",
    value: str = "price", integral: str = "price_hours", covered: str = "covered_hours", tie: str | None = None, width: int = HOUR,
) -> DataFrame:
    """Every row of ``intervals`` with the integral of its key's step function over ``[start, end)``, in value x hours.

    A point's value holds until the next point. ``covered`` is how many hours of the interval lie after the first
    point; both are 0 if none do, or if the interval is empty or lacks a key or an end.

    Intervals and the function's pieces are cut at block borders and joined on (key, block), an equality; the condition
    on times only drops pieces of the same block that do not meet. Blocks that an interval covers whole are
    taken from the block's own total, one row, so pieces are compared only at an interval's two ends.
    """
    size = width * _MICRO
    points = _points(series, by, ts, value, tie, width)
    # equal spans of a key have one integral
    span = [*by, "_start", "_end"]
    rows = intervals.withColumn("_start", _micros(start)).withColumn("_end", _micros(end))
    spans = rows.where(_known(by)).where("_start < _end").select(*span).distinct()
    first, last = _block(F.col("_start"), width), _block(F.col("_end") - 1, width)
    cut = spans.withColumn("_block", F.explode(F.sequence(first, last))).select(
        *span, "_block", F.greatest("_start", F.col("_block") * size).alias("_low"),
        F.least("_end", (F.col("_block") + 1) * size).alias("_high"))
    heads = carried_heads(points, cut, by)
    begins = heads.where("_head is not null").select(
        *by, "_block", (F.col("_block") * size).alias("_at"), F.col("_head").alias("_value"), F.lit(0).alias("_order"))
    steps = begins.unionByName(points.select(*by, "_block", "_at", "_value", F.lit(1).alias("_order")))
    after = Window.partitionBy(*by, "_block").orderBy("_at", "_order")
    pieces = steps.select(*by, "_block", "_value", F.col("_at").alias("_from"),
                          F.coalesce(F.lead("_at").over(after), (F.col("_block") + 1) * size).alias("_to")).where("_from < _to")
    area = F.sum((F.col("_to") - F.col("_from")) * F.col("_value")) / (HOUR * _MICRO)
    length = F.sum(F.col("_to") - F.col("_from")) / (HOUR * _MICRO)
    totals = pieces.groupBy(*by, "_block").agg(area.alias("_area"), length.alias("_length"))
    whole = (F.col("_high") - F.col("_low")) == size
    full = lookup_join(cut.where(whole), totals, [*by, "_block"]).select(*span, "_area", "_length")
    meet = cut.where(~whole).join(pieces, [*by, "_block"]).where("_from < _high and _to > _low")
    hours = (F.least("_to", "_high") - F.greatest("_from", "_low")) / (HOUR * _MICRO)
    edges = meet.select(*span, (hours * F.col("_value")).alias("_area"), hours.alias("_length"))
    sums = full.unionByName(edges).groupBy(*span).agg(F.sum("_area").alias("_area"), F.sum("_length").alias("_length"))
    out = rows.join(sums, span, "left")
    return out.select(*intervals.columns, F.coalesce("_area", F.lit(0.0)).alias(integral),
                      F.coalesce("_length", F.lit(0.0)).alias(covered))
