"""Piecewise linear interpolation of series on an even grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def _segments(knots: DataFrame, x: str, y: str, by: list[str], width: float) -> DataFrame:
    """Segments (x0, y0, x1, y1) with the ends (_lo, _hi) of their series."""
    blocks = knots.select(
        *by, F.col(x).cast("double").alias("x0"), F.col(y).cast("double").alias("y0"),
        F.floor(F.col(x) / F.lit(float(width))).alias("_block"),
    )
    heads = blocks.groupBy(*by, "_block").agg(
        F.min("x0").alias("_x"), F.min_by("y0", "x0").alias("_y"), F.max("x0").alias("_last"))
    series = Window.partitionBy(*by)
    head = F.struct(F.col("_x").alias("x0"), F.col("_y").alias("y0"))
    heads = heads.select(
        *by, "_block", F.lead(head).over(series.orderBy("_block")).alias("_next"),
        F.min("_x").over(series).alias("_lo"), F.max("_last").over(series).alias("_hi"),
    )
    own = F.struct("x0", "y0")
    inside = F.lead(own).over(Window.partitionBy(*by, "_block").orderBy("x0"))
    return (
        blocks.withColumn("_inside", inside)
        .join(heads, [*by, "_block"])
        .withColumn("_to", F.coalesce("_inside", "_next", own))
        .select(*by, "x0", "y0", F.col("_to.x0").alias("x1"), F.col("_to.y0").alias("y1"), "_lo", "_hi")
    )


def knot_segments(
    knots: DataFrame, x: str = "x", y: str = "y", by: list[str] | None = None, width: float = 1 << 20,
) -> DataFrame:
    """(x0, y0, x1, y1) between neighbouring knots; the last knot is a segment of its own.

    Neighbours are found inside ``width``-wide blocks of x; the first knot of each
    block, one row a block, closes the gaps. A long series is thus never in one task.
    Places are distinct within a series.
    """
    return _segments(knots, x, y, by or [], width).drop("_lo", "_hi")


def interpolate(
    knots: DataFrame, num: int = 1001, x: str = "x", y: str = "y", by: list[str] | None = None,
    width: float = 1 << 20,
) -> DataFrame:
    """``num`` evenly spaced points from the first to the last knot of each series.

    Every segment makes its own grid points, so there is no range join.
    """
    by = by or []
    segments = _segments(knots, x, y, by, width)
    lo, hi, step = F.col("_lo"), F.col("_hi"), F.col("_step")
    first = F.ceil((F.col("x0") - lo) / step)
    after = F.when(F.col("x1") == hi, F.when(F.col("x0") == hi, num).otherwise(num - 1)).otherwise(
        F.least(F.ceil((F.col("x1") - lo) / step), F.lit(num - 1))
    )
    first = F.when(F.col("x0") == hi, num - 1).otherwise(first)
    span = F.nullif(F.col("x1") - F.col("x0"), F.lit(0.0))
    slope = F.coalesce((F.col("y1") - F.col("y0")) / span, F.lit(0.0))
    return (
        segments.withColumn("_step", F.nullif((hi - lo) / F.lit(float(num - 1)), F.lit(0.0)))
        .withColumn("_first", first.cast("bigint")).withColumn("_after", after.cast("bigint"))
        .where("_after > _first")
        .withColumn("i", F.explode(F.sequence(F.col("_first"), F.col("_after") - 1)))
        .withColumn("x", F.when(F.col("i") == num - 1, hi).otherwise(lo + F.col("i") * step))
        .select(*by, "i", "x", (F.col("y0") + (F.col("x") - F.col("x0")) * slope).alias("y"))
    )


def even_grid(bounds: DataFrame, lo: str, hi: str, num: int = 1001) -> DataFrame:
    """``num`` evenly spaced places per row of bounds, both ends included."""
    step = (F.col(hi) - F.col(lo)) / F.lit(float(num - 1))
    place = F.when(F.col("i") == num - 1, F.col(hi)).otherwise(F.col(lo) + F.col("i") * step)
    return bounds.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(num - 1)))).withColumn("x", place)
