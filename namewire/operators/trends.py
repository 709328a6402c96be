"""Least-squares fits, each one aggregation, and their extrapolation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def linear_trend(points: DataFrame, x: str = "x", y: str = "y", by: list[str] | None = None) -> DataFrame:
    """Intercept ``c0`` and slope ``c1`` of the straight line."""
    return points.groupBy(*(by or [])).agg(
        F.regr_intercept(y, x).alias("c0"), F.regr_slope(y, x).alias("c1")
    )


def quadratic_trend(points: DataFrame, x: str = "x", y: str = "y", by: list[str] | None = None) -> DataFrame:
    """Coefficients of ``c0 + c1 x + c2 x^2``.

    Works on central moments, which Spark merges stably from partial aggregates:
    with u = x - mean(x), the normal equations reduce to a 2 x 2 system in
    cov(u, y) and cov(u^2, y).
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    m = points.where(both).groupBy(*(by or [])).agg(
        F.avg(xd).alias("mx"), F.avg(yd).alias("my"),
        F.var_pop(xd).alias("s2"), F.skewness(xd).alias("skew"), F.kurtosis(xd).alias("kurt"),
        F.covar_pop(xd, yd).alias("cxy"), F.covar_pop(xd * xd, yd).alias("cxxy"),
    )
    s2, mx = F.col("s2"), F.col("mx")
    s3 = F.col("skew") * F.pow(s2, 1.5)
    s4 = (F.col("kurt") + 3) * s2 * s2
    cuuy = F.col("cxxy") - 2 * mx * F.col("cxy")
    a = (cuuy * s2 - F.col("cxy") * s3) / F.nullif(s4 * s2 - s2 * s2 * s2 - s3 * s3, F.lit(0.0))
    fitted = m.withColumn("_a", a).withColumn("_b", (F.col("cxy") - F.col("_a") * s3) / F.nullif(s2, F.lit(0.0)))
    a, b = F.col("_a"), F.col("_b")
    return fitted.select(
        *(by or []),
        (F.col("my") - a * s2 - b * mx + a * mx * mx).alias("c0"),
        (b - 2 * a * mx).alias("c1"),
        a.alias("c2"),
    )


def predict(trend: DataFrame, xs: list[float] | Column, by: list[str] | None = None) -> DataFrame:
    """(x, predicted) of a fitted trend at the given places."""
    places = xs if isinstance(xs, Column) else F.array(*[F.lit(float(v)) for v in xs])
    value = F.col("c0") + F.col("c1") * F.col("x")
    if "c2" in trend.columns:
        value = value + F.col("c2") * F.col("x") * F.col("x")
    return trend.withColumn("x", F.explode(places)).select(*(by or []), "x", value.alias("predicted"))
