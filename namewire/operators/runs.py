"""Run times and what the runs cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from namewire.operators.asof import asof_join, integrate_over
from namewire.operators.sizing import lookup_join


def run_times(stages: DataFrame) -> DataFrame:
    """Run time as the sum of the stage times, in seconds."""
    return stages.groupBy("run_id").agg(F.sum("stage_seconds").alias("run_seconds"))


def run_cost(runs: DataFrame, prices: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Cost = run time (minutes) x instances x hourly price of the type."""
    priced = lookup_join(runs, prices, on or ["instance_type"])
    cost = F.col("runtime_min") / 60 * F.col("instances") * F.col("price")
    return priced.withColumn("cost", cost)


def cost_at_start(runs: DataFrame, prices: DataFrame, on: list[str] | None = None, tie: str | None = None) -> DataFrame:
    """The hourly price at each run's start (``started``) and the cost at that price; null before the first price."""
    priced = asof_join(runs, prices, on or ["instance_type", "zone"], "started", tie=tie)
    return priced.withColumn("cost", F.col("runtime_min") / 60 * F.col("instances") * F.col("price"))


def cost_over_prices(runs: DataFrame, prices: DataFrame, on: list[str] | None = None, tie: str | None = None) -> DataFrame:
    """The cost of each run from ``started`` to ``ended`` at the prices that held meanwhile.

    ``covered_hours`` is how much of the run lies after the first known price; the cost is that of these hours.
    """
    out = integrate_over(runs, prices, on or ["instance_type", "zone"], "started", "ended", tie=tie)
    return out.withColumn("cost", F.col("price_hours") * F.col("instances"))


def cheapest_config(costs: DataFrame) -> DataFrame:
    """Configuration of least mean cost for each data size."""
    config = ["data_size", "instance_type", "instances"]
    means = costs.groupBy(*config).agg(F.avg("cost").alias("cost"))
    best = F.min(F.struct("cost", "instance_type", "instances"))
    return means.groupBy("data_size").agg(best.alias("_b")).select(
        "data_size", "_b.instance_type", "_b.instances", "_b.cost"
    )


def scaling_ratio(runs: DataFrame, larger: str, smaller: str, by: list[str] | None = None) -> DataFrame:
    """Mean run time on the larger data over that on the smaller, per configuration."""
    def mean(size: str) -> Column:
        return F.avg(F.when(F.col("data_size") == size, F.col("runtime_min")))

    return runs.groupBy(*(by or ["instance_type", "instances"])).agg(
        mean(larger).alias("larger_min"), mean(smaller).alias("smaller_min")
    ).withColumn("ratio", F.col("larger_min") / F.nullif("smaller_min", F.lit(0.0)))
