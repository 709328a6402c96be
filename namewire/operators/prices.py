"""Latest and cheapest prices, price series, and value for money."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from namewire.functions.text import leading_number

# Machine family by first letter of the type.
FAMILIES = {
    "c": "compute optimized",
    "m": "general purpose",
    "r": "memory optimized",
}


def family(instance_type) -> Column:
    """Family of a machine type; null for other letters."""
    letter = F.substring(instance_type, 1, 1)
    out = F.lit(None).cast("string")
    for key, label in FAMILIES.items():
        out = F.when(letter == key, label).otherwise(out)
    return out


def region_digit(zone) -> Column:
    """Region number in a zone name such as ``us-east-2a``: the last character but one."""
    text = F.col(zone) if isinstance(zone, str) else zone
    return F.substring(text, F.length(text) - 1, F.lit(1))


def latest_price(
    prices: DataFrame, order: str = "ts", by: list[str] | None = None, tie: str | None = None,
) -> DataFrame:
    """Last known price per (instance_type, zone); of equal times the highest ``tie`` counts.

    The latest time is found first and the tie settled among its rows, which keeps
    both steps hash aggregations.
    """
    keys = by or ["instance_type", "zone"]
    if tie is None:
        return prices.groupBy(*keys).agg(F.max_by("price", F.col(order)).alias("price"))
    same_time = prices.groupBy(*keys, order).agg(F.max_by("price", F.col(tie)).alias("price"))
    return same_time.groupBy(*keys).agg(F.max_by("price", F.col(order)).alias("price"))


def cheapest_zone(latest: DataFrame) -> DataFrame:
    """Cheapest zone of each type; equal prices go to the first zone name."""
    best = F.min(F.struct("price", "zone"))
    return latest.groupBy("instance_type").agg(best.alias("_best")).select(
        "instance_type", F.col("_best.zone").alias("zone"), F.col("_best.price").alias("min_price")
    )


def price_series(*regions: DataFrame) -> DataFrame:
    """Price points of several regions as one table, ordered by (type, zone, ts).

    The order is a range partitioning, so a long series spans several partitions.
    """
    merged = regions[0]
    for other in regions[1:]:
        merged = merged.unionByName(other)
    return (
        merged.select("instance_type", "zone", region_digit("zone").alias("region"), "ts", "price")
        .orderBy("instance_type", "zone", "ts", "price")
    )


def cost_efficiency(attributes: DataFrame, cheapest: DataFrame) -> DataFrame:
    """Memory and compute units per unit of the cheapest price; null on a zero price."""
    def per_price(c: str) -> Column:
        return leading_number(c) / F.nullif("min_price", F.lit(0.0))

    return attributes.join(cheapest, "instance_type").select(
        "instance_type", family("instance_type").alias("family"), "zone", "min_price",
        per_price("memory").alias("memory_efficiency"), per_price("ecu").alias("ecu_efficiency"),
    )
