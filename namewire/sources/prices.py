"""Price history of rented machines, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def price_history(
    prices: DataFrame,
    instance_types: list[str] | None = None,
    product: str | None = None,
    since=None,
    until=None,
    instance_type: str = "instance_type",
    product_column: str = "product",
    ts: str = "ts",
) -> DataFrame:
    """Prices of the given types and product from ``since`` up to ``until``.

    All conditions are plain comparisons, so they reach a columnar scan.
    """
    if instance_types is not None:
        prices = prices.where(F.col(instance_type).isin(instance_types))
    if product is not None:
        prices = prices.where(F.col(product_column) == product)
    if since is not None:
        prices = prices.where(F.col(ts) >= since)
    if until is not None:
        prices = prices.where(F.col(ts) < until)
    return prices
