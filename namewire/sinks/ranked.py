"""Writing ranked names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_ranked(
    ranked: DataFrame, path: str, form: str = "json", mode: str = "overwrite",
    partition_by: list[str] | None = None,
) -> None:
    """Write rows as JSON lines, parquet, or text of one JSON object a line.

    ``mode='errorifexists'`` refuses an existing target, ``overwrite`` replaces it.
    """
    if form == "text":
        keys = partition_by or []
        ranked = ranked.select(F.to_json(F.struct("*")).alias("value"), *keys)
    writer = ranked.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(form).save(path)
