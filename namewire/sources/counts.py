"""A topic of (name, count) updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from namewire.functions.numbers import decode_long


def decode_counts(records: DataFrame) -> DataFrame:
    """(name, cnt) out of broker records: text key, 8-byte value."""
    keep = [c for c in ("partition", "offset", "timestamp") if c in records.columns]
    return records.select(
        F.col("key").cast("string").alias("name"), decode_long("value").alias("cnt"), *keep
    )


def stream_counts(
    spark: SparkSession,
    path: str | None = None,
    source: str = "kafka",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Count updates from a broker topic (latest offsets on) or from a folder of records."""
    if source == "kafka":
        settings = {"startingOffsets": "latest", **(options or {})}
        return decode_counts(spark.readStream.format("kafka").options(**settings).load())
    reader = spark.readStream.format(source).schema("key binary, value binary")
    return decode_counts(reader.options(**(options or {})).load(path))
