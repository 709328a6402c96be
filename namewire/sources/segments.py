"""Which 15-minute segment files are expected, listed, new or missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from namewire.functions.times import interval_floor, minute_shift, segment_name
from namewire.schema import (
    FIRST_MARK, SEGMENT_EXTENSION, SEGMENT_MINUTES, SEGMENT_NAME_PATTERN, SEGMENT_PATH_PATTERN,
)


def manifest_entries(lines: DataFrame, value: str = "value") -> DataFrame:
    """Path and file name that each manifest line holds; other lines give none."""
    return (
        lines.withColumn("path", F.regexp_extract(value, SEGMENT_PATH_PATTERN, 0))
        .withColumn("file_name", F.regexp_extract(value, SEGMENT_NAME_PATTERN, 0))
        .where("path <> ''")
    )


def manifest_files(
    spark: SparkSession, manifest: str, count: int, local_folder: str | None = None
) -> DataFrame:
    """First ``count`` lines of a manifest as (path, file_name, local_path)."""
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")]
    head = (
        spark.read.text(manifest)
        .select("value", *[c.alias(f"p{i}") for i, c in enumerate(place)],
                F.monotonically_increasing_id().alias("p2"))
        .orderBy("p0", "p1", "p2")
        .limit(count)
    )
    local = F.concat_ws("/", F.lit(local_folder), "file_name") if local_folder else F.lit(None).cast("string")
    return manifest_entries(head).select("path", "file_name", local.alias("local_path"))


def list_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Files under a folder as (file_name, path); contents are not read."""
    return (
        spark.read.format("binaryFile").load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path")
    )


def expected_segments(
    clock: DataFrame,
    now: str = "now",
    window_minutes: int | Column = 60,
    minutes: int = SEGMENT_MINUTES,
    extension: str = SEGMENT_EXTENSION,
) -> DataFrame:
    """Segments of the look-back window up to the last completed one, per clock row."""
    window = window_minutes if isinstance(window_minutes, Column) else F.lit(window_minutes)
    last = minute_shift(interval_floor(now, minutes), -minutes)
    first = minute_shift(last, F.lit(minutes) - window)
    starts = F.when(first <= last, F.sequence(first, last, F.expr(f"interval {minutes} minutes")))
    return clock.select(F.explode(starts).alias("segment_start")).select(
        "segment_start", segment_name("segment_start", extension).alias("file_name")
    )


def new_segments(arrived: DataFrame, mark: str | Column = FIRST_MARK, file_name: str = "file_name") -> DataFrame:
    """Arrived files past the mark, each once, in name order."""
    mark = mark if isinstance(mark, Column) else F.lit(mark)
    return arrived.where(F.col(file_name) > mark).dropDuplicates([file_name]).orderBy(file_name)


def missing_segments(expected: DataFrame, arrived: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Expected segments that have not arrived."""
    return expected.join(arrived.select(file_name).distinct(), file_name, "left_anti")
