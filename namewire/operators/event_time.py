"""Event times spread evenly over the lines of a segment file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from namewire.functions.times import segment_start
from namewire.operators.sizing import lookup_join
from namewire.schema import SEGMENT_MINUTES


def assign_event_time(
    lines: DataFrame, minutes: int = SEGMENT_MINUTES, value: str = "value", consecutive: bool = False,
) -> DataFrame:
    """Adds ``position`` and ``event_time`` = segment start + position * (interval / lines).

    Takes (file, block, line_id, value): a block is a bounded run of a file's lines,
    blocks of a file are ordered, ``line_id`` orders the lines of a block. Counts per
    block give each block its offset in the file, so no task ever holds a file. With
    ``consecutive`` line ids (as ``read_placed_lines`` gives) the place in a block is
    a subtraction; otherwise it is ranked inside the block. A line outside the blocks
    that were counted raises an error.

    The start comes from the record id of the file's first line; seconds are ignored.
    It travels as the number yyyyMMddHHmm, which keeps the block summary a hash
    aggregation.
    """
    blocks = lines.groupBy("file", "block").agg(
        F.count("*").alias("_lines"),
        F.min("line_id").alias("_first_id"),
        F.max("line_id").alias("_last_id"),
        F.min_by(F.substring(value, 1, 12).try_cast("bigint"), F.col("line_id")).alias("_first_minute"),
    )
    in_file = Window.partitionBy("file")
    before = in_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select(
        "file", "block", "_first_id", "_last_id",
        F.coalesce(F.sum("_lines").over(before), F.lit(0).cast("bigint")).alias("_offset"),
        F.sum("_lines").over(in_file).alias("_total"),
        F.first("_first_minute").over(in_file.orderBy("block")).alias("_file_minute"),
    )
    if consecutive:
        # a second scan that cuts the files elsewhere must fail, not lose lines
        spots = lookup_join(lines, placed, ["file", "block"], how="left", max_bytes=256 << 20)
        inside = F.coalesce(F.col("line_id").between(F.col("_first_id"), F.col("_last_id")), F.lit(False))
        in_block = F.when(inside, F.col("line_id") - F.col("_first_id")).otherwise(F.raise_error(F.lit(
            "the splits of the files have moved between two scans; fix spark.sql.files.minPartitionNum")).cast("bigint"))
    else:
        rank = F.row_number().over(Window.partitionBy("file", "block").orderBy("line_id"))
        spots = lines.withColumn("_rank", rank - 1).join(placed, ["file", "block"])
        in_block = F.col("_rank")
    step = F.floor(F.lit(minutes * 60_000).cast("bigint") / F.col("_total"))
    start = F.unix_millis(segment_start(F.col("_file_minute").cast("string")))
    return (
        spots.withColumn("position", F.col("_offset") + in_block)
        .withColumn("event_time", F.timestamp_millis(start + F.col("position") * step))
        .drop("_offset", "_total", "_file_minute", "_first_id", "_last_id", "_rank")
    )
