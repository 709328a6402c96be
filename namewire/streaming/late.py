"""Rows that come too late, kept aside instead of lost."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from namewire.session import use_rocksdb_state

LANES = 64
_AT, _LANE = "_at_ms", "_lane"


class LateMarker(StatefulProcessor):
    """Passes rows on, each marked with whether the watermark had already gone past its time; keeps no state."""

    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for row in rows:
            yield Row(**{c: row[c] for c in self.columns}, late=row[_AT] < watermark)

    def close(self) -> None:
        pass


def mark_late(events: DataFrame, ts: str = "ts", late: str = "1 day", lanes: int = LANES) -> DataFrame:
    """A stream's rows with a column ``late``: older than the watermark when they came.

    The watermark is ``late`` behind the newest time of the micro-batches before. Spark's own stateful
    operators drop what is older than that without a trace; so the time column is handed to the processor as a plain
    value. Rows are dealt over ``lanes`` by a hash of all their columns. Rows without a time are not late.
    """
    use_rocksdb_state(events.sparkSession)
    columns = [c for c in events.columns]
    plain = [F.timestamp_micros(F.unix_micros(F.col(c).cast("timestamp"))).alias(c) if c == ts else F.col(c) for c in columns]
    rows = events.withWatermark(ts, late).select(
        *plain, F.coalesce(F.unix_millis(F.col(ts).cast("timestamp")), F.lit((1 << 62))).alias(_AT),
        F.pmod(F.xxhash64(*columns), F.lit(lanes)).alias(_LANE))
    schema = StructType([*rows.select(*columns).schema.fields, StructField("late", BooleanType())])
    return rows.groupBy(_LANE).transformWithState(LateMarker(columns), schema, "Append", "EventTime")


def split_late(marked: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Write marked rows to ``path``/on_time and ``path``/late, a folder a micro-batch, each replaced as a whole if repeated."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        try:
            for folder, rows in (("on_time", batch.where("not late")), ("late", batch.where("late"))):
                rows.drop("late").write.mode("overwrite").parquet(f"{path}/{folder}/epoch={epoch}")
        finally:
            batch.unpersist()

    return (marked.writeStream.outputMode("append").trigger(**(trigger or {"processingTime": "1 second"}))
            .option("checkpointLocation", checkpoint).foreachBatch(write).start())
