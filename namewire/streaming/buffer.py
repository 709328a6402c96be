"""The bounded buffer of highest counts as a stateful processor."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from namewire.operators.bounded import BUCKETS, CAPACITY, bucket_of
from namewire.session import use_rocksdb_state
from namewire.streaming.trailing import live_trailing_counts

SCHEMA = "bucket int, seq bigint, step bigint, name string, cnt bigint, evicted boolean"


class BoundedBuffer(StatefulProcessor):
    """One bucket's buffer of at most ``capacity`` names.

    A known name takes its new count; a new one enters while there is room, or else replaces the
    least count if it is strictly greater, and the replaced name is told as 0. The buffer is a map
    in the state store, read once a micro-batch; only names that changed are written back. The
    running number of the bucket's changes is kept beside it.
    """

    def __init__(self, capacity: int = CAPACITY):
        self.capacity = capacity

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buffer = handle.getMapState(
            "buffer", StructType([StructField("name", StringType())]), StructType([StructField("cnt", LongType())]))
        self.steps = handle.getValueState("steps", StructType([StructField("step", LongType())]))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = {k[0]: v[0] for k, v in self.buffer.iterator()} if self.buffer.exists() else {}
        step = self.steps.get()[0] if self.steps.exists() else 0
        held, least = dict(before), None
        for row in sorted(rows, key=lambda r: (r.seq, r.name)):
            if row.name not in held and len(held) >= self.capacity:
                if least is None:
                    least = min(held.items(), key=lambda e: (e[1], e[0]))
                if row.cnt <= least[1]:
                    continue
                del held[least[0]]
                yield Row(bucket=key[0], seq=row.seq, step=step, name=least[0], cnt=0, evicted=True)
                step += 1
            held[row.name] = row.cnt
            least = None
            yield Row(bucket=key[0], seq=row.seq, step=step, name=row.name, cnt=row.cnt, evicted=False)
            step += 1
        for name in before.keys() - held.keys():
            self.buffer.removeKey((name,))
        for name, cnt in held.items():
            if before.get(name) != cnt:
                self.buffer.updateValue((name,), (cnt,))
        self.steps.update((step,))

    def close(self) -> None:
        pass


def live_bounded_topk(
    updates: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS, bucket: Column | None = None,
    output_mode: str = "update",
) -> DataFrame:
    """Changelog (bucket, seq, step, name, cnt, evicted) of a running buffer of ``capacity`` names a bucket.

    Updates (seq, name, cnt) of a micro-batch are applied in ``seq`` order, then by name; micro-batches must
    follow one another in ``seq``, as a topic's do. Names are hashed over ``buckets``, or dealt by ``bucket``, an
    integer that depends on ``name`` alone. The number of buckets is fixed by the checkpoint, so it doesn't follow the size of
    the cluster. A task holds one bucket's updates of one micro-batch and its buffer. Rows without a name drop out.
    """
    use_rocksdb_state(updates.sparkSession)
    dealt = bucket_of(buckets) if bucket is None else bucket.cast("int")
    rows = updates.where("name is not null").select(
        dealt.alias("bucket"), F.col("seq").cast("bigint").alias("seq"), "name", F.col("cnt").cast("bigint").alias("cnt"))
    return rows.groupBy("bucket").transformWithState(BoundedBuffer(capacity), SCHEMA, output_mode, "None")


def live_top_of_hour(
    mentions: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS, late: str = "10 minutes",
) -> DataFrame:
    """Changelog of the buffer of names by their mentions in the last hour, straight from mentions (ts, name), in one query.

    ``seq`` is the tick in epoch seconds. The state of the counts and that of the buffers live in one
    checkpoint. Run it in append mode.
    """
    counts = live_trailing_counts(mentions, late=late)
    updates = counts.select(F.unix_seconds("tick").alias("seq"), "name", "cnt")
    return live_bounded_topk(updates, capacity, buckets, output_mode="append")
