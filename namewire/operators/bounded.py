"""A bounded buffer of counts, kept by arrival order."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

CAPACITY = 100
BUCKETS = 64  # of the result, so not a setting of the session; each is one sequential replay


def _buffer(capacity: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Replays sorted (bucket, is_update, seq, name, cnt) rows; memory is one buffer."""

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, held, least, step = None, {}, None, 0
        for batch in batches:
            out = []
            columns = (batch[c].tolist() for c in ("bucket", "is_update", "seq", "name", "cnt"))
            for b, is_update, seq, name, cnt in zip(*columns):
                if b != bucket:
                    bucket, held, least, step = b, {}, None, 0
                if not is_update:
                    held[name] = cnt
                    continue
                if name not in held and len(held) >= capacity:
                    if least is None:
                        least = min(held.items(), key=lambda e: (e[1], e[0]))
                    if cnt <= least[1]:
                        continue
                    del held[least[0]]
                    out.append((b, seq, step, least[0], 0, True))
                    step += 1
                held[name] = cnt
                least = None
                out.append((b, seq, step, name, cnt, False))
                step += 1
            yield pd.DataFrame(out, columns=["bucket", "seq", "step", "name", "cnt", "evicted"])

    return replay


def bucket_of(buckets: int) -> Column:
    """The bucket a name belongs to."""
    return F.pmod(F.xxhash64("name"), F.lit(buckets)).cast("int")


def bounded_topk(
    updates: DataFrame, state: DataFrame | None = None, capacity: int = CAPACITY, buckets: int = BUCKETS,
    bucket: Column | None = None,
) -> DataFrame:
    """Changelog (bucket, seq, step, name, cnt, evicted) of a buffer of ``capacity`` names a bucket.

    A known name takes its new count; a new one enters while there is room, or else
    replaces the least count if it is strictly greater, and the replaced name gets
    a 0. Of equal least counts the first name goes. ``state`` (name, cnt) is the
    buffer before the updates. ``step`` numbers the changes of a bucket.

    Updates (seq, name, cnt) are applied in ``seq`` order (then by name), one bucket after the other
    in a sorted stream of Arrow batches: a task holds one buffer, however many
    updates a bucket has. Names are hashed over ``buckets``,
    or dealt by ``bucket``, an integer that depends on ``name`` alone.
    """
    rows = updates.select("name", F.col("cnt").cast("bigint").alias("cnt"),
                          F.col("seq").cast("bigint").alias("seq"), F.lit(True).alias("is_update"))
    if state is not None:
        rows = rows.unionByName(state.select(
            "name", F.col("cnt").cast("bigint").alias("cnt"),
            F.lit(-1).cast("bigint").alias("seq"), F.lit(False).alias("is_update")))
    return (
        rows.withColumn("bucket", bucket_of(buckets) if bucket is None else bucket.cast("int"))
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "is_update", "seq", "name")
        .mapInPandas(_buffer(capacity), "bucket int, seq bigint, step bigint, name string, cnt bigint, evicted boolean")
    )


def buffer_state(changes: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The buffer (name, cnt) after the changes; a name that was given a 0 is still in it."""
    log = changes.select("name", "cnt", "evicted", "step")
    if before is not None:
        log = before.select("name", "cnt", F.lit(False).alias("evicted"),
                            F.lit(-1).cast("bigint").alias("step")).unionByName(log)
    last = F.max_by(F.struct("cnt", "evicted"), F.col("step"))
    return log.groupBy("name").agg(last.alias("_last")).where("not _last.evicted").select("name", "_last.cnt")
