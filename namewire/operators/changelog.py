"""Changelogs of counts: rows (seq, name, cnt) where a count of 0 deletes the name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from namewire.operators.sizing import lookup_join
from namewire.schema import FIRST_KEY


def fold_changelog(log: DataFrame, seq: str | list[str] = "seq", keep_deleted: bool = False) -> DataFrame:
    """Current state: the last count of each name, without the deleted names.

    A single numeric ``seq`` keeps this a hash aggregation; several columns sort.
    """
    order = F.col(seq) if isinstance(seq, str) else F.struct(*seq)
    state = log.groupBy("name").agg(F.max_by("cnt", order).alias("cnt"))
    return state if keep_deleted else state.where("cnt <> 0")


def conflate(log: DataFrame, ts: str = "ts", every: int = 1, seq: str = "seq") -> DataFrame:
    """The last update of each name in each tick of ``every`` seconds."""
    epoch = F.unix_seconds(F.col(ts).cast("timestamp"))
    tick = F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(every).cast("bigint")))
    return log.groupBy(tick.alias("tick"), "name").agg(F.max_by("cnt", F.col(seq)).alias("cnt"))


def snapshot_and_delta(log: DataFrame, at: Column, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """What a new subscriber gets: the state up to ``at``, then the updates after it."""
    snapshot = fold_changelog(log.where(F.col(seq) <= at), seq)
    return snapshot, log.where(F.col(seq) > at).select(seq, "name", "cnt")


def json_message(updates: DataFrame, by: list[str], max_entries: int = 1000) -> DataFrame:
    """Updates as JSON array messages of {name, count}, names in order.

    Messages hold about ``max_entries`` updates; a key with more has several. The sizes,
    one row a key, are measured and broadcast if small, so that a busy key's updates are
    exchanged only once, on (key, part).
    """
    chunks = F.greatest(F.ceil(F.count("cnt") / F.lit(max_entries)), F.lit(1))
    sizes = updates.groupBy(*by).agg(chunks.alias("_chunks"))
    entry = F.struct("name", F.col("cnt").alias("count"))
    return (
        lookup_join(updates, sizes, by)
        .withColumn("part", F.pmod(F.xxhash64("name"), F.col("_chunks")))
        .groupBy(*by, "part")
        .agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("message"))
    )


def bounded_message(state: DataFrame) -> DataFrame:
    """One JSON array message out of a state that a top-k has already bounded."""
    entry = F.struct("name", F.col("cnt").alias("count"))
    return state.groupBy().agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("message"))


def last_key(records: DataFrame, by: list[str] | None = None, key: str = "key", offset: str = "offset",
             default: str = FIRST_KEY) -> DataFrame:
    """Key of the record of highest offset, per partition or over all.

    Over all, an empty topic gives the default key.
    """
    last = F.max_by(key, F.col(offset))
    return records.groupBy(*(by or [])).agg(F.coalesce(last, F.lit(default)).alias("last_key"))
