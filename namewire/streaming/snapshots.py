"""The state of a running query, read from its checkpoint."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


@contextmanager
def state_changes_kept(spark: SparkSession):
    """Queries started inside write a change log beside their snapshots, which ``state_changes`` reads."""
    before = spark.conf.get(CHANGELOG, None)
    spark.conf.set(CHANGELOG, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CHANGELOG)
        else:
            spark.conf.set(CHANGELOG, before)


def _reader(spark: SparkSession, operator: int):
    return spark.read.format("statestore").option("operatorId", operator)


def state_at(spark: SparkSession, checkpoint: str, batch: int | None = None, operator: int = 0) -> DataFrame:
    """Keys and values of a stateful operator after a micro-batch, the newest by default."""
    reader = _reader(spark, operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select("key.*", "value.*")


def buffer_at(spark: SparkSession, checkpoint: str, batch: int | None = None, operator: int = 0) -> DataFrame:
    """(bucket, name, cnt) of a running ``live_bounded_topk`` after a micro-batch, the newest by default."""
    reader = _reader(spark, operator).option("stateVarName", "buffer")
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint).select("key.bucket", "user_map_key.name", "user_map_value.cnt")


def state_changes(spark: SparkSession, checkpoint: str, after: int, until: int | None = None, operator: int = 0) -> DataFrame:
    """What the micro-batches past ``after`` did to the state: (batch, change, keys, values); a deleted key has no values."""
    reader = _reader(spark, operator).option("readChangeFeed", True).option("changeStartBatchId", after + 1)
    if until is not None:
        reader = reader.option("changeEndBatchId", until)
    return reader.load(checkpoint).select(F.col("batch_id").alias("batch"), F.col("change_type").alias("change"), "key.*", "value.*")


def state_from(snapshot: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """A snapshot brought forward by the changes since: what a subscriber holds who got both."""
    values = [c for c in snapshot.columns if c not in keys]
    log = snapshot.withColumn("batch", F.lit(-1).cast("bigint")).withColumn("change", F.lit("update")).unionByName(changes)
    last = F.max_by(F.struct("change", *values), "batch")
    return log.groupBy(*keys).agg(last.alias("_last")).where("_last.change <> 'delete'").select(
        *keys, *(F.col(f"_last.{c}").alias(c) for c in values))
