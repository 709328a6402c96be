"""Session settings and the shared scratch folder."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # names are many: a small first-level map in front of the hash aggregation only costs
    "spark.sql.codegen.aggregate.map.twolevel.enabled": "false",
    # a machine that is taken away hands its shuffle blocks on first
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"

MIN_SPLIT_BYTES, MAX_SPLIT_BYTES = 128 << 20, 1 << 30
SHUFFLE_BYTES = 256 << 20
SHUFFLED_SHARE = 0.1
TASKS_PER_CORE = 50


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Split and shuffle sizes for a scan of ``input_bytes`` on ``cores``.

    About 50 scan tasks a core, of 128 MB to 1 GB each: larger splits combine more
    mentions before the exchange. Partial counts are taken to be a tenth of the
    input, in partitions of 256 MB; AQE merges what turns out small.
    """
    split = min(max(input_bytes // (TASKS_PER_CORE * cores), MIN_SPLIT_BYTES), MAX_SPLIT_BYTES)
    shuffled = math.ceil(input_bytes * SHUFFLED_SHARE / SHUFFLE_BYTES)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(max(cores, shuffled)),
    }


def build_session(
    app: str = "namewire",
    master: str | None = None,
    input_bytes: int | None = None,
    cores: int = 8,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # split sizes must not follow the number of live cores: two scans of a file have to cut it alike
    settings = SETTINGS | {"spark.sql.files.minPartitionNum": str(cores)}
    if input_bytes is not None:
        settings.update(sizing(input_bytes, cores))
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Segment names and publish times are UTC; say so on a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Stateful processors need a state store with column families; say so on a session made elsewhere.

    A query that goes on from a checkpoint keeps the store that its checkpoint names.
    """
    spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without ``spark.checkpoint.dir`` (a test) gets a temporary
    folder; on a cluster, a folder of the driver's own disk would lose data.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="namewire-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder."""
    return os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex}")
