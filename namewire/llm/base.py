"""Tables, intermediate results and connected components, shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from namewire.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, lineage cut.

    With ``by``, rows of each value of that column lie apart, and a condition on it reads only its own.
    """
    path = scratch_path(df.sparkSession, label)
    (df.write.partitionBy(by) if by else df.write).parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The same function for a task's batches, which hands freed memory back to the machine at its end.

    A Python worker goes on to other stages; what the allocators keep would add up over them.
    """
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def semi_join(facts: DataFrame, keys: DataFrame, on: str, max_rows: int = 2_000_000, how: str = "left_semi") -> DataFrame:
    """Rows whose key is among the stored ``keys``, or with ``left_anti`` is not.

    The keys are counted and broadcast up to ``max_rows``, which at 8 bytes a key is
    16 MB; beyond that both sides are shuffled.
    """
    return facts.join(F.broadcast(keys) if keys.count() <= max_rows else keys, on, how)


def held_out(doc_id: str = "doc_id", folds: int = 5):
    """Whether a row is in the fold that no label is learnt from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0


def components(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """Connected components of undirected links ``a``, ``b`` (long, not null).

    Large-star and small-star steps in turn until every node points at the smallest
    node of its component. A node's neighbours are only ever aggregated and joined,
    never gathered, so a hub may have any number of them. Returns ``node``,
    ``component`` for every node of a link.
    """
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links")
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "stars")
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
