"""Tables fed to a stream piece by piece, the stream being stopped and started in between."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from namewire.sinks.topics import sink_changelog


PARTITIONS = "spark.sql.shuffle.partitions"


@contextmanager
def state_partitions(spark: SparkSession, most: int | None = None) -> Iterator[int]:
    """Queries started inside keep their state in at most ``most`` partitions, one a core unless told otherwise.

    Every partition of a stateful operator opens its stores, and a Python processor its worker, in every micro-batch, however few
    rows there are. A checkpoint keeps the number it was made with.
    """
    before = spark.conf.get(PARTITIONS)
    count = min(int(before), most or max(spark.sparkContext.defaultParallelism, 1))
    spark.conf.set(PARTITIONS, str(count))
    try:
        yield count
    finally:
        spark.conf.set(PARTITIONS, before)


def feed(pieces: Iterable[DataFrame], folder: str, start: Callable[[DataFrame], StreamingQuery]) -> list[StreamingQuery]:
    """Append each piece to ``folder`` and let the stream over it run until it has read that.

    ``start`` gets the stream and returns the query, which should stop by itself (``availableNow``). Every
    piece is a run of its own, from the checkpoint of the run before.
    """
    runs = []
    for piece in pieces:
        piece.write.mode("append").parquet(folder, compression="zstd")
        with state_partitions(piece.sparkSession):
            query = start(piece.sparkSession.readStream.schema(piece.schema).parquet(folder))
        query.awaitTermination()
        runs.append(query)
    return runs


def feed_and_read(
    pieces: Iterable[DataFrame], root: str, make: Callable[[DataFrame], DataFrame], output_mode: str = "update",
) -> tuple[str, list[StreamingQuery]]:
    """Feed the pieces to ``make`` and write what comes out; the folder of micro-batches, and the runs."""
    def start(lines: DataFrame) -> StreamingQuery:
        return sink_changelog(make(lines), f"{root}/checkpoint", f"{root}/out", trigger={"availableNow": True}, output_mode=output_mode)

    return f"{root}/out", feed(pieces, f"{root}/in", start)


def read_epochs(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a folder of micro-batches, with their ``epoch``."""
    return spark.read.option("basePath", folder).parquet(f"{folder}/epoch=*")
