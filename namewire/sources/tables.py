"""Views over the given tables in the shapes that the operators take."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from namewire.functions.times import epoch_floor, segment_name
from namewire.schema import JUNK_NAME
from namewire.session import use_utc


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a table, with its zoneless times as UTC timestamps.

    Said in the schema rather than by a cast, time conditions reach the scan.
    """
    kinds = {T.TimestampNTZType(): T.TimestampType()}
    return T.StructType([
        T.StructField(f.name, kinds.get(f.dataType, f.dataType)) for f in spark.read.parquet(path).schema
    ])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table."""
    path = f"{folder}/{name}.parquet"
    return use_utc(spark).read.schema(table_schema(spark, path)).parquet(path)


PART_BYTES, FULL_PART_BYTES = 4 << 20, 128 << 20


def line_partitions(spark: SparkSession, line_bytes: float) -> int:
    """Three tasks a core once lines fill them by 4 MB each, and more for tasks of 128 MB beyond that."""
    even = min(3 * spark.sparkContext.defaultParallelism, math.ceil(line_bytes / PART_BYTES))
    return max(1, even, math.ceil(line_bytes / FULL_PART_BYTES))


def article_lines(spark: SparkSession, folder: str) -> DataFrame:
    """An article line per event, that names every word of a document.

    Some lines have a field too few, a trailing empty entry, or the junk name. The join reads little and
    makes much: its partitions are dealt by the bytes of the lines, not by those of the two tables.
    """
    words = F.split(F.translate("text", "\n\t\r", "   "), " ")
    listed = F.transform(words, lambda w, i: F.concat(w, F.lit(","), i + 1))
    texts = table(spark, folder, "documents").select("doc_id", F.array_join(listed, ";").alias("listed"))
    documents = table(spark, folder, "documents").select(F.count("*")).scalar()
    events = table(spark, folder, "events").select("event_id", "ts").withColumn(
        "doc_id", F.pmod("event_id", documents)
    )
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    event = F.col("event_id")
    names = F.concat(
        "listed",
        F.when(event % 5 == 0, ";").otherwise(""),
        F.when(event % 13 == 0, f";{JUNK_NAME},7").otherwise(""),
    )
    line = F.concat_ws(
        "\t", F.concat_ws("-", stamp, "event_id"), stamp, F.repeat(F.lit("\t"), 20), names,
        F.lit(""), F.lit(""), F.when(event % 17 != 0, ""),
    )
    text_bytes = table(spark, folder, "documents").agg(F.avg(F.octet_length("text"))).first()[0] or 0
    parts = line_partitions(spark, events.count() * text_bytes)
    events, texts = (side.repartition(parts, "doc_id") for side in (events, texts))
    return events.join(texts, "doc_id").select("event_id", "ts", line.alias("value"))


def mentions(spark: SparkSession, folder: str) -> DataFrame:
    """A mention per event, of its type."""
    return table(spark, folder, "events").select("event_id", "ts", F.col("event_type").alias("name"))


def changelog(spark: SparkSession, folder: str) -> DataFrame:
    """Count updates by user; some are deletes."""
    cnt = F.when(F.col("event_id") % 7 == 0, 0).otherwise(F.floor("value"))
    return table(spark, folder, "events").select(
        F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("name"),
        cnt.cast("bigint").alias("cnt"), "ts",
    )


def instance_type(number: str) -> Column:
    """A machine type per number, over three families."""
    n = F.col(number)
    return F.concat(F.element_at(F.array(F.lit("c"), F.lit("m"), F.lit("r")), (n % 3 + 1).cast("int")), n)


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """A price point per event: its user stands for the machine type."""
    event = F.col("event_id")
    letter = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (event % 3 + 1).cast("int"))
    return table(spark, folder, "events").select(
        instance_type("user_id").alias("instance_type"),
        F.concat(F.lit("us-east-"), F.col("user_id") % 2 + 1, letter).alias("zone"),
        F.when(F.col("event_type") == "error", "Windows").otherwise("Linux/UNIX").alias("product"),
        "ts", F.col("value").alias("price"), "event_id",
    )


def attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Text attributes with units per machine type, one type a part."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, folder, "part").select(
        instance_type("p_partkey").alias("instance_type"),
        F.concat(size, F.lit(" GiB")).alias("memory"),
        F.when(key % 10 == 9, "Variable").otherwise(F.concat(size + 1, F.lit(".5"))).alias("ecu"),
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """A run per order, on one of ten machine types."""
    return table(spark, folder, "orders").withColumn("machine", F.col("o_custkey") % 10).select(
        F.col("o_orderkey").alias("run_id"),
        instance_type("machine").alias("instance_type"),
        (F.col("o_custkey") % 5 + 1).alias("instances"),
        F.col("o_orderpriority").alias("data_size"),
        (F.col("o_totalprice") / 1000).alias("runtime_min"),
    )


def timed_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The runs with a zone and with a start and an end, spread over the time that the prices cover."""
    clock = table(spark, folder, "events").agg(
        F.unix_micros(F.min("ts")).alias("origin"), (F.unix_seconds(F.max("ts")) - F.unix_seconds(F.min("ts"))).alias("span"))
    number = F.col("run_id")
    letter = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (number % 3 + 1).cast("int"))
    region = F.substring("instance_type", 2, 9).cast("int") % 2 + 1
    begin = clock.select("origin").scalar() + number * 7919 % clock.select("span").scalar() * 1_000_000
    return runs(spark, folder).select(
        "*", F.concat(F.lit("us-east-"), region, letter).alias("zone"), F.timestamp_micros(begin).alias("started"),
        F.timestamp_micros(begin + F.floor(F.col("runtime_min") * 60) * 1_000_000).alias("ended"))


def stages(spark: SparkSession, folder: str) -> DataFrame:
    """A stage per order line."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("stage"),
        F.col("l_quantity").alias("stage_seconds"),
    )


def points(spark: SparkSession, folder: str) -> DataFrame:
    """A point per event."""
    return table(spark, folder, "events").select(F.col("event_id").alias("x"), F.col("value").alias("y"))


def segment_lines(spark: SparkSession, folder: str, block: int = 1 << 16) -> DataFrame:
    """The article lines as lines of 15-minute files, in ``event_id`` order.

    Blocks are runs of ids, so a block has at most ``block`` lines.
    """
    start = F.timestamp_seconds(epoch_floor("ts", 900))
    return article_lines(spark, folder).select(
        segment_name(start).alias("file"), F.floor(F.col("event_id") / block).alias("block"),
        F.col("event_id").alias("line_id"), "value",
    )


def arrived_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The 15-minute files that have at least one event."""
    start = F.timestamp_seconds(epoch_floor("ts", 900))
    return table(spark, folder, "events").select(segment_name(start).alias("file_name")).distinct()


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a table is a folder of part files, in whatever store it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory()
