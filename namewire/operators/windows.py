"""Counts over hopping and trailing time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from namewire.functions.times import epoch_floor

HOUR = 3600
MINUTE = 60


def hopping_counts(
    events: DataFrame, ts: str = "ts", name: str = "name", size: int = HOUR, slide: int = MINUTE,
    weight: str | None = None,
) -> DataFrame:
    """Mentions per (window, name); windows are ``[start, start + size)``, epoch-aligned.

    Mentions are counted per slide slot first, so a hot name is one row a slot. A
    slot row then goes to the one or two size-wide blocks in which its windows
    start, and is spread over the windows only there: the exchange carries at most
    two rows a slot rather than ``size / slide``.
    """
    if size % slide:
        raise ValueError("the window size must be a multiple of the slide")
    measure = F.sum(weight) if weight else F.count("*")
    slots = events.groupBy(F.col(name).alias("name"), epoch_floor(ts, slide).alias("_slot")).agg(
        measure.alias("_n")
    )
    first = F.col("_slot") - size + slide

    def block(c: Column) -> Column:
        return c - F.pmod(c, F.lit(size).cast("bigint"))

    placed = slots.withColumn(
        "_block", F.explode(F.array_distinct(F.array(block(first), block(F.col("_slot")))))
    ).repartition("name", "_block")
    starts = F.sequence(
        F.greatest(first, F.col("_block")),
        F.least(F.col("_slot"), F.col("_block") + size - slide),
        F.lit(slide).cast("bigint"),
    )
    return (
        placed.withColumn("_start", F.explode(starts))
        .groupBy("name", "_block", "_start").agg(F.sum("_n").alias("cnt"))
        .select(
            F.timestamp_seconds("_start").alias("window_start"),
            F.timestamp_seconds(F.col("_start") + size).alias("window_end"),
            "name", "cnt",
        )
    )


def newest_window_end(as_of: Column, complete: bool = True, size: int = HOUR, slide: int = MINUTE) -> Column:
    """End of the newest window at ``as_of``: complete by then, or only started."""
    slot = epoch_floor(as_of, slide)
    return F.timestamp_seconds(slot if complete else slot + size)


def latest_window_counts(counts: DataFrame, as_of: Column, complete: bool = True,
                         size: int = HOUR, slide: int = MINUTE) -> DataFrame:
    """Rows of the newest window out of hopping counts."""
    return counts.where(F.col("window_end") == newest_window_end(as_of, complete, size, slide))


def newest_counts(
    events: DataFrame, ts: str = "ts", name: str = "name", as_of: Column | None = None,
    complete: bool = True, size: int = HOUR, slide: int = MINUTE,
) -> DataFrame:
    """Counts of the newest window straight from events, reading that window only.

    The start is one plain subquery value, so the scan skips what lies before it.
    """
    kind = events.schema[ts].dataType.simpleString()
    if as_of is None:
        clock = events.select(F.max(ts).alias("_as_of"))
    else:
        clock = events.sparkSession.range(1).select(as_of.alias("_as_of"))
    end = newest_window_end(F.col("_as_of"), complete, size, slide)
    start = clock.select(end.alias("_end")).select(
        F.timestamp_seconds(F.unix_seconds("_end") - size).cast(kind)
    ).scalar()
    end = F.timestamp_seconds(F.unix_seconds(start.cast("timestamp")) + size).cast(kind)
    return (
        events.where((F.col(ts) >= start) & (F.col(ts) < end))
        .groupBy(F.col(name).alias("name")).agg(F.count("*").alias("cnt"))
        .select(start.cast("timestamp").alias("window_start"), end.cast("timestamp").alias("window_end"),
                "name", "cnt")
    )


def trailing_totals(events: DataFrame, ts: str = "ts", name: str = "name", size: int = HOUR) -> DataFrame:
    """(name, ts, cnt): mentions in ``[ts - size, ts]``, for every instant of a name.

    The count is a running total at the instant less the running total just before
    ``ts - size``, which a probe row reads off. Totals run within a minute of a name and
    start from the minutes before it, so the work is linear and a hot name is in many tasks.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    instants = events.groupBy(F.col(name).alias("name"), micros.alias("_at")).agg(F.count("*").alias("_n")).where(
        "_at is not null")
    marks = instants.withColumn("_mark", F.explode(F.array(
        F.struct(F.col("_at").alias("at"), F.lit(1).alias("sign")),
        F.struct((F.col("_at") - size * 1_000_000).alias("at"), F.lit(-1).alias("sign")))))
    marks = marks.select(
        "name", F.col("_at").alias("_ref"), "_mark.at", "_mark.sign",
        F.when(F.col("_mark.sign") == 1, F.col("_n")).otherwise(0).alias("_n"),
        F.floor(F.col("_mark.at") / (MINUTE * 1_000_000)).alias("_block"))
    before = Window.partitionBy("name").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = marks.groupBy("name", "_block").agg(F.sum("_n").alias("_in")).select(
        F.col("name").alias("_name"), F.col("_block").alias("_from"), F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_start"))
    # a probe stands before an instant of the same time
    upto = Window.partitionBy("name", "_block").orderBy("at", "sign").rowsBetween(Window.unboundedPreceding, 0)
    running = marks.withColumn("_run", F.sum("_n").over(upto))
    total = running.join(starts, F.col("name").eqNullSafe(F.col("_name")) & (F.col("_block") == F.col("_from")))
    return total.groupBy("name", "_ref").agg(F.sum(F.col("sign") * (F.col("_start") + F.col("_run"))).alias("cnt")).select(
        "name", F.timestamp_micros("_ref").alias("ts"), "cnt")


def trailing_hour_count(events: DataFrame, ts: str = "ts", name: str = "name", size: int = HOUR) -> DataFrame:
    """Every event with the count of its name over the hour up to it (``trailing_cnt``).

    An event without a time is kept, without a count.
    """
    totals = trailing_totals(events, ts, name, size).select(
        F.col("name").alias("_name"), F.col("ts").alias("_ts"), F.col("cnt").alias("trailing_cnt")
    )
    same = F.col(name).eqNullSafe(F.col("_name")) & (F.col(ts).cast("timestamp") == F.col("_ts"))
    return events.join(totals, same, "left").drop("_name", "_ts")
