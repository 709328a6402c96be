"""Row checks on article lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from namewire.functions.times import publish_day
from namewire.schema import ALL_NAMES, FIELD_COUNT, FIELD_SEPARATOR, PUBLISH_DATE


OUTCOMES = ["wrong_field_count", "unknown_date", "no_names", "kept"]


def _outcome(value: str, fields: Column) -> Column:
    return (
        F.when(F.col(value).isNull() | (F.size(fields) != FIELD_COUNT), "wrong_field_count")
        .when(publish_day(F.get(fields, F.lit(PUBLISH_DATE))).isNull(), "unknown_date")
        .when(F.get(fields, F.lit(ALL_NAMES)) == "", "no_names")
        .otherwise("kept")
    )


def valid_rows(lines: DataFrame, value: str = "value", observed: Observation | str | None = None) -> DataFrame:
    """Lines of exactly 27 fields (trailing empty ones count), split into ``fields``.

    With ``observed``, all lines are counted by outcome (see ``row_quality``) on their way past, in the
    same pass: an ``Observation`` for a batch, a name for the progress of a stream.
    """
    rows = lines.withColumn("fields", F.split(F.col(value), FIELD_SEPARATOR, -1))
    if observed is not None:
        outcome = _outcome(value, F.col("fields"))
        rows = rows.observe(observed, *(F.count_if(outcome == kind).alias(kind) for kind in OUTCOMES))
    return rows.where(F.size("fields") == FIELD_COUNT)


def quality_rows(spark: SparkSession, *counts: dict[str, int]) -> DataFrame:
    """Observed counts, added up, in the form of ``row_quality``.

    A map task that runs again after its output was lost is counted again; where that matters, ask
    ``row_quality``, which is a job of its own.
    """
    total = {kind: sum(c.get(kind) or 0 for c in counts) for kind in OUTCOMES}
    return spark.createDataFrame([(kind, n) for kind, n in total.items() if n], "outcome string, rows bigint")


def row_quality(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines kept and lines rejected, by reason."""
    outcome = _outcome(value, F.split(F.col(value), FIELD_SEPARATOR, -1))
    return lines.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("rows"))
