"""From article lines to mention counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from namewire.functions.text import clean_utf8, line_field, mention_name
from namewire.functions.times import publish_day
from namewire.operators.rows import valid_rows
from namewire.operators.sizing import lookup_join
from namewire.schema import ALL_NAMES, ENTRY_SEPARATOR, JUNK_NAME, OFFSET_SEPARATOR, PUBLISH_DATE


CHUNK_BYTES = 16 << 20


def explode_names(rows: DataFrame, entries: str | Column, keep: list[str | Column], name: str = "name") -> DataFrame:
    """One row per listed name, without its offset; empty and junk names drop out.

    The conditions are put to the entry, before its name is cut out of it: they then
    cost a few bytes' comparison, and the name is cut out once.
    """
    source = F.col(entries) if isinstance(entries, str) else entries
    entry = F.col("_entry")
    empty = (entry == "") | entry.startswith(OFFSET_SEPARATOR)
    junk = (entry == JUNK_NAME) | entry.startswith(JUNK_NAME + OFFSET_SEPARATOR)
    return (
        rows.select(*keep, F.explode(F.split(source, ENTRY_SEPARATOR, -1)).alias("_entry"))
        .where(~empty & ~junk)
        .withColumn(name, mention_name("_entry"))
        .drop("_entry")
    )


def names_by_date(
    lines: DataFrame, value: str = "value", clean: bool = False, observed: Observation | str | None = None,
    keep: list[str] | None = None, weight: str | None = None,
) -> DataFrame:
    """(publish_date, name) for every mention in a valid, dated line, with the columns to ``keep``.

    ``observed`` counts kept and rejected lines on the way (see ``valid_rows``). With a ``weight``, the mentions of
    a name in some megabytes of lines of one day (and one value of each column to keep) come as one row, and that
    column has their number: the same to ``name_counts``, at a fraction of the rows.
    """
    # The date is read off the front of the line: as a filter it runs beside the field
    # count, where a second split of the whole line would cost more than the first.
    day = publish_day(line_field(value, PUBLISH_DATE))
    rows = valid_rows(lines, value, observed).where(day.isNotNull()).select(
        day.alias("publish_date"), *(keep or []), F.get("fields", F.lit(ALL_NAMES)).alias("_names")
    )
    entries = clean_utf8("_names") if clean else F.col("_names")
    if weight is None:
        return explode_names(rows, entries, ["publish_date", *(keep or [])])
    by = ["publish_date", *(keep or [])]
    return combine_names(rows.select(*by, entries.alias("_names")), by, weight)


def _cut_names(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Name and number of the list of every entry that counts, as ``explode_names`` and ``mention_name`` say."""
    split = pc.split_pattern(lists, ENTRY_SEPARATOR)
    entries, of = split.flatten(), pc.list_parent_indices(split).to_numpy()
    offsets = np.frombuffer(entries.buffers()[1], np.int32)[entries.offset: entries.offset + len(entries) + 1].astype(np.int64)
    comma = pc.find_substring(entries, OFFSET_SEPARATOR).to_numpy()
    length = np.where(comma < 0, np.diff(offsets), comma)
    # the bytes of all names, one after the other
    whole = np.frombuffer(entries.buffers()[2] or b"", np.uint8)[offsets[0]: offsets[-1]]
    edges = np.zeros(len(whole) + 1, np.int8)
    some = length > 0
    starts = offsets[:-1][some] - offsets[0]
    edges[starts] = 1
    edges[starts + length[some]] -= 1  # where the next name begins at once, nothing changes
    data = whole[np.cumsum(edges[:-1], dtype=np.int8).astype(bool)]
    ends = np.r_[0, np.cumsum(length[some])].astype(np.int32)
    names = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data))
    kept = pc.not_equal(names, JUNK_NAME)
    return names.filter(kept), of[some][kept.to_numpy(zero_copy_only=False)]


def combine_names(rows: DataFrame, by: list[str], weight: str, newest: str | None = None) -> DataFrame:
    """(``by``, name, ``weight``): mentions in the lists ``_names`` of some megabytes of rows, one row for each name of a group.

    With ``newest``, rows also have the highest value of that column in their group.
    """
    kept = [*by, *([newest] if newest else [])]
    schema = StructType([*rows.select(*kept).schema.fields, StructField("name", StringType()), StructField(weight, LongType())])
    return rows.select(*kept, "_names").mapInArrow(_combined(by, schema.names, newest), schema)


def _combined(by: list[str], columns: list[str], newest: str | None = None):
    """Counts the mentions of every name by the columns ``by``, chunk by chunk."""
    kept = [*by, *([f"{newest}_max"] if newest else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = max(1, int(len(batch) * CHUNK_BYTES / max(batch.nbytes, 1)))
            for low in range(0, len(batch), rows):
                part = pa.Table.from_batches([batch.slice(low, rows)])
                groups = part.drop(["_names"]).append_column("_row", pa.array(np.arange(len(part)))).group_by(by).aggregate(
                    [("_row", "list"), *([(newest, "max")] if newest else [])])
                group = np.empty(len(part), np.int64)
                listed = groups.column("_row_list").combine_chunks()
                group[listed.flatten().to_numpy()] = pc.list_parent_indices(listed).to_numpy()
                names, of = _cut_names(part.column("_names").combine_chunks())
                coded = names.dictionary_encode()
                if not len(names):
                    continue
                width = len(coded.dictionary)
                key = group[of] * width + coded.indices.to_numpy()
                if len(groups) * width <= 8 * len(key):
                    times = np.bincount(key, minlength=len(groups) * width)
                    found = np.flatnonzero(times)
                    times = times[found]
                else:
                    counted = pc.value_counts(pa.array(key))
                    found, times = counted.field("values").to_numpy(), counted.field("counts").to_numpy()
                out = [groups.column(c).combine_chunks().take(pa.array(found // width)) for c in kept]
                yield from pa.Table.from_arrays(
                    [*out, coded.dictionary.take(pa.array(found % width)), pa.array(times.astype(np.int64))], names=columns).to_batches(100_000)
    return run


def drop_names(rows: DataFrame, stop_list: DataFrame, name: str = "name") -> DataFrame:
    """Rows whose name is not on the stop list.

    Cheapest after counting, when each name is one row a day.
    """
    kept = lookup_join(rows, stop_list.select(name).distinct(), name, "left_anti")
    return kept.select(*rows.columns)


def name_counts(
    mentions: DataFrame,
    by: list[str] | None = None,
    weight: str | None = None,
    cnt: str = "cnt",
) -> DataFrame:
    """Mentions (or sum of increments) per key; counted in the map tasks first."""
    by = by or ["publish_date", "name"]
    measure = F.sum(weight) if weight else F.count("*")
    return mentions.groupBy(*by).agg(measure.alias(cnt))


def name_count_maps(counts: DataFrame, max_entries: int = 10_000) -> DataFrame:
    """Counts per day as maps of name to count, in chunks of about ``max_entries``.

    A day of many names is several rows: no task holds a whole day. The broadcast
    side has one row per calendar day (see ``publish_day``), so at most 3.7 million
    small rows. It counts by ``cnt``, which is never 0, so that both sides need the same
    columns and share one exchange of counts.
    """
    sizes = counts.groupBy("publish_date").agg(
        F.ceil(F.count_if(F.col("cnt") > 0) / F.lit(max_entries)).alias("_chunks")
    )
    return (
        counts.join(F.broadcast(sizes), "publish_date")
        .withColumn("chunk", F.pmod(F.xxhash64("name"), F.col("_chunks")))
        .groupBy("publish_date", "chunk")
        .agg(F.map_from_entries(F.collect_list(F.struct("name", "cnt"))).alias("name_counts"))
    )
