"""Benchmark decontamination on templates.

Numbers, names and units become typed placeholders, so a question with other numbers or
names has the same template. Documents and items meet in windows of template words; a
window counts if its values are the item's own, or if the values behind its placeholders
are consistent, that is one value of the item always stands for one value of the document.
A placeholder at the window's edge is left out of that, as its run of numbers or names may
go on outside the passage. What of an item has no such window, as it is short or made mainly
of numbers and names, is looked for word by word, in windows of raw words.

A bitmap of fixed size, made from the items' windows, lets the tasks drop the windows
that no item has; what is left is joined by hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from namewire.llm.base import released, stored, table
from namewire.llm.words import Hasher, mix, shingles, texts

WINDOW, LEAST = 12, 6  # template words of a window; of the shortest item that is looked for
FILTER_BITS = 24
BROADCAST_WINDOWS = 1_000_000
UNITS = """m km cm mm kg g mg lb oz l ml s ms h hr min hour hours minute minutes second seconds day days week weeks
month months year years meter meters metre metres mile miles foot feet inch inches gram grams kilogram kilograms pound
pounds liter liters litre litres dollar dollars euro euros cent cents percent degree degrees""".split()
LITERAL, NUMBER, NAME, UNIT = range(4)
WINDOWS = "id long, place long, size int, window long, slots array<long>, inner array<long>"


class Templates:
    """Template words of texts, with the values that their placeholders hide."""

    def __init__(self):
        self.hasher = Hasher(letters=True)
        listed = "\n".join(UNITS).encode()
        data = np.frombuffer(listed, np.uint8)
        self.units = np.sort(self.hasher.words(data, np.array([0, len(data)]))[0])
        self.marks = mix(np.arange(1, 5, dtype=np.uint64) << np.uint64(60))

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Per text: hashes of the template words, their kinds, the hashes of what they stand for, of the raw words, and the first raw word of each."""
        words, starts, ends, at = self.hasher.words(data, offsets)
        if len(words) == 0:
            for _ in range(len(offsets) - 1):
                yield words, np.zeros(0, np.int8), words, words, np.zeros(0, np.int64)
            return
        digit = np.r_[0, np.cumsum((data >= 48) & (data <= 57))]
        stop = np.r_[0, np.cumsum(np.isin(data, np.frombuffer(b".!?\n", np.uint8)))]
        opening = np.ones(len(words), bool)  # of a sentence
        opening[1:] = stop[starts[1:]] > stop[ends[:-1]]
        opening[at[:-1][np.diff(at) > 0]] = True
        head, follow = data[starts], data[np.minimum(starts + 1, len(data) - 1)]
        wide = (head == 0xC3) & (follow >= 0x80) & (follow <= 0x9E)
        lower = (follow >= 97) & (follow <= 122) | (follow >= 0x80)
        capital = ((head >= 65) & (head <= 90) & lower & (ends - starts > 1)) | wide
        kind = np.zeros(len(words), np.int8)
        kind[capital & ~opening] = NAME
        kind[digit[ends] - digit[starts] == ends - starts] = NUMBER
        listed = self.units[np.minimum(np.searchsorted(self.units, words), len(self.units) - 1)] == words
        for k in range(len(at) - 1):
            low, high = at[k], at[k + 1]
            own, raw = kind[low:high].copy(), words[low:high]
            if high > low:
                own[1:][(own[:-1] == NUMBER) & listed[low + 1: high]] = UNIT
            # a run of placeholders of one kind is one placeholder
            new = np.r_[True, (own[1:] != own[:-1]) | (own[1:] == LITERAL)][: len(own)]
            first = np.flatnonzero(new)
            values = np.add.reduceat(raw, first) if len(first) else raw
            own = own[first]
            yield np.where(own == LITERAL, values, self.marks[own]), own, values, raw, first

    def windows(self, data: np.ndarray, offsets: np.ndarray, sizes: list[int], exact: list[int], wanted: np.ndarray | None, whole: int = 0):
        """Row, place, size, hash, placeholder values and those away from the edge of the windows that are at least half literal.

        Exact windows, of raw words, have a size below zero and no placeholders. With
        ``whole`` they are those of what no other window holds.
        """
        def has(hashes: np.ndarray) -> np.ndarray:
            if wanted is None:
                return np.ones(len(hashes), bool)
            bit = hashes >> np.uint64(64 - FILTER_BITS)
            return (wanted[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

        none = np.zeros(0, np.int64)
        for row, (words, kinds, values, raw, first) in enumerate(self.rows(data, offsets)):
            literal = np.r_[0, np.cumsum(kinds == LITERAL)]
            last = np.r_[first[1:], len(raw)]
            rejected = [(0, len(raw))] if whole and 0 < len(words) < LEAST else []
            for size in ([min(whole, len(words))] if whole else sizes):
                if len(words) < size or size < LEAST:
                    continue
                hashes = shingles(words, size)
                enough = 2 * (literal[size:] - literal[:-size]) >= size
                if whole:
                    rejected += [(int(first[p]), int(last[p + size - 1])) for p in np.flatnonzero(~enough)]
                for p in np.flatnonzero(enough & has(hashes)):
                    slot = kinds[p: p + size] != LITERAL
                    own = values[p: p + size].view(np.int64)
                    yield row, p, size, int(hashes[p: p + 1].view(np.int64)[0]), own[slot], own[1:-1][slot[1:-1]]
            for size in {min(whole, high - low) for low, high in rejected} if whole else exact:
                if len(raw) < size:
                    continue
                hashes = mix(shingles(raw, size) + np.uint64(1))
                good = has(hashes)
                if whole:
                    good[:] = False
                    for low, high in rejected:
                        if min(whole, high - low) == size:
                            good[low: high - size + 1] = True
                for p in np.flatnonzero(good):
                    place = int(np.searchsorted(first, p, side="right")) - 1
                    yield row, place, -size, int(hashes[p: p + 1].view(np.int64)[0]), none, none


def _windows(sizes: list[int], exact: list[int], wanted: np.ndarray | None, whole: int = 0):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates()
        for batch in batches:
            ids = batch.column("id")
            for low, high, data, offsets in texts(batch.column("text")):
                found = list(templates.windows(data, offsets, sizes, exact, wanted, whole))
                if found:
                    rows, places, lengths, hashes, slots, inner = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(rows) if not low else pa.array(np.array(rows) + low)),
                         pa.array(places, pa.int64()), pa.array(lengths, pa.int32()), pa.array(hashes, pa.int64()),
                         pa.array(slots, pa.list_(pa.int64())), pa.array(inner, pa.list_(pa.int64()))],
                        names=["id", "place", "size", "window", "slots", "inner"])
    return run


def contaminated(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
    id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Documents that hold a passage of a benchmark item, verbatim or with other numbers, names or units.

    Returns ``doc_id``, ``item_id``, ``n_windows``, ``first_word`` (place among the
    document's template words) and ``verbatim`` for each such pair, and nothing for clean
    documents. Items of ``LEAST`` to ``window`` template words are looked for whole, and shorter
    ones verbatim; so are windows that are less than half literal. Null texts hold nothing; rows without an id cannot be named and are
    left out; rows that repeat an id are reported together; empty tables give no row.
    """
    spark = documents.sparkSession
    items = benchmark.select(F.col(item_column).cast("long").alias("id"), F.col(item_text).alias("text")).where("id is not null")
    known = stored(items.mapInArrow(_windows([], [], None, window), WINDOWS).distinct(), "item-windows")
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect())  # at most 2 * window - LEAST + 1
    bits = known.select(F.shiftrightunsigned("window", 64 - FILTER_BITS).alias("bit")).distinct().toArrow()["bit"].to_numpy()
    wanted = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    np.bitwise_or.at(wanted, bits >> 3, (1 << (bits & 7)).astype(np.uint8))

    plain = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).where("id is not null")
    found = plain.mapInArrow(released(_windows([n for n in sizes if n > 0], [-n for n in sizes if n < 0], wanted)), WINDOWS)
    items = known.select("window", "size", F.col("id").alias("item_id"), F.col("slots").alias("item_slots"), F.col("inner").alias("item_inner"))
    few = known.count() <= BROADCAST_WINDOWS
    pairs = F.array_distinct(F.arrays_zip("item_inner", "inner"))
    consistent = F.size(pairs) == F.size(F.array_distinct("item_inner"))
    return (found.join(F.broadcast(items) if few else items, ["window", "size"])
            .where((F.col("slots") == F.col("item_slots")) | consistent)
            .groupBy(F.col("id").alias("doc_id"), "item_id")
            .agg(F.count_distinct("place", "size").alias("n_windows"), F.min("place").alias("first_word"),
                 F.bool_and(F.col("slots") == F.col("item_slots")).alias("verbatim")))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
