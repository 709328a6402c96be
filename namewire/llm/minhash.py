"""Near-duplicate documents: one-permutation hashing, banded buckets, star-shaped candidates.

Rows with the same shingle set are one class. Each class has one sketch, in which
empty bins borrow from non-empty ones along a fixed random order of their own
(optimal densification). The classes of a bucket are compared with one of them, its
hub, so a bucket gives as many pairs as it has members. What a star cannot see is a link
between two members that it leaves in different components. Both are held against a
common pivot: they can only be linked if they share a shingle that the pivot lacks, or
in a narrow range of sizes. So they meet over those shingles, rare ones first (prefix
filtering), instead of all against all. Every link is confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from namewire.llm.base import components, released, semi_join, stored, table
from namewire.llm.words import Hasher, mix, shingles, texts

BANDS, ROWS = 40, 6  # a pair at 0.8 shares a bucket with probability 1 - 5e-6
SKETCH = "id long, n long, node long, bands array<long>"


class Sketcher:
    """One-permutation sketches of shingle sets, as one key a band."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 29):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        draw = np.random.Generator(np.random.PCG64(seed))
        # place of each bin in the order in which an empty bin asks the others
        self.order = np.argsort(draw.random((self.bins, self.bins)), axis=1).astype(np.int16)
        self.factors = draw.integers(1, 1 << 63, (bands, rows), dtype=np.uint64) | np.uint64(1)
        self.salt = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    def keys(self, unique: np.ndarray) -> np.ndarray:
        values = np.sort(mix(unique ^ np.uint64(0x5851F42D4C957F2D)))
        bins = ((values >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        filled = bins[first]
        sketch = np.zeros(self.bins, np.uint64)
        sketch[filled] = values[first]
        if len(filled) < self.bins:
            empty = np.setdiff1d(np.arange(self.bins), filled)
            lender = filled[self.order[np.ix_(empty, filled)].argmin(axis=1)]
            sketch[empty] = sketch[lender]
        banded = (sketch.reshape(self.bands, self.rows) * self.factors).sum(axis=1, dtype=np.uint64)
        return mix(banded + self.salt).view(np.int64)


def _sets(batch: pa.RecordBatch, hasher: Hasher, size: int) -> Iterator[np.ndarray]:
    for low, high, data, offsets in texts(batch.column("text")):
        hashes, _, _, at = hasher.words(data, offsets)
        for i in range(high - low):
            yield np.unique(shingles(hashes[at[i]: at[i + 1]], size))


def _node(unique: np.ndarray) -> int:
    """64-bit name of a shingle set."""
    parts = np.array([unique.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(unique)), len(unique)], np.uint64)
    return int(shingles(parts, 3)[:1].view(np.int64)[0])


def _sketches(shingle_size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sketcher = Hasher(), Sketcher(bands, rows)
        for batch in batches:
            counts, nodes, keys = [], [], []
            for unique in _sets(batch, hasher, shingle_size):
                counts.append(len(unique))
                nodes.append(_node(unique) if len(unique) else None)
                keys.append(sketcher.keys(unique) if len(unique) else np.zeros(0, np.int64))
            offsets = np.r_[0, np.cumsum([len(k) for k in keys])].astype(np.int32)
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            ], names=["id", "n", "node", "bands"])
    return run


def _full_sets(shingle_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for unique in _sets(batch, hasher, shingle_size):
                if len(unique):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_node(unique)], pa.int64()), pa.array([unique.tobytes()], pa.binary())],
                        names=["node", "items"])
    return run


def _compared():
    """Exact overlaps, and what each ``b`` has beside ``a``.

    Two sets that both meet ``a`` and overlap by ``percent`` either fit what they share
    with ``a`` or have an element outside ``a`` in common.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("items_a"), batch.column("items_b")
            sizes, extras = np.zeros((3, len(left)), np.int64), []
            for i in range(len(left)):
                a = np.frombuffer(left[i].as_buffer(), np.uint64)
                b = np.frombuffer(right[i].as_buffer(), np.uint64)
                outside = a[np.minimum(np.searchsorted(a, b), len(a) - 1)] != b
                sizes[:, i] = len(a), len(b), len(b) - np.count_nonzero(outside)
                extras.append(b[outside].view(np.int64))
            offsets = np.r_[0, np.cumsum([len(x) for x in extras])].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *(pa.array(x) for x in sizes),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(extras)))],
                names=["a", "b", "na", "nb", "common", "extra"])
    return run


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    shingle_size: int = 4, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """Near-duplicate groups of texts.

    Returns ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row, under
    these names whatever other columns the input has. A null or blank text has no
    shingle and is linked with nothing. A row without an id is linked with nothing, has
    no component and is kept. Rows that repeat an id are all returned; with equal
    texts they are in one component. An empty table gives an empty result.
    """
    plain = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    sketches = stored(plain.mapInArrow(released(_sketches(shingle_size, bands, rows)), SKETCH), "sketches")
    usable = sketches.where("id is not null and n > 0")

    # a class is a distinct shingle set; the row with its smallest id sends its sketch on
    classes = stored(usable.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n")), "classes")
    heads = usable.join(classes.select("id", "node"), ["id", "node"], "left_semi")
    placed = heads.select("node", F.explode("bands").alias("bucket"))
    buckets = placed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1").select("bucket")
    members = stored(placed.join(buckets, "bucket"), "members")

    needed = stored(members.select("node").distinct().join(classes, "node").select("id").distinct(), "needed")
    sets = stored(semi_join(plain, needed, "id").mapInArrow(
        released(_full_sets(shingle_size)), "node long, items binary").dropDuplicates(["node"]), "sets")

    def compared(pairs: DataFrame) -> DataFrame:
        with_sets = (pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a")
                     .join(sets.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b"))
        return stored(with_sets.mapInArrow(
            released(_compared()), "a long, b long, na long, nb long, common long, extra array<long>"), "compared")

    def links(pairs: DataFrame) -> DataFrame:
        return pairs.where(f"100 * common >= {percent} * (na + nb - common)").select("a", "b")

    # the member that meets most others is the hub of its buckets: an original rather than an edited copy
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    weight = members.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = (members.join(weight, "node").groupBy("bucket")
            .agg(F.max(F.struct("weight", "node")).alias("hub")))
    starred = stored(members.join(hubs, "bucket"), "starred")
    spokes = starred.where("node <> hub.node").select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
    found = components(links(compared(spokes.distinct())))

    # buckets that still span components; their members are held against the heaviest hub any of them knows
    own = starred.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (own.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high").select("bucket"))
    known = starred.groupBy("node").agg(F.max("hub").alias("known"))
    own = stored(own.join(mixed, "bucket", "left_semi").join(known, "node"), "mixed")
    pivots = own.groupBy("bucket").agg(F.max("known").getField("node").alias("a"))
    ring = own.join(pivots, "bucket").where("node <> a").select("bucket", "a", F.col("node").alias("b"), "component")
    held = compared(ring.select("a", "b").distinct())
    ring = stored(ring.join(held.drop("extra"), ["a", "b"]), "ring")

    def sides(rows: DataFrame, on: list[str], columns: list[str]) -> DataFrame:
        x, y = (rows.select(*on, *(F.col(c).alias(c + side) for c in columns)) for side in ("_x", "_y"))
        return x.join(y, on).where(
            "b_x < b_y and component_x <> component_y"
            f" and {percent} * greatest(nb_x, nb_y) <= 100 * least(nb_x, nb_y)")

    fits = (sides(ring, ["bucket"], ["b", "nb", "common", "component"])
            .where(f"{100 + percent} * least(common_x, common_y) >= {percent} * (nb_x + nb_y)"))
    elements = (held.join(ring.select("b", "component").distinct(), "b")
                .select("a", "b", "nb", "component", F.explode("extra").alias("element")))
    often = elements.groupBy("a", "element").agg(F.count("*").alias("times")).where("times > 1")
    single = F.expr(f"nb - ceil({percent} * nb / 100) + 1")
    ranked = elements.join(often, ["a", "element"], "left").withColumn(
        "place", F.row_number().over(Window.partitionBy("a", "b").orderBy(F.coalesce("times", F.lit(1)), "element")))
    rare = stored(ranked.where((F.col("place") <= single) & F.col("times").isNotNull()), "rare")
    shared = sides(rare, ["a", "element"], ["b", "nb", "component"])
    rest = fits.select("b_x", "b_y").union(shared.select("b_x", "b_y")).distinct()
    more = links(held).union(links(compared(rest.select(F.col("b_x").alias("a"), F.col("b_y").alias("b")))))
    found = components(found.selectExpr("node as a", "component as b").union(more))

    named = (classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    lowest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(lowest, "component").select("node", "component_id")
    return (sketches.join(named, "node", "left")
            .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")))


def op2_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
