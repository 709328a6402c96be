"""Passages that repeat, exactly or nearly, across documents: compact windows.

A text is its sequence of five-word shingles. Under a random order of shingles, all windows
of ``least`` shingles with the same two smallest shingles lie next to each other: a compact
window, with its smallest positions and the interval that it spans. The windows of all
documents meet by their two smallest shingles, in the order of the text.

Each such group is held against one place of its smallest member only; further places of that
text are members too, compared with its first place. Where a member parts from it
inside its own window, to the left or to the right, the member is sent on under the place
and the shingle at which the two part, whether or not they share a passage: members that
share a passage with each other that does not lie in the centre whole part from it at the
same place, with the same shingle. The windows that are left hold the places passed so far,
so groups of any size take a few rounds with one comparison a member, and no verbatim
passage is lost; an edited one is found if under one of the orders its two smallest shingles
are whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from namewire.llm.base import semi_join, stored, table
from namewire.llm.words import Hasher, mix, shingles, texts

SHINGLE, LEAST_WORDS, PERCENT, HASHES = 5, 50, 80, 4
SKETCH = "id long, node long, n_words long, keys array<long>, places array<int>, lefts array<tinyint>, rights array<tinyint>"
FOUND = ("a long, b long, start_a int, end_a int, start_b int, end_b int,"
         " key long, node long, place int, left tinyint, right tinyint")


def compact_windows(items: np.ndarray, at: np.ndarray, least: int, salt: int) -> tuple[np.ndarray, ...]:
    """Positions of the two smallest items of all windows of ``least`` items, in order, and the first and last places of their windows.

    ``items`` holds several sequences, cut at ``at``; between two sequences is one place
    whose item is not looked at. Windows with the same two smallest items lie next to each other.
    """
    n = len(items)
    if n < least:
        return (np.zeros(0, np.int64),) * 4
    low_bits = np.uint64(max(20, n.bit_length()))
    place = (np.uint64(1) << low_bits) - np.uint64(1)
    order = (mix(items ^ mix(np.array([salt + 1], np.uint64))) >> low_bits << low_bits) | np.arange(n, dtype=np.uint64)
    order[at] &= place  # separators are smaller than all
    one, two, width = order, np.full(n, np.uint64(2 ** 64 - 1)), 1
    while width < least:
        step = min(width, least - width)
        a, b = one[:-step], one[step:]
        rest = np.minimum(two[:-step], two[step:])
        one, two = np.minimum(a, b), np.minimum(rest, np.maximum(a, b))
        if step < width:  # the two share items, perhaps their smallest
            two = np.where(a == b, rest, two)
        width += step
    start = np.flatnonzero(np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
    stop = np.r_[start[1:], len(one)] + least - 2
    p, q = (one[start] & place).astype(np.int64), (two[start] & place).astype(np.int64)
    real = np.ones(n, bool)
    real[at] = False
    keep = real[p]
    return np.minimum(p, q)[keep], np.maximum(p, q)[keep], start[keep], stop[keep]


def sequences(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of several texts, a 0 after those of each, where the texts' begin, and a 64-bit name of each sequence.

    ``at`` cuts the hashes of words into those of the texts.
    """
    words = np.diff(at)
    lengths = np.where(words < SHINGLE, np.minimum(words, 1), words - SHINGLE + 1) + 1
    begin = np.cumsum(lengths) - lengths
    items = np.zeros(int(lengths.sum()), np.uint64)
    place = np.arange(len(items)) - np.repeat(begin, lengths)
    inside = np.flatnonzero(place < np.repeat(lengths - 1, lengths))
    if len(hashes) >= SHINGLE:
        # a short text's only shingle is set below; what is taken here reaches over its end
        from_word = np.repeat(at[:-1], lengths)[inside] + place[inside]
        items[inside] = shingles(hashes, SHINGLE)[np.minimum(from_word, len(hashes) - SHINGLE)]
    for k in np.flatnonzero((words > 0) & (words < SHINGLE)).tolist():
        items[begin[k]] = shingles(hashes[at[k]: at[k + 1]], SHINGLE)[0]
    named = np.zeros(len(items), np.uint64)
    named[inside] = mix(items[inside] + mix(place[inside].astype(np.uint64) + np.uint64(1)))
    nodes = mix(np.add.reduceat(named, begin)) if len(begin) else named
    return items, begin, nodes.view(np.int64)


def _parts(column: pa.Array, hasher: Hasher) -> Iterator[tuple[int, int, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    for low, high, data, offsets in texts(column):
        hashes, _, _, at = hasher.words(data, offsets)
        yield low, high, np.diff(at), sequences(hashes, at)


def _sketch(least: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for at_row, to_row, n_words, (items, begin, nodes) in _parts(batch.column("text"), hasher):
                lengths = np.diff(np.append(begin, len(items)))
                text = np.repeat(np.arange(len(begin)), lengths)
                found = []
                for f in range(hashes):
                    c, other, low, high = compact_windows(items, begin + lengths - 1, least, f)
                    row = text[c]
                    key = mix(items[c] + mix(items[other] + np.uint64(f))).view(np.int64)
                    found.append((row, key, (c - begin[row]).astype(np.int32), (c - low).astype(np.int8), (high - c).astype(np.int8)))
                row, *columns = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(row, kind="stable")
                cuts = pa.array(np.searchsorted(row[order], np.arange(len(begin) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at_row, to_row - at_row), pa.array(nodes), pa.array(n_words.astype(np.int64)),
                     *(pa.ListArray.from_arrays(cuts, pa.array(x[order])) for x in columns)],
                    names=["id", "node", "n_words", "keys", "places", "lefts", "rights"])
    return run


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        for _, _, _, (items, begin, nodes) in _parts(batch.column("text"), hasher):
            ends = np.append(begin[1:], len(items)) - 1
            short = items.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes), pa.array([short[i:j].tobytes() for i, j in zip(begin.tolist(), ends.tolist())], pa.binary())],
                names=["node", "items"])


class Near:
    """Passages of two texts that overlap by ``percent``, around pairs of places that hold the same item.

    What the texts have in common is looked up once for all their pairs of places.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, least: int, percent: int):
        self.least, self.percent, self.slack = least, percent, least * (100 - percent) // percent
        kinds, of = np.unique(np.concatenate((a, b)), return_inverse=True)
        both = np.bincount(of[: len(a)], minlength=len(kinds)).astype(bool)
        both &= np.bincount(of[len(a):], minlength=len(kinds)).astype(bool)
        self.at = np.full(len(kinds), -1)  # scratch: the place of a kind in b
        self.a, self.b = (self._places(part, both) for part in (of[: len(a)], of[len(a):]))

    @staticmethod
    def _places(kinds: np.ndarray, both: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """Places whose item the other text has too, their kinds, the places before with the same kind or -1."""
        place = np.flatnonzero(both[kinds])
        kind = kinds[place]
        order = np.argsort(kind, kind="stable")
        again = kind[order[1:]] == kind[order[:-1]]
        before = np.full(len(place), -1)
        before[order[1:][again]] = place[order[:-1][again]]
        return place, kind, before, place.tolist()

    def _part(self, text: tuple, low: int, high: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Kinds and their first places from ``low`` to ``high``, or nothing where they are too few."""
        place, kind, before, listed = text
        first, last = bisect_left(listed, low), bisect_left(listed, high)
        if 100 * (last - first) < self.percent * (2 * self.least - last + first):
            return None
        new = before[first:last] < low
        return place[first:last][new], kind[first:last][new]

    def around(self, ca: int, cb: int) -> list[tuple[int, int, int, int]]:
        """Passages around a pair of places: start and end in ``a``, start and end in ``b``.

        A passage has ``least`` items in one text and as many or more in the other, and starts and
        ends with something that both have. Words put in or left out move its end, or its start.
        """
        least, percent, slack = self.least, self.percent, self.slack
        reach = least + slack - 1
        from_a, from_b = max(0, ca - reach), max(0, cb - reach)
        part_a, part_b = self._part(self.a, from_a, ca + reach + 1), self._part(self.b, from_b, cb + reach + 1)
        if part_a is None or part_b is None:
            return []
        self.at[part_b[1]] = part_b[0]
        j = self.at[part_a[1]]
        self.at[part_b[1]] = -1
        same = j >= 0
        i, j = part_a[0][same], j[same]
        if 100 * len(i) < percent * (2 * least - len(i)):
            return []
        moves, found = j - i, []
        kinds = [m for m in sorted(set(moves.tolist())) if abs(m - (cb - ca)) <= slack]
        starts = {m: i[moves == m] for m in kinds}
        ends = {}
        for last in kinds:
            ends[last] = np.zeros(ca + reach + least + slack + 2 - from_a, bool)
            ends[last][starts[last] - from_a] = True
        for first in kinds:
            for last in kinds:
                if abs(last - first) > slack:
                    continue
                size_a, size_b = least + max(0, first - last), least + max(0, last - first)
                start = starts[first]
                start = start[ends[last][start + (size_a - 1 - from_a)]]
                if not len(start):
                    continue
                from_i, from_j = i - start[:, None], j - start[:, None] - first
                inside = ((from_i >= 0) & (from_i < size_a) & (from_j >= 0) & (from_j < size_b)).sum(1)
                good = start[100 * inside >= percent * (size_a + size_b - inside)]
                if len(good):
                    cuts = (np.flatnonzero(good[1:] - good[:-1] > least) + 1).tolist()
                    for low, high in zip([0, *cuts], [*cuts, len(good)]):
                        low, high = int(good[low]), int(good[high - 1])
                        found.append((low, high + size_a, low + first, high + first + size_b))
        return found


def near_windows(a: np.ndarray, b: np.ndarray, ca: int, cb: int, least: int, percent: int) -> list[tuple[int, int, int, int]]:
    """Passages around a pair of places that overlap by ``percent``: start and end in ``a``, start and end in ``b``."""
    return Near(a, b, least, percent).around(ca, cb)


def alike_around(a: np.ndarray, b: np.ndarray, ca: np.ndarray, cb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of places with the same item: where in ``a`` the items around them that are alike start and end."""
    low, high = np.empty_like(ca), np.empty_like(ca)
    moves = cb - ca
    for d in set(moves.tolist()):
        at = np.flatnonzero(moves == d)
        begin, end = max(0, -d), min(len(a), len(b) - d)
        other = np.concatenate(([begin - 1], np.flatnonzero(a[begin:end] != b[begin + d: end + d]) + begin, [end]))
        after = np.searchsorted(other, ca[at])
        low[at], high[at] = other[after - 1] + 1, other[after]
    return low, high


def _compare(least: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, parted = [], []
            cuts = batch.column("ca").offsets.to_pylist()
            seeds = [batch.column(k).values.to_numpy().astype(np.int64) for k in ("ca", "cb", "lb", "rb")]
            for row, (na, nb) in enumerate(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())):
                a = np.frombuffer(batch.column("items_a")[row].as_buffer(), np.uint32)
                b = np.frombuffer(batch.column("items_b")[row].as_buffer(), np.uint32)
                ca, cb, lefts, rights = (s[cuts[row]: cuts[row + 1]] for s in seeds)
                real = a[ca] == b[cb]  # else only their keys are equal
                ca, cb = ca[real], cb[real]
                # where b parts from a inside the windows of the seed: what b shares with others beyond, they part at alike
                firsts, lasts = np.maximum(0, cb - lefts[real]), np.minimum(len(b) - 1, cb + rights[real])
                lows, highs = alike_around(a, b, ca, cb)
                common = None
                covered: set[tuple[int, int]] = set()
                shared: dict[tuple[int, int, int, int], None] = {}
                tried: set[tuple[int, int]] = set()
                partings: dict[tuple[int, int, int], tuple[int, int]] = {}
                for at_a, at_b, low, high, first, last in zip(*(x.tolist() for x in (ca, cb, lows, highs, firsts, lasts))):
                    d = at_b - at_a
                    for side, place in ((1, high), (2, low - 1)):
                        here = place + d
                        if not first <= here <= last:
                            continue
                        begin, end = max(first, max(at_b, here) - least + 1), min(last, min(at_b, here) + least - 1)
                        if end - begin + 1 >= least:
                            known = partings.get((d, side, place))
                            partings[d, side, place] = (min(begin, known[0]), max(end, known[1])) if known else (begin, end)
                    if high - low >= least:
                        near = [(low, high, low + d, high + d)]
                    elif na == nb or (at_a, at_b) in tried or any(s <= first and last < e for s, e in covered):
                        continue  # all that the seed can show
                    else:
                        tried.add((at_a, at_b))
                        common = common or Near(a, b, least, percent)
                        near = common.around(at_a, at_b)
                    for found in near:
                        covered.add(found[2:])
                        shared[found] = None
                spans += [(na, nb, s, e + SHINGLE - 1, t, f + SHINGLE - 1) for s, e, t, f in shared]
                parted += [(na, nb, side, place + 1, place + d, int(b[place + d]), place + d - begin, end - place - d)
                           for (d, side, place), (begin, end) in partings.items()]
            yield _found(spans, 0)
            if parted:
                na, nb, side, place, here, item, left, right = (np.array(c, np.int64) for c in zip(*parted))
                rows = np.stack((na, side, place, item), 1).astype(np.uint64).ravel()
                yield _found(list(zip(shingles(rows, 4)[::4].view(np.int64).tolist(), *(c.tolist() for c in (nb, here, left, right)))), 6)
    return run


def _found(rows: list[tuple], at: int) -> pa.RecordBatch:
    """Rows of ``FOUND`` with these columns from the given one on, and no others."""
    fields = [f.rsplit(" ", 1) for f in FOUND.split(", ")]
    types = [{"long": pa.int64(), "int": pa.int32(), "tinyint": pa.int8()}[t] for _, t in fields]
    given = dict(enumerate(zip(*rows), at))
    return pa.RecordBatch.from_arrays(
        [pa.array(given[k], t) if k in given else pa.nulls(len(rows), t) for k, t in enumerate(types)], names=[f.strip() for f, _ in fields])


def longest(spans: DataFrame, by: list[str]) -> DataFrame:
    """The spans ``start``, ``end`` of each group that lie in no other one of it."""
    before = Window.partitionBy(*by).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(-1))
    return (spans.groupBy(*by, "start").agg(F.max("end").alias("end")).withColumn("_reached", reached)
            .where(F.col("end") > F.col("_reached")).drop("_reached"))


def repeated_passages(
    documents: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT, hashes: int = HASHES,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Documents that share a passage of ``least_words`` words or more with another document.

    One row a document with such passages: ``doc_id``, ``n_words``, ``n_repeated`` (words in
    shared passages), ``spans`` (their word offsets, ends exclusive, in order) and ``partner``
    (the smallest id of a document of other words that it was found with, or of a copy).
    Documents without are left out, so null and short texts are, and rows without an id. Rows
    that repeat an id count as documents of their own. An empty table gives no row.
    """
    least = least_words - SHINGLE + 1
    plain = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).where("id is not null")
    sketches = stored(plain.mapInArrow(_sketch(least, hashes), SKETCH).where(F.col("n_words") >= least_words), "sketches")
    # copies are one class, which its smallest id stands for
    classes = stored(sketches.groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "classes")
    heads = semi_join(sketches, classes.select("id"), "id")
    windows = heads.select("node", F.explode(F.arrays_zip("keys", "places", "lefts", "rights")).alias("w")).select(
        F.col("w.keys").alias("key"), "node", F.col("w.places").alias("place"),
        F.col("w.lefts").alias("left"), F.col("w.rights").alias("right"))
    items = spans = None
    while True:
        # counted first: that exchange of all windows is of keys and small numbers, nodes go only with keys found twice
        again = stored(windows.groupBy("key").count().where("count > 1").select("key"), "keys-again")
        # members move once: their order by node and place tells the centre of their key
        by_key = Window.partitionBy("key").orderBy("node", "place", "left", "right").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)
        led = semi_join(windows, again, "key").select(
            "*", F.first("node").over(by_key).alias("a"), F.first("place").over(by_key).alias("ca"), F.last("node").over(by_key).alias("z"))
        # the centre's further places are members like those of others
        seeds = (led.where("a <> z and (node <> a or place <> ca)")
                 .select("a", F.col("node").alias("b"), F.struct(
                     "key", "ca", F.col("place").alias("cb"), F.col("left").alias("lb"), F.col("right").alias("rb")).alias("seed"))
                 .groupBy("a", "b").agg(F.sort_array(F.collect_set("seed")).alias("seeds")))  # at most b's windows
        seeds = stored(seeds.select("a", "b", *(F.col(f"seeds.{k}").alias(k) for k in ("ca", "cb", "lb", "rb"))), "keys")
        if seeds.isEmpty():
            break
        if items is None:
            needed = seeds.select(F.col("a").alias("node")).union(seeds.select("b")).distinct().join(classes, "node").select("id")
            items = stored(semi_join(plain, stored(needed, "needed"), "id").mapInArrow(
                _items, "node long, items binary"), "items")
        found = stored(seeds.join(items.select(F.col("node").alias("a"), F.col("items").alias("items_a")), "a")
                       .join(items.select(F.col("node").alias("b"), F.col("items").alias("items_b")), "b")
                       .mapInArrow(_compare(least, percent), FOUND), "found")
        new = found.where("a is not null").select("a", "b", "start_a", "end_a", "start_b", "end_b")
        spans = new if spans is None else spans.unionByName(new)
        windows = found.where("key is not null").select("key", "node", "place", "left", "right").distinct()

    whole = classes.join(sketches.select("node", "n_words").distinct(), "node").where("copies > 1").select(
        "node", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end"), F.col("node").alias("other"))
    both = whole
    if spans is not None:
        spans = stored(spans, "spans")
        both = whole.union(spans.where("a <> b").selectExpr("a", "start_a", "end_a", "b")).union(
            spans.where("a <> b").selectExpr("b", "start_b", "end_b", "a"))
    ids = classes.select(F.col("node").alias("other"), F.col("id").alias("partner"))
    partners = both.select("node", "other").distinct().join(ids, "other").groupBy("node").agg(F.min("partner").alias("partner"))
    # what lies in a longer span adds nothing, so a text has at most one span a place, whatever the number of others
    both = longest(both.select("node", "start", "end"), ["node"])
    if spans is not None:
        # what a text has twice is shared twice
        twice = longest(spans.where("a = b").selectExpr("a as node", "start_b - start_a as move", "start_a as start", "end_a as end"),
                        ["node", "move"]).withColumnsRenamed({"start": "start_a", "end": "end_a"})
        both = both.union(both.join(twice, "node").selectExpr(
            "node", "greatest(start, start_a) + move as start", "least(end, end_a) + move as end")
            .where(F.col("end") - F.col("start") >= least_words))
    merged = F.aggregate(
        F.sort_array(F.collect_set(F.struct("start", "end"))), F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (s["start"] <= F.element_at(done, -1)["end"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["start"].alias("start"),
                F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end"))))
        ).otherwise(F.concat(done, F.array(s))))
    per_node = both.select("node", "start", "end").distinct().groupBy("node").agg(merged.alias("spans")).join(partners, "node")
    return (sketches.select(F.col("id").alias("doc_id"), "node", "n_words").join(per_node, "node")
            .select("doc_id", "n_words", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
                    .alias("n_repeated"), "spans", "partner"))


def op9_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))
