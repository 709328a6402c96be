"""Quality rules: counts of words, lines and symbols, and bands of compression ratios.

A text is compressed whole and in fixed chunks of bytes. What compresses too well repeats
itself; what hardly compresses is noise. A ratio falls as a text grows, so each length (a
power of two) has its own limits: fixed outer ones, and inside them the median of all
different texts of that length, less and more a number of median deviations.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from namewire.llm.base import stored, table

CHUNK = 2048  # bytes
SHARE = 0.25  # of a text's bytes in chunks outside their band, beyond which it is rejected
LEVEL = 3
# From this many bytes on: the least and the most bytes that a byte may compress to, whatever the corpus.
OUTER = [(0, 0.0, 9.0), (128, 0.40, 1.10), (256, 0.34, 0.95), (512, 0.30, 0.86), (1024, 0.27, 0.80),
         (4096, 0.23, 0.75), (16_384, 0.20, 0.72), (131_072, 0.16, 0.70)]
DEVIATIONS = 6.0  # median deviations from the median of a length
LEAST_WIDTH = 0.1  # of the median, however alike the texts are
PRIOR = 20  # made-up texts a length, spread evenly over the outer band: few texts say little
BUCKETS = 1000  # of a ratio of 1; ratios above 2 count as 2
LENGTHS = 48  # powers of two
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words inside repeated windows
WINDOW = 3
PIECE = 1 << 20
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
COUNTS = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_bytes long, ratio double, chunk_bytes array<long>, chunk_ratio array<double>")


def pieces(text: bytes, limit: int = PIECE) -> Iterator[bytes]:
    """A text in pieces of about ``limit`` bytes, cut behind white space so that no word is torn."""
    cut, low = re.compile(rb"[ \t-\r]"), 0
    while low < len(text):
        space = cut.search(text, low + limit) if low + limit < len(text) else None
        high = space.end() if space else len(text)
        yield text[low:high]
        low = high


def word_ids(text: bytes) -> tuple[np.ndarray, int]:
    """Each word as the number of its first occurrence among the different words, and how many those are."""
    known: dict[bytes, int] = {}
    found = []
    for piece in pieces(text):
        words = piece.split()
        fresh = [word for word in dict.fromkeys(words) if word not in known]
        known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
        found.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
    return (np.concatenate(found) if found else np.zeros(0, np.int64)), len(known)


def repeated_words(ids: np.ndarray, different: int, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that the text has more than once; exact."""
    if len(ids) <= window:
        return 0
    code, size = ids[: len(ids) - window + 1], different
    for k in range(1, window):
        if size > (1 << 62) // max(different, 1):  # number the beginnings anew before the codes overflow
            distinct, code = np.unique(code, return_inverse=True)
            size = len(distinct)
        code, size = code * different + ids[k: len(ids) - window + 1 + k], size * different
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(code), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    inside = np.zeros(len(ids), bool)
    for k in range(window):
        inside[k: k + len(code)] |= again
    return int(inside.sum())


def outer_band(length: int) -> tuple[float, float]:
    """The fixed limits of texts of at least 2 ** (length - 1) bytes and less than twice that."""
    least = 1 << max(length - 1, 0)
    return next((low, high) for start, low, high in reversed(OUTER) if least >= start)


def weighted_median(values: list[tuple[float, int]]) -> float:
    """The least value that half of the weight does not exceed."""
    half, total = sum(n for _, n in values) / 2, 0
    for value, n in sorted(values):
        total += n
        if total >= half:
            return value
    raise ValueError("no values")


def inner_band(length: int, seen: dict[int, int], deviations: float = DEVIATIONS) -> tuple[float, float]:
    """Limits of a length out of how many texts have each ratio (in buckets)."""
    low, high = outer_band(length)
    spread = [(min(low + (high - low) * (k + 0.5) / PRIOR, 2.0), 1) for k in range(PRIOR)]
    weighted = [(k / BUCKETS, n) for k, n in seen.items()] + spread
    middle = weighted_median(weighted)
    width = max(deviations * weighted_median([(abs(v - middle), n) for v, n in weighted]), LEAST_WIDTH * middle)
    return max(low, middle - width), min(high, middle + width)


def tally(text: bytes, packer: zstandard.ZstdCompressor, chunk: int = CHUNK) -> tuple:
    """The counts of one text and how far it and its chunks compress."""
    ids, different = word_ids(text)
    follow = int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))
    chars = len(text) - follow - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    parts = [text[low: low + chunk] for low in range(0, len(text), chunk)]
    return (len(ids), chars, symbols, len(lines) - len(set(lines)), repeated_words(ids, different), len(text),
            len(packer.compress(text)) / len(text) if text else None,
            [len(p) for p in parts], [len(packer.compress(p)) / len(p) for p in parts])


def counted(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The counts of every row of (doc_id, text), with a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            rows = [tally(text.as_py() or b"", packer, chunk) for text in batch.column(2).cast(pa.binary())]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(list(c), kind) for c, kind in zip(columns, kinds))],
                ["doc_id", "digest", *names])

    names = [part.split()[0] for part in COUNTS.split(", ")]
    arrow = {"long": pa.int64(), "double": pa.float64(), "array<long>": pa.list_(pa.int64()),
             "array<double>": pa.list_(pa.float64())}
    kinds = [arrow[part.split()[1]] for part in COUNTS.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"),
                       F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest long, " + COUNTS)


def _length(n_bytes) -> Column:
    """1 for one byte, 2 for two and three, and so on."""
    return F.length(F.bin(n_bytes))


def bands(counts: DataFrame, deviations: float = DEVIATIONS) -> dict[str, list[tuple[float, float]]]:
    """Limits by length, for texts ("whole") and for chunks ("chunk"), out of all different texts.

    What comes to the driver is how many have each ratio, to a thousandth: a table of
    fixed size.
    """
    bucket = F.floor(F.least("ratio", F.lit(2.0)) * BUCKETS).cast("int").alias("bucket")
    whole = counts.where("n_bytes > 0").select("digest", F.lit(-1).alias("place"), "n_bytes", "ratio")
    chunks = counts.select("digest", F.posexplode(F.arrays_zip("chunk_bytes", "chunk_ratio")).alias("place", "c")).select(
        "digest", "place", F.col("c.chunk_bytes").alias("n_bytes"), F.col("c.chunk_ratio").alias("ratio"))
    seen = (whole.unionByName(chunks).select("digest", "place", _length("n_bytes").alias("length"), bucket).distinct()
            .groupBy((F.col("place") < 0).alias("whole"), "length", "bucket").count().collect())
    out = {}
    for kind in ("whole", "chunk"):
        by = [{} for _ in range(LENGTHS)]
        for row in seen:
            if row.whole == (kind == "whole"):
                by[row.length][row.bucket] = row["count"]
        out[kind] = [inner_band(length, by[length], deviations) for length in range(LENGTHS)]
    return out


def judge_quality(docs: DataFrame, chunk: int = CHUNK, share: float = SHARE, deviations: float = DEVIATIONS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, ratios and a verdict.

    Columns: ``doc_id``, the counts (``n_words``, ``word_chars`` in code points, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``), ``base_failed``, ``ratio`` of the whole text (null if
    empty), ``low_share`` and ``high_share`` of its bytes in chunks that lie below or above
    their band, ``verdict`` of the compression bands, and ``kept``.

    Words are runs of bytes other than space and \\x09-\\x0D. A null or empty text has no words,
    the verdict "empty", and is not kept. A very long text is read in pieces; what is held
    is the text, its lines, its different words and a number a word. Rows are judged one by one, so
    repeated ids, ties and null ids are kept as they are; of equal texts one counts for the bands. An
    empty table gives an empty one. Further columns, whatever their names, are not read.
    """
    rows = stored(counted(docs, chunk), "counts")
    limits = bands(rows, deviations)

    def limit(kind: str, side: int, n_bytes) -> Column:
        return F.get(F.array(*(F.lit(float(b[side])) for b in limits[kind])), _length(n_bytes))

    def share_of(side: int) -> Column:
        def out(c):
            edge = limit("chunk", side, c["chunk_bytes"])
            return c["chunk_ratio"] > edge if side else c["chunk_ratio"] < edge

        size = F.aggregate(F.filter(F.arrays_zip("chunk_bytes", "chunk_ratio"), out), F.lit(0).cast("long"),
                           lambda total, c: total + c["chunk_bytes"])
        return F.coalesce(size / F.nullif("n_bytes", F.lit(0)), F.lit(0.0))

    verdict = (
        F.when(F.col("n_bytes") == 0, "empty")
        .when(F.col("ratio") < limit("whole", 0, "n_bytes"), "repetitive")
        .when(F.col("ratio") > limit("whole", 1, "n_bytes"), "incompressible")
        .when(F.col("low_share") > share, "repetitive chunks")
        .when(F.col("high_share") > share, "incompressible chunks")
        .otherwise("kept")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    return (
        rows.withColumn("low_share", share_of(0)).withColumn("high_share", share_of(1))
        .withColumn("verdict", verdict).withColumn("base_failed", failed)
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                "ratio", "low_share", "high_share", "verdict",
                (~F.col("base_failed") & (F.col("verdict") == "kept")).alias("kept"))
    )


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return judge_quality(table(spark, sf_dir, "documents"))
