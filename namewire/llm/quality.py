"""Quality by a generalised additive model with pairwise interactions.

Each feature of a text falls into a bin. Cyclic boosting visits the features in turn
and adds a small tree over the bins of one feature, then trees over the cells of the
pairs of features that explain most of what is left. What is learnt is one table
of log-odds a feature and a pair, so a score is a sum of looked-up numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from namewire.llm.base import held_out, stored, table
from namewire.llm.toxicity import label_rows, with_labels
from namewire.llm.words import Hasher, texts

FEATURES = [
    "log_bytes", "log_words", "word_length", "word_spread", "upper", "digits", "marks", "symbols", "wide", "white",
    "distinct", "repeated", "common", "log_lines", "line_length", "line_repeats", "stops", "lone_marks", "capitals",
]
TRAIN_ROWS = 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE = 32, 8, 6, 120, 60, 0.15


def _share(part: np.ndarray, whole: float) -> float:
    return float(np.count_nonzero(part)) / whole if whole else 0.0


def describe(raw: np.ndarray, words: np.ndarray, starts: np.ndarray, ends: np.ndarray, lines: np.ndarray) -> list[float]:
    """Features of one text from its bytes, word hashes, word ends and line hashes."""
    n, m = len(raw), len(words)
    if m == 0:
        return [np.log1p(n)] + [0.0] * (len(FEATURES) - 1)
    lengths = ends - starts
    first, last = raw[starts], raw[ends - 1]
    punctuation = (raw > 32) & (raw < 48) | (raw > 57) & (raw < 65) | (raw > 90) & (raw < 97) | (raw > 122) & (raw < 127)
    plain = np.isin(raw, np.frombuffer(b".,;:!?'\"-()", np.uint8))
    word_end = np.isin(last, np.frombuffer(b".!?", np.uint8))
    lone = (lengths == 1) & ((first < 48) | (first > 57) & (first < 65) | (first > 122) & (first < 128))
    counts = np.unique(words, return_counts=True)[1]
    line_kinds = np.unique(lines)
    return [
        np.log1p(n), np.log1p(m), lengths.mean(), lengths.std(),
        _share((raw >= 65) & (raw <= 90), n), _share((raw >= 48) & (raw <= 57), n), _share(plain, n),
        _share(punctuation & ~plain, n), _share(raw >= 128, n), 1 - lengths.sum() / n,
        len(counts) / m, _share(words[1:] == words[:-1], m), counts.max() / m,
        np.log1p(len(lines)), n / max(1, len(lines)), 1 - len(line_kinds) / max(1, len(lines)),
        _share(word_end, m), _share(lone, m), _share((first >= 65) & (first <= 90), m),
    ]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher()
    for batch in batches:
        values = np.zeros((len(batch), len(FEATURES)))
        for low, high, data, offsets in texts(batch.column("text")):
            words, starts, ends, at = hasher.words(data, offsets)
            for k in range(high - low):
                a, b, raw = at[k], at[k + 1], data[offsets[k]: offsets[k + 1]]
                breaks = np.flatnonzero(raw == 10)
                # a line is named by the sum of its words' hashes
                cuts = np.r_[0, np.searchsorted(starts[a:b] - offsets[k], breaks), b - a]
                sums = np.r_[np.uint64(0), np.cumsum(words[a:b], dtype=np.uint64)]
                lines = (sums[cuts[1:]] - sums[cuts[:-1]])[np.diff(cuts) > 0]
                own = offsets[k]
                values[low + k] = describe(raw, words[a:b], starts[a:b] - own, ends[a:b] - own, lines)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(values[:, k]) for k in range(values.shape[1]))],
            names=["doc_id", *FEATURES])


def text_features(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    plain = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(_describe, "doc_id long, " + ", ".join(f"{name} double" for name in FEATURES))


class AdditiveModel:
    """Lookup tables over bins of single features and of pairs."""

    def __init__(self, edges: list[np.ndarray], pair_edges: list[np.ndarray]):
        self.edges, self.pair_edges = edges, pair_edges
        self.base = 0.0
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: list[tuple[int, int]] = []
        self.cells: list[np.ndarray] = []

    @staticmethod
    def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
        return np.unique(np.quantile(column, np.arange(1, bins) / bins))

    @staticmethod
    def _small_tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 4) -> np.ndarray:
        """Values per bin of a tree of up to ``leaves`` leaves over ordered bins."""
        g, h = np.r_[0.0, np.cumsum(gradient)], np.r_[0.0, np.cumsum(weight)]
        parts = [(0, len(gradient))]

        def gain(low: int, high: int) -> tuple[float, int]:
            if high - low < 2:
                return 0.0, low
            at = np.arange(low + 1, high)
            left, right, all_ = ((g[at] - g[low]), (g[high] - g[at]), g[high] - g[low])
            hl, hr = h[at] - h[low], h[high] - h[at]
            value = left ** 2 / (hl + 1) + right ** 2 / (hr + 1) - all_ ** 2 / (hl + hr + 1)
            value[(hl < 2) | (hr < 2)] = 0.0  # a leaf needs some weight
            best = int(value.argmax())
            return float(value[best]), int(at[best])

        while len(parts) < leaves:
            found = [(*gain(*p), p) for p in parts]
            best, cut, part = max(found)
            if best <= 1e-9:
                break
            parts.remove(part)
            parts += [(part[0], cut), (cut, part[1])]
        out = np.zeros(len(gradient))
        for low, high in parts:
            out[low:high] = (g[high] - g[low]) / (h[high] - h[low] + 1)
        return out

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> "AdditiveModel":
        model = cls([cls._cuts(c, BINS) for c in x.T], [cls._cuts(c, PAIR_BINS) for c in x.T])
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        model.base = float(np.log(share / (1 - share)))
        bins = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T)]
        coarse = [np.searchsorted(e, c, side="right") for e, c in zip(model.pair_edges, x.T)]
        margin = np.full(len(y), model.base)

        def slopes() -> tuple[np.ndarray, np.ndarray]:
            p = 1 / (1 + np.exp(-margin))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for f, b in enumerate(bins):
                g, h = slopes()
                size = len(model.tables[f])
                step = RATE * cls._small_tree(np.bincount(b, g, size), np.bincount(b, h, size))
                model.tables[f] += step
                margin += step[b]
        g, h = slopes()
        gains = []
        for i, j in combinations(range(len(bins)), 2):
            cell = coarse[i] * PAIR_BINS + coarse[j]
            gains.append(((np.bincount(cell, g) ** 2 / (np.bincount(cell, h) + 1)).sum(), i, j))
        model.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
        model.cells = [np.zeros(PAIR_BINS * PAIR_BINS) for _ in model.pairs]
        for _ in range(PAIR_ROUNDS):
            for k, (i, j) in enumerate(model.pairs):
                cell = coarse[i] * PAIR_BINS + coarse[j]
                g, h = slopes()
                step = RATE * np.bincount(cell, g, len(model.cells[k])) / (np.bincount(cell, h, len(model.cells[k])) + 5)
                model.cells[k] += step
                margin += step[cell]
        return model

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for e, t, c in zip(self.edges, self.tables, x.T):
            out += t[np.searchsorted(e, c, side="right")]
        for (i, j), t in zip(self.pairs, self.cells):
            cell = (np.searchsorted(self.pair_edges[i], x[:, i], side="right") * PAIR_BINS
                    + np.searchsorted(self.pair_edges[j], x[:, j], side="right"))
            out += t[cell]
        return out


def _score(model: AdditiveModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(name).to_numpy() for name in FEATURES])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(1 / (1 + np.exp(-model.log_odds(x))))], names=["doc_id", "score"])
    return run


def score(
    documents: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS,
    threshold: float = 0.3, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every text.

    The model is fitted on ``train_rows`` labelled texts outside the held-out fold, chosen
    by hash. A null text counts as empty, and an empty text is scored like any other; without
    both labels every score is the share of label 1 (0 without labels); a null id counts as
    not held out; repeated rows are scored each for itself; other columns are not looked at.
    """
    made = stored(text_features(documents, id_column, text_column), "features")
    known = stored(label_rows(labels, label), "labels")
    sample = (with_labels(made, known).orderBy(F.xxhash64("doc_id"), *FEATURES).limit(train_rows)
              .select(*FEATURES, "label").toPandas())
    y = sample.label.to_numpy(np.float64)
    if len(set(y)) < 2:
        scored = made.select("doc_id", F.lit(float(y.mean()) if len(y) else 0.0).alias("score"))
    else:
        model = AdditiveModel.fit(sample[FEATURES].to_numpy(np.float64), y)
        scored = made.mapInArrow(_score(model), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"), table(spark, folder, "labels"))
