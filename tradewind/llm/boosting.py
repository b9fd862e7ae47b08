"""Quality scores of texts by histogram gradient-boosted trees over document statistics.

The statistics of every text are computed once, block by block, and stored as short arrays. A
model is fitted on a bounded sample of labelled texts: the statistics are cut into bins at
quantiles, each tree is grown level by level from histograms of gradients over the bins, and
the trees, all of the same depth, are kept as flat arrays of features, limits and leaf values.
Scoring walks all rows of a batch down all trees at once with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.text import power_tables, shingles, text_blocks, word_hashes, word_spans
from tradewind.session import keep

# Labelled texts that a model is fitted on at most: those with the least hashes of their ids.
SAMPLE_ROWS = 20_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
LEAST_WEIGHT = 2.0

# Classes of bytes.
_KINDS = ("other", "lower", "upper", "digit", "space", "newline", "stop", "comma", "shout", "pipe", "symbol", "lead", "tail")
_KIND = np.zeros(256, np.uint8)
for _name, _bytes in {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "space": (32, 9, 11, 12, 13),
    "newline": (10,),
    "stop": b".?",
    "comma": b",;:",
    "shout": b"!",
    "pipe": b"|",
    "symbol": b"#*$%&<>",
    "lead": range(192, 256),
    "tail": range(128, 192),
}.items():
    _KIND[list(_bytes)] = _KINDS.index(_name)

FEATURES = (
    *(f"share_{k}" for k in _KINDS),
    "log_words",
    "word_length",
    "word_length_spread",
    "long_words",
    "distinct_words",
    "commonest_word",
    "doubled_words",
    "repeated_windows",
    "words_per_stop",
    "words_per_line",
)


def statistics(data: np.ndarray, offsets: np.ndarray, tables) -> np.ndarray:
    """The features of each text of a block, a row each; all 0 for a text without words."""
    n, kinds = len(offsets) - 1, len(_KINDS)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    count = np.bincount(row * kinds + _KIND[data], minlength=n * kinds).reshape(n, kinds).astype(float)
    out = np.zeros((n, len(FEATURES)), np.float32)
    out[:, :kinds] = count / np.maximum(sizes, 1)[:, None]
    starts, ends, first = word_spans(data, offsets)
    words, _ = word_hashes(data, offsets, tables)
    lengths = (ends - starts).astype(float)
    for i in range(n):
        own, size = words[first[i] : first[i + 1]], lengths[first[i] : first[i + 1]]
        m = len(own)
        if m == 0:
            out[i] = 0
            continue
        _, times = np.unique(own, return_counts=True)
        windows = shingles(own, 5)
        out[i, kinds:] = (
            np.log1p(m),
            size.mean(),
            size.std(),
            (size > 16).mean(),
            len(times) / m,
            times.max() / m,
            (own[1:] == own[:-1]).sum() / m,
            1 - len(np.unique(windows)) / len(windows),
            m / (1 + count[i, _KINDS.index("stop")]),
            m / (1 + count[i, _KINDS.index("newline")]),
        )
    return out


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tables = power_tables()
    for batch in batches:
        found = [statistics(data, offsets, tables) for _, _, data, offsets in text_blocks(batch.column("text"))]
        flat = np.concatenate(found).reshape(-1) if found else np.zeros(0, np.float32)
        column = pa.FixedSizeListArray.from_arrays(pa.array(flat), len(FEATURES)).cast(pa.list_(pa.float32()))
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*kept, column], names=[*batch.schema.names[:-1], "features"])


def featured(docs: DataFrame, ids: list[str]) -> DataFrame:
    """``ids`` and an array ``features`` of each text; a null text counts as empty."""
    rows = docs.select(*ids, "text")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_featured, f"{fields}features array<float>")


@dataclass(frozen=True)
class Model:
    """Trees of equal depth as arrays: a row per tree, nodes in breadth-first order."""

    start: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The chance of label 1 of each row of features."""
        depth = self.leaf.shape[1].bit_length() - 1
        odds = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            odds += leaf[node - (len(leaf) - 1)]
        return 1 / (1 + np.exp(-odds))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS) -> Model:
    """Boost logistic loss. Without rows every score is a half; with one label, near that label.

    A node that no split improves sends all rows to the left.
    """
    n, width = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    mean = (y.sum() + 0.5) / (n + 1)
    start = float(np.log(mean / (1 - mean)))
    if n == 0 or y.min() == y.max():
        return Model(start, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(width)], axis=1)
    features = np.zeros((trees, inner), np.int64)
    limits = np.full((trees, inner), np.inf)
    values = np.zeros((trees, leaves))
    odds = np.full(n, start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-odds))
        gradient, weight = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            best = np.zeros(many)
            chosen = np.zeros(many, np.int64)
            cut = np.full(many, bins, np.int64)
            for j in range(width):
                at = (node - first) * bins + binned[:, j]
                g = np.bincount(at, gradient, many * bins).reshape(many, bins).cumsum(axis=1)
                h = np.bincount(at, weight, many * bins).reshape(many, bins).cumsum(axis=1)
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + RIDGE) + (whole_g - g) ** 2 / (whole_h - h + RIDGE) - whole_g**2 / (whole_h + RIDGE)
                gain[(h < LEAST_WEIGHT) | (whole_h - h < LEAST_WEIGHT)] = 0
                gain[:, len(edges[j]) :] = 0
                place = gain.argmax(axis=1)
                top = gain[np.arange(many), place]
                better = top > best + 1e-9
                best[better], chosen[better], cut[better] = top[better], j, place[better]
            for k in range(many):
                if cut[k] < bins:
                    features[t, first + k] = chosen[k]
                    limits[t, first + k] = edges[chosen[k]][cut[k]]
            side = binned[np.arange(n), chosen[node - first]] > cut[node - first]
            node = 2 * node + 1 + side
        g = np.bincount(node - inner, gradient, leaves)
        h = np.bincount(node - inner, weight, leaves)
        values[t] = -RATE * g / (h + RIDGE)
        odds += values[t][node - inner]
    return Model(start, features, limits, values)


def train(found: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` labelled texts of ``found`` (doc_id, features).

    ``labels`` has doc_id and label, 0 or 1; labels of one id are averaged, and ids or labels
    that are null are left out. The sample is those with the least hashes of their id, so it
    depends on the ids alone.
    """
    known = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.avg("label").alias("label"))
    joined = found.select("doc_id", "features").join(keep(known, "labels"), "doc_id")
    sample = joined.orderBy(F.xxhash64("doc_id", F.lit("sample")), "doc_id", "features").limit(rows).toArrow()
    y = sample.column("label").to_numpy() >= 0.5
    x = np.array(sample.column("features").to_pylist(), np.float32).reshape(len(y), len(FEATURES))
    return fit(x, y.astype(float))


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("features")
        x = column.flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
        kept = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(model.scores(x))], names=[*batch.schema.names[:-1], "score"])


def scored(found: DataFrame, model: Model, ids: list[str]) -> DataFrame:
    """``ids`` and score, from 0 to 1, of each row of ``found`` (ids, features)."""
    rows = found.select(*ids, "features")
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    return rows.mapInArrow(partial(_scored, model=model), f"{fields}score double")
