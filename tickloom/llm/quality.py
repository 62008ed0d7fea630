"""Quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import per_text, quoted, remainder, stored, text_or_empty

# Labelled rows that a model is fitted on, at most: those with the smallest hashes of their ids.
MAX_LABELLED = 20_000
HELD_OUT, HELD_OUT_REST = 3, 1

FEATURES = (
    "log_words",
    "word_length",
    "upper",
    "digits",
    "symbols",
    "bars",
    "exclamations",
    "stops",
    "commas",
    "beyond_ascii",
    "same_as_last",
    "distinct",
    "titled",
    "compressed",
    "line_words",
    "repeated_lines",
)
# Byte classes: 0 other letters, 1 upper case, 2 digits, 3 symbols, 4 |, 5 !, 6 . ? ; :, 7 comma, 8 beyond ASCII, 9 white space.
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 3
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
for _chars, _code in (("|", 4), ("!", 5), (".?;:'\"()-", 6), (",", 7)):
    for _c in _chars:
        _CLASS[ord(_c)] = _code
_CLASS[128:] = 8
_CLASS[:33] = 9


def features(text: str) -> list[float]:
    """Numbers about the form of a text, of any language; those of an empty text are zero."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    n, lines = len(words), text.split("\n")
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=10) / n
    return [
        math.log(n),
        (len(text) - n) / n,
        kinds[1],
        kinds[2],
        kinds[3],
        kinds[4],
        kinds[5],
        kinds[6],
        kinds[7],
        kinds[8],
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        sum(map(str.istitle, words)) / n,
        len(zlib.compress(raw, 1)) / len(raw),
        n / len(lines),
        1 - len(set(lines)) / len(lines),
    ]


@dataclass(frozen=True)
class Boosting:
    """Bins per feature and per side of a pair, pairs, rounds, step and smoothing."""

    bins: int = 48
    pair_bins: int = 10
    pairs: int = 8
    rounds: int = 150
    pair_rounds: int = 60
    step: float = 0.15
    smooth: float = 1.0
    least_rows: int = 5


@dataclass
class Model:
    """Lookup tables over bins: a score is their sum, as log odds of a good text."""

    base: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pair_edges: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (feature, feature, table)

    def odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], side="right")]
        for f, g, table in self.pairs:
            i = np.searchsorted(self.pair_edges[f], x[:, f], side="right")
            total += table[i, np.searchsorted(self.pair_edges[g], x[:, g], side="right")]
        return total


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts at quantiles, between values that differ."""
    distinct = np.unique(values)
    if len(distinct) <= bins:
        return (distinct[1:] + distinct[:-1]) / 2
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h, smooth: float):
    return g * g / (h + smooth)


def _shallow(g: np.ndarray, h: np.ndarray, rows: np.ndarray, how: Boosting, depth: int = 2) -> np.ndarray:
    """The values of a regression tree over ordered bins, from sums of residuals and weights."""
    if depth and len(g) > 1:
        left_g, left_h, left_n = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(rows)[:-1]
        gains = _gain(left_g, left_h, how.smooth) + _gain(g.sum() - left_g, h.sum() - left_h, how.smooth)
        gains[(left_n < how.least_rows) | (rows.sum() - left_n < how.least_rows)] = -np.inf
        cut = int(np.argmax(gains)) + 1
        if gains[cut - 1] > _gain(g.sum(), h.sum(), how.smooth):
            parts = (slice(None, cut), slice(cut, None))
            return np.concatenate([_shallow(g[p], h[p], rows[p], how, depth - 1) for p in parts])
    return np.full(len(g), g.sum() / (h.sum() + how.smooth))


def _quadrants(g: np.ndarray, h: np.ndarray, how: Boosting) -> tuple[float, np.ndarray]:
    """The best cut of a grid into four parts: its gain over none, and the parts' values."""
    cg, ch = (np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (g, h))

    def parts(c: np.ndarray) -> tuple:
        inner = c[1:-1, 1:-1]
        right, low = c[1:-1, -1:] - inner, c[-1:, 1:-1] - inner
        return inner, right, low, c[-1, -1] - inner - right - low

    gains = sum(_gain(a, b, how.smooth) for a, b in zip(parts(cg), parts(ch)))
    if not gains.size:
        return 0.0, np.zeros_like(g)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = np.zeros_like(g)
    for rows in (slice(None, i + 1), slice(i + 1, None)):
        for columns in (slice(None, j + 1), slice(j + 1, None)):
            values[rows, columns] = g[rows, columns].sum() / (h[rows, columns].sum() + how.smooth)
    return float(gains[i, j] - _gain(g.sum(), h.sum(), how.smooth)), values


def train(x: np.ndarray, y: np.ndarray, how: Boosting = Boosting()) -> Model:
    """Boosts one feature's table after the other, round by round, and then those of the best pairs."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Model(base)
    edges = [_edges(x[:, f], how.bins) for f in range(x.shape[1])]
    pair_edges = [_edges(x[:, f], how.pair_bins) for f in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(pair_edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    rows = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, tables)]
    odds = np.full(len(y), base)

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-odds))
        return y - p, p * (1 - p)

    for _ in range(how.rounds):
        for f, table in enumerate(tables):
            r, w = residuals()
            g, h = (np.bincount(bins[f], v, len(table)) for v in (r, w))
            step = how.step * _shallow(g, h, rows[f], how)
            table += step
            odds += step[bins[f]]

    def grid(f: int, g: int, values: np.ndarray) -> np.ndarray:
        shape = (len(pair_edges[f]) + 1, len(pair_edges[g]) + 1)
        return np.bincount(coarse[f] * shape[1] + coarse[g], values, shape[0] * shape[1]).reshape(shape)

    r, w = residuals()
    ranked = sorted(combinations(range(x.shape[1]), 2), key=lambda p: -_quadrants(grid(*p, r), grid(*p, w), how)[0])
    chosen = [(f, g, np.zeros((len(pair_edges[f]) + 1, len(pair_edges[g]) + 1))) for f, g in ranked[: how.pairs]]
    for _ in range(how.pair_rounds):
        for f, g, table in chosen:
            r, w = residuals()
            step = how.step * _quadrants(grid(f, g, r), grid(f, g, w), how)[1]
            table += step
            odds += step[coarse[f], coarse[g]]
    return Model(base, edges, tables, pair_edges, chosen)


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, how: Boosting = Boosting()) -> Model:
    """A model from at most `limit` labelled rows that are not held out, each different text once.

    Their features are made on the executors; the table of features, bounded by `limit`, is fitted
    on the driver. With labels of one kind, or none, the score is that share (or one half).
    """
    rows = (
        labels.where(F.col("quality").isNotNull() & (remainder(F.col("doc_id"), HELD_OUT) != HELD_OUT_REST))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
        .select(F.col("doc_id").alias("label_id"), "quality")
    )
    met = docs.select(quoted("doc_id").alias("id"), text_or_empty().alias("text")).join(
        F.broadcast(rows),  # `limit` rows at most
        F.col("id") == F.col("label_id"),
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            columns = [
                pa.array([features(t) for t in texts], pa.list_(pa.float64())),
                batch.column(1).cast(pa.int32()),
                pa.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["x", "y", "key"])

    measured = met.select("text", "quality").mapInArrow(measure, "x array<double>, y int, key long")
    found = stored(measured.dropDuplicates(["x", "y", "key"]), "quality-features").orderBy("key", "y", "x").collect()
    x = np.array([r["x"] for r in found]).reshape(-1, len(FEATURES))
    return train(x, np.array([r["y"] for r in found], float), how)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) per row of `docs`: the chance of a good text, and 1 from one half on.

    A batch's features are binned and its tables added up at once. Null texts count as empty; every row
    gives one row, repeated and null ids included, and rows with the same text get the same score.
    """

    def make():
        def run(texts: list[str]) -> dict[str, list]:
            x = np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))
            chance = 1 / (1 + np.exp(-model.odds(x)))
            return {"score": chance, "predicted": (chance >= 0.5).astype(np.int32)}

        return run

    return per_text(docs, make, "score double, predicted int", id_col, text_col)
