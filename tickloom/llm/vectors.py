"""What the vector operators share: which vectors take part, samples, k-means, and blocks of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import quoted

# Rows that codebooks and thresholds are fitted on, at most: those with the smallest hashes of their ids.
MAX_SAMPLE = 10_000
# Rows of a block that a task multiplies at once.
BLOCK_ROWS = 2048


# Collections of vectors of one length with so few rows are compared as they are, without an index.
SMALL_ROWS = 2048


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): rows with an id and a vector that is finite and not zero, of any length.

    Vectors of single precision stay so: what is computed of them is double, but half the bytes travel.
    """
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(quoted(id_col).alias("id"), quoted(vector_col).cast(kind).alias("v"))
    return rows.where(
        F.col("id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )


def by_length(rows: DataFrame) -> tuple[list[tuple[int, int, DataFrame]], DataFrame | None]:
    """([(length, count, rows)], rest): collections of vectors of one length.

    Those above SMALL_ROWS, and the commonest, come one by one; there are few, as each is large. All
    others are in `rest`. The counts, a row for each length, are on the driver.
    """
    counts = sorted(((r["count"], r["width"]) for r in rows.groupBy(F.size("v").alias("width")).count().collect()), reverse=True)
    large = [(width, count) for i, (count, width) in enumerate(counts) if i == 0 or count > SMALL_ROWS]
    parts = [(width, count, rows.where(F.size("v") == width) if len(counts) > 1 else rows) for width, count in large]
    rest = rows.where(~F.size("v").isin([width for width, _ in large])) if len(large) < len(counts) else None
    return parts, rest


def sample(rows: DataFrame, limit: int = MAX_SAMPLE) -> np.ndarray:
    """At most `limit` vectors, one per row, on the driver."""
    taken = rows.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(limit).select("v").toArrow().column(0)
    return matrix(taken.combine_chunks()) if len(taken) else np.zeros((0, 0))


def matrix(lists: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return x / np.linalg.norm(x, axis=1, keepdims=True) if len(x) else x


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of `x` to all centres."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, balance: float = 0.0, seed: int = 7) -> np.ndarray:
    """Centres of at most `k` clusters; with `balance`, clusters above their share lose rows to others."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    if not k:
        return np.zeros((0, x.shape[1]))
    centres = distinct[rng.choice(len(distinct), k, replace=False)]
    penalty = np.zeros(k)
    for _ in range(rounds):
        d = distances(x, centres)
        own = (d + penalty).argmin(1)
        size = np.bincount(own, minlength=k)
        if balance:
            penalty += balance * d.min(1).mean() * (size * k / len(x) - 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table to be broadcast, of rows whose number a parameter bounds (cells, lists or blocks)."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def each_batch(work):
    """A function over Arrow batches from one over (ids, matrix) that returns a batch or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                out = work(batch.column(0).to_numpy(), matrix(batch.column(1)), batch)
                if out is not None:
                    yield out

    return run


def packed(x: np.ndarray) -> pa.ListArray:
    width = x.shape[1] if x.ndim == 2 else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(x.ravel()))
