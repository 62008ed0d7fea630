"""Near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import quoted, stored
from tickloom.llm.components import components
from tickloom.llm.vectors import BLOCK_ROWS, MAX_SAMPLE, by_length, distances, each_batch, kmeans, matrix, packed, sample, unit, usable

COSINE = 0.95
# Share of links just at the threshold that the traversals of both ends together must reach.
RECALL = 0.999
# Vectors per cell of the product grid, about, codewords per half, at most, and sampled rows for each.
CELL_ROWS, MAX_CODES, CODE_ROWS = 400, 1024, 20


@dataclass(frozen=True)
class MultiIndex:
    """A codebook for each half of a unit vector; cell (i, j) has number i * len(right) + j."""

    left: np.ndarray
    right: np.ndarray
    visits: int = 1

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.left.shape[1]
        return distances(x[:, :cut], self.left), distances(x[:, cut:], self.right)

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * len(self.right) + b.argmin(1)

    def visited(self, x: np.ndarray, most: int | None = None) -> np.ndarray:
        """The nearest cells of each row, nearest first, by multi-sequence traversal."""
        most = min(most or self.visits, len(self.left) * len(self.right))
        a, b = self.halves(x)
        order_a, order_b = a.argsort(1), b.argsort(1)
        out = np.empty((len(x), most), np.int64)
        for row in range(len(x)):
            out[row] = _traverse(a[row], b[row], order_a[row], order_b[row], most, len(self.right))
        return out


def _traverse(a, b, order_a, order_b, most: int, width: int) -> list[int]:
    """Cells in order of the sum of both distances: after (i, j) come (i + 1, j) and (i, j + 1)."""
    da, db = a[order_a].tolist(), b[order_b].tolist()
    heap, seen, out = [(da[0] + db[0], 0, 0)], {(0, 0)}, []
    while len(out) < most:
        _, i, j = heapq.heappop(heap)
        out.append(int(order_a[i]) * width + int(order_b[j]))
        for i2, j2 in ((i + 1, j), (i, j + 1)):
            if i2 < len(da) and j2 < len(db) and (i2, j2) not in seen:
                seen.add((i2, j2))
                heapq.heappush(heap, (da[i2] + db[j2], i2, j2))
    return out


def _codes(total: int) -> int:
    return int(np.clip(round((total / CELL_ROWS) ** 0.5), 1, MAX_CODES))


def _ranks(index: MultiIndex, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """The place of one cell for each row in the order in which its traversal visits them."""
    a, b = index.halves(x)
    width = len(index.right)
    out = np.empty(len(x), np.int64)
    for row, cell in enumerate(cells.tolist()):
        far = a[row, cell // width] + b[row, cell % width]
        nearer = np.searchsorted(np.sort(b[row]), far * (1 + 1e-12) - a[row], side="right")
        out[row] = max(1, int(nearer.sum()))
    return out


def fit(x: np.ndarray, total: int, cosine: float = COSINE, recall: float = RECALL) -> MultiIndex:
    """An index for `total` vectors from a sample of unit vectors.

    The number of cells to visit is the smallest that reaches the target recall on made-up partners
    of sampled vectors, in random directions at exactly the least cosine. A pair is found when either
    visits the cell of the other, so of both ranks the smaller one counts.
    """
    codes = _codes(total)
    cut = max(1, x.shape[1] // 2)
    index = MultiIndex(kmeans(x[:, :cut], codes), kmeans(x[:, cut:], codes))
    if x.shape[1] < 2:
        return MultiIndex(index.left, np.zeros((1, 0)), len(index.left))
    rng = np.random.default_rng(11)
    some = x[rng.permutation(len(x))[:2000]]
    side = rng.standard_normal(some.shape)
    side = unit(side - (side * some).sum(1, keepdims=True) * some)
    partners = cosine * some + (1 - cosine**2) ** 0.5 * side
    ranks = np.minimum(_ranks(index, some, index.cells(partners)), _ranks(index, partners, index.cells(some)))
    most = len(index.left) * len(index.right)
    return MultiIndex(index.left, index.right, most if recall >= 1 else int(np.quantile(ranks, recall, method="higher")))


def _forest(a: np.ndarray, b: np.ndarray, count: int) -> np.ndarray:
    """For nodes 0..count-1 and links (a, b): the smallest node of each node's component."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(id, n_links, component_id, kept) per row of `vectors`, whose ids are integers.

    Equal vectors are one class, which their smallest id stands for. Each class is stored in one cell
    of the grid and looks for partners in the cells it visits; a pair counts when either visits the
    other. Cosines are taken of whole vectors in double precision, so no link is below the threshold.
    A block of classes meets a block of stored ones at a time: it gives a count for each vector and
    the links of a spanning forest, never all pairs. Vectors of each length are a collection of their
    own, with an index of its own unless it is small. Vectors that are null, zero or not finite link with
    nothing; a row without an id has no component and is kept.
    """
    hashed = {"d1": F.xxhash64(F.size("v"), "v"), "d2": F.xxhash64(F.lit(1), "v")}
    classes = stored(
        usable(vectors, id_col, vector_col)
        .withColumns(hashed)
        .groupBy("d1", "d2")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")),
        "vector-classes",
    )
    collections, rest = by_length(classes)
    known = classes.select("d1", "d2", F.col("id").alias("a"), "n")
    if collections:
        links = []
        for _, count, rows in collections:
            some = sample(rows, max(MAX_SAMPLE, CODE_ROWS * _codes(count)))
            links.append(_found(rows, fit(unit(some), count, cosine, recall), cosine))
        if rest is not None:
            links.append(_found_among(rest, cosine))
        found = stored(reduce(DataFrame.unionByName, links), "vector-links")
        counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("linked"))
        labels = components(found.where("b is not null").select("a", "b")).withColumnRenamed("id", "a")
        known = known.join(counts, "a", "left").join(labels, "a", "left")
    else:
        known = known.withColumns({"linked": F.lit(0), "component": F.lit(None).cast("long")})
    known = known.select(
        "d1",
        "d2",
        (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "a").alias("component"),
    )
    rows = vectors.select(quoted(id_col).alias("id"), quoted(vector_col).cast(classes.schema["v"].dataType).alias("v")).select(
        "id", *[F.when(F.col("id").isNotNull(), h).alias(c) for c, h in hashed.items()]
    )
    return _result(rows.join(known, ["d1", "d2"], "left"), id_col)


def _result(rows: DataFrame, id_col: str) -> DataFrame:
    component = F.coalesce("component", F.col("id").cast("long"))
    return rows.select(
        F.col("id").alias(id_col),
        F.coalesce(F.col("n_links").cast("long"), F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _links(ids: np.ndarray, many: np.ndarray, i: np.ndarray, j: np.ndarray, extra=None) -> pa.Table:
    """(a, b, n): the links of a spanning forest over pairs of rows (i, j), and with null b, how many vectors
    each i links with; `extra` adds to the counts of named rows."""
    names, place = np.unique(ids, return_inverse=True)
    count = np.bincount(place[i], many[j], len(names))
    if extra is not None:
        count += np.bincount(place[extra[0]], many[extra[1]], len(names))
    label = _forest(place[i], place[j], len(names))
    joined = np.flatnonzero(label != np.arange(len(names)))
    some = np.flatnonzero(count)
    return pa.table(
        {
            "a": pa.array(np.concatenate([names[some], names[joined]])),
            "b": pa.array([None] * len(some) + names[label[joined]].tolist(), pa.int64()),
            "n": pa.array(np.concatenate([count[some].astype(np.int64), np.zeros(len(joined), np.int64)])),
        }
    )


LINKS = "a long, b long, n long"


def _found_among(classes: DataFrame, cosine: float) -> DataFrame:
    """The links of collections of at most SMALL_ROWS vectors of one length each, all compared."""

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, many = table.column("id").to_numpy(), table.column("n").to_numpy()
        x = unit(matrix(table.column("v").combine_chunks()))
        i, j = np.nonzero(x @ x.T >= cosine)
        other = ids[i] != ids[j]
        return _links(ids, many, i[other], j[other])

    return classes.withColumn("width", F.size("v")).groupBy("width").applyInArrow(meet, LINKS)


def _found(classes: DataFrame, index: MultiIndex, cosine: float) -> DataFrame:
    """The links of vectors of one length, by the index."""
    vector = classes.schema["v"].dataType.simpleString()

    def place(ids: np.ndarray, x: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch:
        x = unit(x)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(1), pa.array(index.cells(x)), packed(index.visited(x))],
            names=["id", "n", "v", "cell", "visits"],
        )

    placed = classes.select("id", "v", "n").mapInArrow(each_batch(place), f"id long, n long, v {vector}, cell long, visits array<long>")
    placed = stored(placed, "vector-cells")
    # At most MAX_CODES ** 2 cells of a few numbers; a large one is dealt out over blocks on both sides.
    held = placed.groupBy(F.col("cell").alias("at")).agg(F.count(F.lit(1)).alias("held"))
    asked = placed.select(F.explode("visits").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("asking"))
    parts = [F.ceil(F.coalesce(n, F.lit(1)) / BLOCK_ROWS).cast("int").alias(f"parts_{n}") for n in ("held", "asking")]
    shape = F.broadcast(stored(held.join(asked, F.col("at") == F.col("c"), "left").select("at", *parts), "vector-grid"))

    def dealt(rows: DataFrame, asks: bool) -> DataFrame:
        """A row goes to one part of its own side, and meets all parts of the other."""
        own, other = ("parts_asking", "parts_held") if asks else ("parts_held", "parts_asking")
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        theirs = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        held_part, asking_part = (theirs, mine) if asks else (mine, theirs)
        return rows.join(shape, "at").select(
            "id", "n", "v", "at", F.lit(asks).alias("asks"), held_part.alias("s"), asking_part.alias("q")
        )

    stored_rows = dealt(placed.select("id", "n", "v", F.col("cell").alias("at")), False)
    asking = dealt(placed.select("id", "n", "v", F.explode("visits").alias("at")), True)

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks = table.column("asks").to_numpy()
        ids, many = table.column("id").to_numpy(), table.column("n").to_numpy()
        x = unit(matrix(table.column("v").combine_chunks()))
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        i, j = np.nonzero(x[left] @ x[right].T >= cosine)
        i, j = left[i], right[j]
        i, j = i[ids[i] != ids[j]], j[ids[i] != ids[j]]
        unseen = None
        if len(i):
            # A stored vector that does not visit the asking one's cell would not count it itself.
            cells, partners = index.cells(x), np.unique(j)
            visits = dict(zip(partners.tolist(), map(set, index.visited(x[partners]).tolist())))
            missed = np.array([cells[a] not in visits[b] for a, b in zip(i.tolist(), j.tolist())], bool)
            unseen = j[missed], i[missed]
        return _links(ids, many, i, j, unseen)

    return stored_rows.unionByName(asking).groupBy("at", "s", "q").applyInArrow(meet, LINKS)
