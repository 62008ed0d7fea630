"""Nearest neighbours by balanced posting lists and an in-memory graph of their centroids."""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import stored
from tickloom.llm.vectors import MAX_SAMPLE, by_length, distances, each_batch, kmeans, matrix, packed, sample, small_table, usable

NEAREST = 20
# Share of true neighbours, found by brute force in a sample, whose lists the pruning must let through.
RECALL = 0.97
# Vectors per list, about, lists at most, and sampled rows for each.
LIST_ROWS, MAX_LISTS, SAMPLED_ROWS = 256, 16_384, 8
# Lists beyond which centroids are fitted in two levels.
ONE_LEVEL = 1024
# Rows whose distances to all centroids are held at a time.
CENTRE_ROWS = 128
# A vector also goes to lists that are at most this much farther than its nearest, MAX_COPIES in all.
BOUNDARY, MAX_COPIES = 1.1, 4
BALANCE = 0.05
NEIGHBOURS, SAMPLED_QUERIES = 24, 400
# Vectors of a block at most (each query gets its best few of a block, so blocks are large) and at least
# (small tables are dealt over the cores), and queries that are multiplied with them at a time.
BLOCK_ROWS, LEAST_BLOCK, SLICE = 8192, 1024, 256
# Numbers beyond 2 to this power, or all below its inverse, are scaled before they are multiplied.
SAFE_POWER = 500


@dataclass(frozen=True)
class Lists:
    """Centroids in the space where the largest inner product is the least distance, and their graph."""

    centres: np.ndarray
    graph: np.ndarray
    norm: float  # the largest length of a vector
    ratio: float = 1.0

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with one more component that gives all of them the same length."""
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0))
        return np.column_stack([x, rest])

    def asked(self, q: np.ndarray) -> np.ndarray:
        """Queries in the same space; their length does not matter, so it is that of the vectors."""
        scaled = q * (self.norm / np.linalg.norm(q, axis=1, keepdims=True))
        return np.column_stack([scaled, np.zeros(len(q))])

    def memberships(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists that hold each vector: its nearest, and near ones in other directions."""
        out = []
        for start in range(0, len(x), CENTRE_ROWS):
            d = np.sqrt(distances(self.lifted(x[start : start + CENTRE_ROWS]), self.centres))
            most = min(2 * MAX_COPIES, d.shape[1])
            near = np.argpartition(d, most - 1, axis=1)[:, :most] if most < d.shape[1] else np.tile(np.arange(most), (len(d), 1))
            near = np.take_along_axis(near, np.take_along_axis(d, near, 1).argsort(1, kind="stable"), 1)
            for row, order in zip(d, near):
                held = [order[0]]
                for c in order[1:]:
                    if len(held) == MAX_COPIES or row[c] > BOUNDARY * row[order[0]]:
                        break
                    if (self._far(self.centres[c], np.array(held)) > row[c]).all():
                        held.append(c)
                out.append(np.array(held))
        return out

    def chosen(self, q: np.ndarray, sizes: np.ndarray, nearest: int) -> list[np.ndarray]:
        """The lists that each query reads: those within the ratio, and enough to fill the answer."""
        out = []
        least = (nearest + 1) * MAX_COPIES
        for query in self.asked(q):
            order, d = self.search(query, self.ratio)
            within = int(np.searchsorted(d, self.ratio * d[0] + 1e-12, side="right"))
            enough = int(np.searchsorted(np.cumsum(sizes[order]), least)) + 1
            if enough > within:
                order, d = self.search(query, np.inf)
                enough = int(np.searchsorted(np.cumsum(sizes[order]), least)) + 1
            out.append(order[: max(within, enough)])
        return out

    def search(self, query: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Centroids by distance, best first over the graph, until none within the ratio is left.

        Each step opens the nearest centroid not yet opened; the search goes on a little beyond the
        ratio, as the way to a near centroid may lead through a farther one.
        """
        d = {0: self._far(query, np.array([0]))[0]}
        heap, opened, best = [(d[0], 0)], 0, d[0]
        while heap:
            here, node = heapq.heappop(heap)
            if here > 1.1 * ratio * best and opened >= NEIGHBOURS:
                break
            opened += 1
            new = [c for c in self.graph[node].tolist() if c not in d]
            for c, far in zip(new, self._far(query, np.array(new, int)).tolist()):
                d[c] = far
                best = min(best, far)
                heapq.heappush(heap, (far, c))
        order = np.array(sorted(d, key=lambda c: (d[c], c)))
        return order, np.array([d[c] for c in order])

    def _far(self, query: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.centres[nodes] - query) ** 2).sum(1))


def _graph(centres: np.ndarray) -> np.ndarray:
    """Each centroid's nearest others, and the next one by number, so that all can be reached."""
    most = min(NEIGHBOURS, len(centres))
    near = np.empty((len(centres), most), int)
    for start in range(0, len(centres), CENTRE_ROWS):
        d = distances(centres[start : start + CENTRE_ROWS], centres)
        d[np.arange(len(d)), start + np.arange(len(d))] = np.inf
        near[start : start + len(d)] = d.argsort(1)[:, :most]
    return np.column_stack([near, (np.arange(len(centres)) + 1) % len(centres)])


def _centres(x: np.ndarray, count: int) -> np.ndarray:
    """Balanced centroids; many of them by clusters within clusters, as many in each as it has rows for."""
    if count <= ONE_LEVEL:
        return kmeans(x, count, balance=BALANCE)
    coarse = kmeans(x, round(count**0.5), balance=BALANCE)
    own = np.concatenate([distances(x[i : i + CENTRE_ROWS], coarse).argmin(1) for i in range(0, len(x), CENTRE_ROWS)])
    parts = [x[own == c] for c in range(len(coarse))]
    return np.concatenate([kmeans(part, max(1, round(count * len(part) / len(x))), balance=BALANCE) for part in parts if len(part)])


def _lists(total: int) -> int:
    return int(np.clip(round(total / LIST_ROWS), 1, MAX_LISTS))


def fit(x: np.ndarray, total: int, norm: float, nearest: int = NEAREST, recall: float = RECALL) -> Lists:
    """Lists for `total` vectors from a sample; the pruning ratio reaches `recall` on sampled queries."""
    lists = Lists(np.zeros((1, x.shape[1] + 1)), np.zeros((1, 1), int), norm)
    centres = _centres(lists.lifted(x), _lists(total))
    lists = Lists(centres, _graph(centres), norm)
    some = x[np.random.default_rng(5).permutation(len(x))[:SAMPLED_QUERIES]]
    held = lists.memberships(x)
    ratios = []
    for start in range(0, len(some), CENTRE_ROWS):
        part = some[start : start + CENTRE_ROWS]
        d = np.sqrt(distances(lists.asked(part), centres))
        top = np.argpartition(-(part @ x.T), min(nearest, len(x) - 1), axis=1)[:, : nearest + 1]
        # The ratio grows with the share of a collection that the sample is, so the sample errs to the wide side.
        ratios += [min(d[q, c] for c in held[v]) / d[q].min() for q, row in enumerate(top) for v in row]
    return Lists(centres, lists.graph, norm, float(np.quantile(ratios, recall)))


def nearest_vectors(
    vectors: DataFrame,
    every: int = 20,
    nearest: int = NEAREST,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, id, score) for queries whose id is divisible by `every`, against all rows.

    The score is the inner product in double precision; rank 1 is the largest, ties go to the smaller
    id, and a query's own id is no candidate. Each vector lies in one or more posting lists; a query
    reads the lists that the graph search and the ratio select. Lists are dealt to blocks of about
    BLOCK_ROWS vectors, large ones to several; a block gives each query its best few, from which the
    nearest over all blocks are taken. Vectors of each length are a collection of their own, with lists
    of its own unless it is small. Vectors that are null, zero or not finite take no part. Numbers whose
    products a double cannot hold are compared scaled down; such a score is infinite, as the product is.
    Rows that share an id are one candidate, with the larger score.
    """
    collections, rest = by_length(stored(usable(vectors, id_col, vector_col), "vectors"))
    found = []
    for _, total, rows in collections:
        largest = rows.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))).first()[0]
        found.append(_searched(*_in_range(rows, largest), total, every, nearest, recall))
    if rest is not None:
        found.append(_searched_among(rest, every, nearest))
    if not found:
        empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
        return empty.withColumnRenamed("id", id_col)
    once = reduce(DataFrame.unionByName, found).groupBy("query_id", "id").agg(F.max("score").alias("score"), F.max("near").alias("near"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("near"), "id")
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


# `near` is the score of the scaled numbers, which tells infinite scores apart.
BEST = "query_id long, id long, score double, near double"


def _power(largest: float) -> int:
    """The power of two by which numbers up to `largest` are divided, 0 for all usual ones."""
    power = int(np.frexp(largest)[1])
    return power if abs(power) > SAFE_POWER else 0


def _in_range(rows: DataFrame, largest: float) -> tuple[DataFrame, int]:
    power = _power(largest)
    if not power:
        return rows, 0
    # In two steps, as the factor itself may be more than a double holds.
    half = F.lit(float(2.0 ** -(power // 2))), F.lit(float(2.0 ** -(power - power // 2)))
    return rows.withColumn("v", F.transform("v", lambda x: x.cast("double") * half[0] * half[1])), power


def _searched_among(rows: DataFrame, every: int, nearest: int) -> DataFrame:
    """Collections of at most SMALL_ROWS vectors of one length each, all compared."""

    def best(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table.column("id").to_numpy()
        x = matrix(table.column("v").combine_chunks())
        power = _power(np.abs(x).max())
        asks = np.flatnonzero(ids % every == 0)
        both = np.concatenate([asks, np.arange(len(x))])
        scaled = np.ldexp(x, -power)[both]
        one = np.zeros(len(both), int)
        return _best(ids[both], scaled, one, [one[:1]] * len(asks), np.arange(len(both)) < len(asks), nearest, power)

    return rows.withColumn("width", F.size("v")).groupBy("width").applyInArrow(best, BEST)


def _searched(rows: DataFrame, power: int, total: int, every: int, nearest: int, recall: float) -> DataFrame:
    """Each query's best few in each block of one collection; numbers are divided by 2 ** power."""
    norm = rows.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))).first()[0]
    lists = fit(sample(rows, max(MAX_SAMPLE, SAMPLED_ROWS * _lists(total))), total, norm, nearest, recall)
    vector = rows.schema["v"].dataType.simpleString()

    def hold(ids: np.ndarray, x: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch:
        held = lists.memberships(x)
        at = np.repeat(np.arange(len(x)), [len(h) for h in held])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[at]), batch.column(1).take(pa.array(at)), pa.array(np.concatenate(held))], names=["id", "v", "list"]
        )

    held = stored(rows.mapInArrow(each_batch(hold), f"id long, v {vector}, list long"), "posting-lists")
    # At most MAX_LISTS rows, or a few more.
    sizes = np.zeros(len(lists.centres), np.int64)
    for r in held.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    cores = rows.sparkSession.sparkContext.defaultParallelism
    first, parts = _blocks(sizes, int(np.clip(sizes.sum() // (2 * cores), LEAST_BLOCK, max(LEAST_BLOCK, BLOCK_ROWS))))
    spread = small_table(
        rows.sparkSession, [(c, int(first[c]), int(parts[c])) for c in range(len(sizes))], "list long, first_block long, parts long"
    )

    def ask(ids: np.ndarray, x: np.ndarray, batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[], [], []]
        for row, chosen in enumerate(lists.chosen(x, sizes, nearest)):
            blocks: dict[int, list[int]] = {}
            for c in chosen.tolist():
                for b in range(first[c], first[c] + parts[c]):
                    blocks.setdefault(b, []).append(c)
            for b, some in blocks.items():
                for values, value in zip(found, (row, b, some)):
                    values.append(value)
        at = np.array(found[0], int)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[at]), batch.column(1).take(pa.array(at)), pa.array(found[1], pa.int64()), pa.array(found[2], pa.list_(pa.int64()))],
            names=["id", "v", "block", "lists"],
        )

    candidates = held.join(spread, "list").select(
        "id", "v", (F.col("first_block") + F.pmod(F.xxhash64("id"), F.col("parts"))).alias("block"), F.array("list").alias("lists")
    )
    queries = stored(
        rows.where(F.col("id") % every == 0).mapInArrow(each_batch(ask), f"id long, v {vector}, block long, lists array<long>"),
        "queries",
    )
    asked = [(r["block"], -(-r["count"] // BLOCK_ROWS)) for r in queries.groupBy("block").count().collect()]
    shares = small_table(rows.sparkSession, asked, "block long, shares int")
    both = candidates.join(shares, "block").select(
        "id", "v", "block", "lists", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(1), F.col("shares"))).alias("part")
    )
    share = (F.pmod(F.xxhash64("id"), F.col("shares")) + 1).cast("int")
    both = both.unionByName(
        queries.join(shares, "block").select("id", "v", "block", "lists", F.lit(True).alias("asks"), share.alias("part"))
    )

    def best(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        asks, lists_of = table.column("asks").to_numpy(), table.column("lists").combine_chunks()
        starts = lists_of.offsets.to_numpy()[:-1]
        member = lists_of.values.to_numpy(zero_copy_only=False)[starts] if len(lists_of) else np.zeros(0, int)
        chosen = lists_of.filter(pa.array(asks)).to_pylist()
        x = matrix(table.column("v").combine_chunks())
        return _best(table.column("id").to_numpy(), x, member, [np.array(c) for c in chosen], asks, nearest, power)

    return both.groupBy("block", "part").applyInArrow(best, BEST)


def _blocks(sizes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each list its first block and number of blocks of about so many rows: small lists share one, large
    ones are split."""
    first, parts = np.zeros(len(sizes), int), np.ones(len(sizes), int)
    block = filled = 0
    for c, size in enumerate(sizes):
        if size > rows:
            block += bool(filled)
            first[c], parts[c] = block, -(-int(size) // rows)
            block, filled = block + parts[c], 0
            continue
        if filled and filled + size > rows:
            block, filled = block + 1, 0
        first[c] = block
        filled += size
    return first, parts


def _best(
    ids: np.ndarray, x: np.ndarray, member: np.ndarray, chosen: list[np.ndarray], asks: np.ndarray, nearest: int, power: int
) -> pa.Table:
    """Each query's best candidates among the vectors of its lists in one block.

    `member` is the list of each row that does not ask, `chosen` the lists of each that does.
    """
    queries, held = np.flatnonzero(asks), np.flatnonzero(~asks)
    lists, member = np.unique(member[held], return_inverse=True)
    out = [[], [], [], []]
    most = nearest * MAX_COPIES  # a vector may be in several of the block's lists
    rows = (
        (q, wanted, row)
        for start in range(0, len(queries), SLICE)
        for q, wanted, row in zip(
            queries[start : start + SLICE], chosen[start : start + SLICE], x[queries[start : start + SLICE]] @ x[held].T
        )
    )
    for q, wanted, row in rows if len(held) else ():
        some = np.flatnonzero(np.isin(lists, wanted)[member] & (ids[held] != ids[q]))
        row = row[some]
        if len(row) > most:
            # Products in blocks may differ in the last place, so those near the edge are all done again.
            edge = np.partition(row, len(row) - most)[len(row) - most]
            some = some[row >= edge - 1e-9 * max(1.0, abs(edge))]
        exact = (x[q] * x[held[some]]).sum(axis=1)
        names, place = np.unique(ids[held[some]], return_inverse=True)
        top = np.full(len(names), -np.inf)
        np.maximum.at(top, place, exact)
        order = np.lexsort((names, -top))[:nearest]
        with np.errstate(over="ignore"):
            score = np.ldexp(top[order], 2 * power)
        for values, value in zip(out, (np.full(len(order), ids[q]), names[order], score, top[order])):
            values.append(value)
    kinds = (np.int64, np.int64, np.float64, np.float64)
    columns = [np.concatenate(v).astype(t) if v else np.zeros(0, t) for v, t in zip(out, kinds)]
    return pa.table(dict(zip(("query_id", "id", "score", "near"), columns)))
