"""Connected components of a link table, by alternating rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id of `links` (a, b), itself included.

    Ids that no link names are not returned. Each round joins every node to the smallest node of its
    neighbourhood; the rounds end when the links no longer change, after about log(n) of them. All
    steps are grouped minima and joins on ids; a round's links are written to the shared folder, so
    that neither the lineage nor a lost executor matters. A node with very many neighbours is spread
    by Spark's skew handling, as the join needs none of its rows together.
    """
    edges = stored(_canonical(links), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        edges = stored(_canonical(_star(_star(edges, large=True), large=False)), "links")
        total = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.sum(F.xxhash64("b", "a") % (1 << 40)))
        after = tuple(total.first())
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("the components did not settle")
    leaves = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)


def _canonical(links: DataFrame) -> DataFrame:
    """Each link once, the larger id first."""
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each neighbour of a node (its larger ones, or its smaller ones) to the least of them all."""
    if large:
        sides = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = sides.join(least, "a")
    if large:
        return moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.select("b", "m", "a").select(
        F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")
    ).select("e.a", "e.b").where(F.col("a") != F.col("b"))
