"""Near-duplicate documents by SetSketch registers, with exact confirmation."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, per_text, quoted, stored, text_or_empty
from tickloom.llm.components import components

# Registers are spaced by powers of BASE; RATE is the rate of the exponential draws.
BASE, RATE = 1.2, 20.0
ROWS_PER_BAND = 6
# Chance that a pair just at the threshold shares no band.
MISS = 1e-6
# Standard deviations of the estimate below the threshold at which a candidate is not compared further.
MARGIN = 6.0
# Ids up to which a table of them may be broadcast (about 10 MB).
SMALL_IDS = 500_000
CACHED_WORDS = 200_000
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class Sketching:
    """Words per shingle, least similarity in percent, and what follows from them."""

    words: int = 5
    percent: int = 80

    @property
    def bands(self) -> int:
        equal = 1 - 2 * _differ(0.5 * (1 - self.percent / 100))
        return math.ceil(math.log(MISS) / math.log1p(-(equal**ROWS_PER_BAND)))

    @property
    def registers(self) -> int:
        return self.bands * ROWS_PER_BAND

    @property
    def least_estimate(self) -> float:
        j = self.percent / 100
        return j - MARGIN * math.sqrt(j * (1 - j) / self.registers)


def _differ(x):
    """The chance that one set's register is larger than the other's, where x is its own share."""
    return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """64-bit hashes of words, each made once."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_sets(words: int):
    """A function from a text to the sorted 64-bit hashes of its distinct shingles.

    A-Z count as a-z; words end at white space of ASCII. A text of fewer words is one shingle, one
    without words has none.
    """
    known = _Words()

    def run(text: str) -> np.ndarray:
        parts = text.encode("utf-8", "surrogatepass").lower().split()
        if len(known) > CACHED_WORDS:
            known.clear()
        each = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
        width = min(words, len(each))
        if not width:
            return each
        count = len(each) - width + 1
        hashed = np.full(count, width, np.uint64)
        for k in range(width):
            hashed = _mixed(hashed) + each[k : k + count]
        return np.unique(_mixed(hashed))

    return run


def registers(count: int):
    """A function from a shingle set to `count` registers of one byte, as bytes.

    Each register takes the least of an exponential draw over the set's elements, on a scale whose
    steps are powers of BASE, truncated to 0..255. Those of a union are the larger of both.
    """
    rng = np.random.default_rng(20240601)
    factor = (rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1))[:, None]
    shift = rng.integers(0, 1 << 32, count, dtype=np.uint32)[:, None]

    def run(shingles: np.ndarray) -> bytes:
        least = np.full(count, np.iinfo(np.uint32).max, np.uint32)
        high = (shingles >> np.uint64(32)).astype(np.uint32)
        for start in range(0, len(high), 4096):
            least = np.minimum(least, (factor * high[start : start + 4096] + shift).min(axis=1))
        draw = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
        return np.clip(np.floor(1 - np.log(draw) / math.log(BASE)), 0, 255).astype(np.uint8).tobytes()

    return run


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """The most likely similarity of each pair of sketches (rows of `a` and `b`) of sets of these sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u = size_a / (size_a + size_b)
    v = 1 - u
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = _differ(np.maximum(u - v * j, 0)), _differ(np.maximum(v - u * j, 0))
        tiny = 1e-300
        return more * np.log(p + tiny) + less * np.log(q + tiny) + same * np.log(np.maximum(1 - p - q, tiny))

    for _ in range(30):  # the likelihood has one peak
        third = (high - low) / 3
        left = likelihood(low + third) >= likelihood(high - third)
        low, high = np.where(left, low, low + third), np.where(left, high - third, high)
    return (low + high) / 2


def sketches(docs: DataFrame, how: Sketching, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, d1, d2, registers, text_key) per document.

    d1 and d2 are 128 hash bits of the set, text_key is `xxhash64` of the text.
    """

    def make():
        sets, sketch = shingle_sets(how.words), registers(how.registers)

        def run(texts: list[str]) -> dict[str, list]:
            found = [sets(t) for t in texts]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in found]
            return {
                "n_shingles": [len(s) for s in found],
                "d1": [int.from_bytes(d[:8], "little", signed=True) for d in digests],
                "d2": [int.from_bytes(d[8:], "little", signed=True) for d in digests],
                "registers": [sketch(s) if len(s) else b"" for s in found],
                "text_key": [_signed(xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), 42)) for t in texts],
            }

        return run

    rows = per_text(docs, make, "n_shingles long, d1 long, d2 long, registers binary, text_key long", id_col, text_col)
    return rows.withColumnRenamed(id_col, "id")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _small(ids: DataFrame) -> DataFrame:
    """`ids`, to be broadcast if a count shows that they are few."""
    return F.broadcast(ids) if ids.count() <= SMALL_IDS else ids


def _likely(pairs: DataFrame, classes: DataFrame, how: Sketching) -> DataFrame:
    """The pairs (a, b) whose sizes and registers allow the threshold."""
    side = [
        classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("registers").alias(f"r_{x}")) for x in "ab"
    ]
    size_fits = 100 * F.least("n_a", "n_b") >= how.percent * F.greatest("n_a", "n_b")
    met = pairs.join(side[0], "a").join(side[1], "b").where(size_fits).select("a", "b", "n_a", "n_b", "r_a", "r_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
            r_a, r_b = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, how.registers) for i in (4, 5)
            )
            keep = estimate(r_a, r_b, n_a, n_b) >= how.least_estimate if len(n_a) else np.zeros(0, bool)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return met.mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, how: Sketching) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    met = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("s_a")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("s_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= how.percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return met.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _pairs(df: DataFrame, x: Column, y: Column) -> DataFrame:
    return df.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, how: Sketching = Sketching(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id, kept, text_key) per row of `docs`, whose ids are integers.

    Documents are linked when their shingle sets reach the threshold. Equal sets are one class, which
    its smallest id stands for. Classes that share a band of registers meet in a bucket; candidates
    whose likelihood estimate comes near the threshold are confirmed on their full sets.

    In a bucket, all members are compared with one of them. Nodes of buckets that then still hold more
    than one component are joined exactly on the rarest shingles of their sets (see `_prefix_pairs`),
    so that no link between them is left out and neither are all pairs of a bucket made; pairs within a
    component need no comparison. Buckets are never gathered into one task, and large ones are split
    by Spark's skew handling of joins.

    A text without words (or null) links with nothing. A row with a null id links with nothing, has
    no component and is kept. Rows with the same id are told apart by their texts, but share links.
    """
    sketched = stored(sketches(docs, how, id_col, text_col), "sketches")
    classes = stored(
        sketched.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
        .groupBy("d1", "d2")
        .agg(F.min("id").cast("long").alias("node"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")),
        "classes",
    )
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(how.bands - 1)),
        lambda i: F.xxhash64(F.substring(F.col("registers"), i * ROWS_PER_BAND + 1, F.lit(ROWS_PER_BAND)), i),
    )
    keyed = classes.select("node", F.explode(bands).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where(F.col("n") > 1)
    members = stored(keyed.join(shared.select("key", "hub"), "key"), "buckets")

    ids = members.select(F.col("node").alias("node_id")).distinct()
    chosen = docs.join(_small(ids), quoted(id_col).cast("long") == F.col("node_id"), "left_semi")

    def make():
        sets = shingle_sets(how.words)
        return lambda texts: {"shingles": [sets(t).tobytes() for t in texts]}

    sets = stored(
        per_text(chosen, make, "shingles binary", id_col, text_col).select(quoted(id_col).cast("long").alias("node"), "shingles"),
        "shingle-sets",
    )

    def links(pairs: DataFrame) -> DataFrame:
        return stored(_confirmed(stored(_likely(pairs, classes, how), "candidates"), sets, how), "pairs")

    found = links(_pairs(members.where(F.col("node") != F.col("hub")), F.col("node"), F.col("hub")))
    labels = stored(components(found), "components")
    apart = stored(_apart(members, labels), "apart")
    if not apart.isEmpty():
        found = found.unionByName(links(stored(_prefix_pairs(apart, sets, how), "prefix-pairs")))
        labels = stored(components(found), "components")

    to_class = classes.select("d1", "d2", "node")
    result = sketched.join(to_class, ["d1", "d2"], "left").join(labels.withColumnRenamed("id", "node"), "node", "left")
    linked = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.coalesce("component", "node"))
    component = F.coalesce(linked, F.col("id").cast("long"))
    return result.select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
        "text_key",
    )


def without_near_duplicates(
    docs: DataFrame, how: Sketching = Sketching(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with one document of each group of near-duplicates, the one with the smallest id.

    Rows that are equal in id and text are one document and stay or go together.
    """
    found = near_duplicates(docs, how, id_col, text_col).where(~F.col("kept"))
    i, k = fresh(docs, "near_id", "near_key")
    gone = stored(found.select(quoted(id_col).alias(i), F.col("text_key").alias(k)).distinct(), "later-copies")
    key = F.xxhash64(text_or_empty(text_col))
    return docs.join(_small(gone), (quoted(id_col) == F.col(i)) & (key == F.col(k)), "left_anti")


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, comp) of the nodes in buckets with more than one component."""
    known = labels.select(F.col("id").alias("node"), "component")
    rows = members.join(known, "node", "left").select("key", "node", F.coalesce("component", "node").alias("comp"))
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    return rows.join(mixed, "key").select("node", "comp").distinct()


def _prefix_pairs(apart: DataFrame, sets: DataFrame, how: Sketching) -> DataFrame:
    """All pairs (a, b) of these nodes, of different components, that can reach the threshold.

    Two sets that do share one of their rarest shingles, at places that leave room for the overlap
    they need: the larger set among its first (1 - p) n + 1 in a common order, the smaller among its
    first (1 - p) / (1 + p) n + 1. The order is by how many of these nodes have a shingle, so that
    text which many copies share hardly ever comes into it, and a copy with many changes of its own
    meets no other.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.frombuffer(x, np.int64) for x in batch.column(2).to_pylist()]
            size = np.array([len(x) for x in each], np.int64)
            place = np.repeat(np.arange(len(each)), size)
            for cut in range(0, len(place), 50_000):
                at = place[cut : cut + 50_000]
                columns = [batch.column(0).to_numpy()[at], batch.column(1).to_numpy()[at], size[at]]
                columns.append(np.concatenate(each)[cut : cut + 50_000])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "comp", "n", "key"])

    rows = apart.join(sets, "node").select("node", "comp", "shingles").mapInArrow(spread, "node long, comp long, n long, key long")
    rows = stored(rows, "shingle-rows")
    common = rows.groupBy("key").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") > 1)
    by_node = Window.partitionBy("node")
    # Shingles that only one node has come first in its order; they meet nothing.
    first = F.col("n") - F.count(F.lit(1)).over(by_node)
    placed = rows.join(common, "key").withColumn("pos", first + F.row_number().over(by_node.orderBy("df", "key")))
    p = how.percent
    prefix = stored(placed.where(F.col("pos") <= F.col("n") - F.ceil(p * F.col("n") / 100) + 1).drop("df"), "prefixes")
    smaller = prefix.where(F.col("pos") <= F.col("n") - F.ceil(2 * p * F.col("n") / (100 + p)) + 1).select(
        "key", *[F.col(c).alias(f"s_{c}") for c in ("node", "comp", "n", "pos")]
    )
    room = 1 + F.least(F.col("n") - F.col("pos"), F.col("s_n") - F.col("s_pos"))
    fits = (
        (F.col("comp") != F.col("s_comp"))
        & (F.col("s_n") <= F.col("n"))
        & (100 * F.col("s_n") >= p * F.col("n"))
        & ((100 + p) * room >= p * (F.col("n") + F.col("s_n")))
    )
    return _pairs(prefix.join(smaller, "key").where(fits), F.col("node"), F.col("s_node"))
