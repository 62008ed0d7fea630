"""Compressing vectors into codes of sixteen codebook entries, with bounds that save distances."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import quoted, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
# Closest entries whose bounds a part keeps at first; fewer later, where fewer were needed.
CLOSEST, LEAST_CLOSEST = 16, 2
# Share of a batch's parts whose uncertain entries the kept ones must cover.
COVERED = 0.99
# Scaled components beyond this count as it; those beyond the other are computed with whole numbers of any size.
LARGEST, FAST = 2**62, 2**26
MAX_LONG = 2**63 - 1
# Distinct labels up to which their errors may be broadcast (about 10 MB).
SMALL_LABELS = 200_000


@dataclass(frozen=True)
class Codebooks:
    """Per vector length: for each part, the entries (a row each) and how far each moved last."""

    entries: dict[int, list[np.ndarray]]
    moved: dict[int, list[np.ndarray]]

    def digest(self, length: int) -> str:
        numbers = [str(int(x)) for part in self.entries[length] for x in part.ravel()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def cut(length: int) -> list[tuple[int, int]]:
    """Where the parts of a vector lie: of equal size, or within one of each other."""
    return [(p * length // PARTS, (p + 1) * length // PARTS) for p in range(PARTS)]


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) per row whose vector is finite and without nulls.

    Components become floor(256 x). Each part position's codebook starts as that part of the 64 smallest
    ids; ROUNDS times every part goes to its nearest entry (ties to the lower one) and entries become the
    floors of their parts' means; then parts are assigned once more. All of this is in whole numbers.

    Between assignments each part keeps its closest entries in order, a lower bound for the distance to
    each of them but the first, and one outer bound for all others, less by what entries moved. Only
    entries whose bound does not exceed the exact distance to the part's own entry are compared, in
    whole numbers; how many are kept adapts to how many were needed.

    Vectors of each length are a collection with codebooks of its own, of parts that differ by at most one
    component where the length is no multiple of sixteen. Of rows with equal ids the least vector is the
    one that starts an entry; a row without an id starts none. A collection without any id has neither
    codes nor errors. Scaled components end at 2**62, and errors at the largest long. The codebooks are
    on the driver: 64 vectors for each length.
    """
    scaled = F.transform(quoted(vector_col).cast("array<double>"), _scaled)
    kept = vectors.where(_finite(quoted(vector_col).cast("array<double>"))).select(
        quoted(id_col).alias("id"), quoted(label_col).alias("label"), scaled.alias("v")
    )
    books = _first_entries(kept)
    state = stored(_assign(kept, books), "code-state")
    for step in range(1, ROUNDS + 1):
        books = _moved(books, _sums(state, books))
        state = _assign(state, books, last=step == ROUNDS)
        if step < ROUNDS:
            state = stored(state, "code-state")
    coded = stored(state, "codes")
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    if by_label.count() <= SMALL_LABELS:
        by_label = F.broadcast(by_label)
    total = F.when(F.col("total") > MAX_LONG, F.lit(MAX_LONG)).otherwise(F.col("total").cast("long"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "code", "error", total.alias("label_error"), "codebooks_sha256"
    )


def _scaled(x):
    bounded = F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x * SCALE))
    return F.floor(bounded).cast("long")


def _finite(v):
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _first_entries(kept: DataFrame) -> Codebooks:
    """The vectors of the smallest ids of each length; ids are found without their vectors."""
    ids = kept.where("id is not null").select(F.size("v").alias("of"), F.col("id").alias("chosen")).distinct()
    rank = F.row_number().over(Window.partitionBy("of").orderBy("chosen"))
    chosen = stored(ids.withColumn("rank", rank).where(F.col("rank") <= ENTRIES).drop("rank"), "code-seeds")
    seeds = kept.join(chosen, (F.col("id") == F.col("chosen")) & (F.size("v") == F.col("of")))
    rows = seeds.groupBy("of", "chosen").agg(F.min("v").alias("v")).orderBy("of", "chosen").toArrow().to_pylist()
    by_length: dict[int, list[list[int]]] = {}
    for row in rows:
        by_length.setdefault(row["of"], []).append(row["v"])
    entries = {}
    for length, found in by_length.items():
        whole = _exact(np.array(found, np.int64).reshape(len(found), length))
        entries[length] = [whole[:, lo:hi] for lo, hi in cut(length)]
    return Codebooks(entries, {})


def _exact(x: np.ndarray) -> np.ndarray:
    """The same numbers, as Python integers where squares of differences might not fit 64 bits."""
    return x.astype(object) if x.dtype != object and x.size and max(abs(int(x.max())), abs(int(x.min()))) > FAST else x


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances between rows of x and entries, which are either per row or common to all."""
    if x.dtype == object or entries.dtype == object:
        x, entries = x.astype(object), entries.astype(object)
    gap = x[:, None, :] - (entries if entries.ndim == 3 else entries[None])
    return (gap * gap).sum(2) if x.shape[1] else np.zeros(gap.shape[:2], np.int64)


def _root(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(float))


def _below(x: np.ndarray) -> np.ndarray:
    """16-bit floats that are not above x."""
    x = x * (1 - 1e-9)
    with np.errstate(over="ignore"):
        low = x.astype(np.float16)
    return np.where(low > x, np.nextafter(low, np.float16(-np.inf)), low)


def _closest(x: np.ndarray, entries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(closest entries in order, lower bounds of all but the first and of the rest, squared distance)."""
    squares = _squares(x, entries)
    order = squares.argsort(1, kind="stable")
    most = min(most, len(entries))
    near = order[:, :most]
    ordered = np.take_along_axis(squares, order[:, : most + 1], 1)
    low = np.full((len(x), most), np.inf)
    low[:, : ordered.shape[1] - 1] = _root(ordered[:, 1:])
    return near.astype(np.uint8), low, ordered[:, 0]


def _again(
    x: np.ndarray, entries: np.ndarray, moved: np.ndarray, near: np.ndarray, low: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """`_closest` after the entries moved, and how many bounds of each row were uncertain."""
    most = near.shape[1]
    low = np.concatenate([low[:, :-1] - moved[near[:, 1:]], low[:, -1:] - moved.max()], 1)
    low = np.minimum.accumulate(low[:, ::-1], 1)[:, ::-1]
    near, low = near.copy(), low.copy()
    own = _squares(x, entries[near[:, :1]])[:, 0]
    uncertain = (low <= (_root(own) * (1 + 1e-9))[:, None]).sum(1)
    for count in np.unique(uncertain):
        rows = np.flatnonzero(uncertain == count)
        if count == most:
            near[rows], low[rows], own[rows] = _closest(x[rows], entries, most)
        elif count:
            some = near[rows, : count + 1]
            squares = _squares(x[rows], entries[some])
            order = np.lexsort((some, squares), 1) if squares.dtype != object else _sorted(some, squares)
            squares = np.take_along_axis(squares, order, 1)
            near[rows[:, None], np.arange(count + 1)] = np.take_along_axis(some, order, 1)
            low[rows[:, None], np.arange(count)] = _root(squares[:, 1:])
            own[rows] = squares[:, 0]
    return near, low, own, uncertain


def _sorted(some: np.ndarray, squares: np.ndarray) -> np.ndarray:
    return np.array([sorted(range(some.shape[1]), key=lambda j: (squares[i, j], some[i, j])) for i in range(len(some))])


def _adapted(low: np.ndarray, uncertain: np.ndarray) -> int:
    """How many closest entries to keep: enough for nearly all parts, and never more than before."""
    needed = int(np.quantile(uncertain, COVERED, method="higher")) + 1 if uncertain.size else LEAST_CLOSEST
    return min(low.shape[2], max(LEAST_CLOSEST, needed))


def _assign(rows: DataFrame, books: Codebooks, last: bool = False) -> DataFrame:
    """Rows with the state of their parts; the last time, with their codes and errors instead."""
    label = rows.schema["label"].dataType.simpleString()
    ident = rows.schema["id"].dataType.simpleString()
    digests = {length: books.digest(length) for length in books.entries} if last else {}
    added = "code string, error long, codebooks_sha256 string" if last else "v array<long>, near binary, low binary"
    first = "near" not in rows.columns

    def one(length: int, x: np.ndarray, near: np.ndarray | None, low: np.ndarray | None):
        """The state of the rows of one length and one number of kept entries."""
        parts = []
        for p, (lo, hi) in enumerate(cut(length)):
            entries = books.entries[length][p]
            if near is None:
                parts.append((*_closest(x[:, lo:hi], entries, CLOSEST), np.zeros(len(x), np.int64)))
            else:
                parts.append(_again(x[:, lo:hi], entries, books.moved[length][p], near[:, p], low[:, p]))
        found_near, found_low = (np.stack([part[i] for part in parts], 1) for i in (0, 1))
        error = sum(part[2].astype(object) for part in parts)
        keep = found_low.shape[2]
        if near is not None:
            keep = _adapted(found_low, np.stack([part[3] for part in parts], 1))
            # Bounds in order, so that the last one kept holds for all entries after it.
            found_low = np.minimum.accumulate(found_low[:, :, ::-1], 2)[:, :, ::-1]
        return found_near[:, :, :keep], _below(found_low[:, :, :keep]), error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            lists = batch.column("v")
            lengths = np.diff(lists.offsets.to_numpy())
            kinds = lengths if first else lengths * (ENTRIES + 1) + [len(s) // PARTS for s in batch.column("near").to_pylist()]
            columns: dict[str, list] = {name: [None] * len(batch) for name in ("near", "low", "code", "error", "codebooks_sha256")}
            for kind in np.unique(kinds):
                rows_of = np.flatnonzero(kinds == kind)
                length = int(lengths[rows_of[0]])
                if length not in books.entries:
                    empty = b""
                    for i in rows_of:
                        columns["near"][i] = columns["low"][i] = empty
                    continue
                x = _exact(lists.take(pa.array(rows_of)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows_of), length))
                near = low = None
                if not first:
                    taken = {c: b"".join(batch.column(c).take(pa.array(rows_of)).to_pylist()) for c in ("near", "low")}
                    near = np.frombuffer(taken["near"], np.uint8).reshape(len(rows_of), PARTS, -1)
                    low = np.frombuffer(taken["low"], np.float16).astype(float).reshape(near.shape)
                near, low, error = one(length, x, near, low)
                if last:
                    own = near[:, :, 0]
                    for i, code, e in zip(rows_of, own, error):
                        columns["code"][i], columns["error"][i] = code.tobytes().hex(), min(int(e), MAX_LONG)
                        columns["codebooks_sha256"][i] = digests[length]
                else:
                    for i, a, b in zip(rows_of, near, low):
                        columns["near"][i], columns["low"][i] = a.tobytes(), b.tobytes()
            if last:
                arrays = [pa.array(columns["code"], pa.string()), pa.array(columns["error"], pa.int64())]
                arrays += [pa.array(columns["codebooks_sha256"], pa.string())]
                names = ["code", "error", "codebooks_sha256"]
            else:
                arrays = [lists, pa.array(columns["near"], pa.binary()), pa.array(columns["low"], pa.binary())]
                names = ["v", "near", "low"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), *arrays], names=["id", "label", *names])

    source = rows.select("id", "label", "v", *([] if first else ["near", "low"]))
    return source.mapInArrow(run, f"id {ident}, label {label}, {added}")


def _sums(state: DataFrame, books: Codebooks) -> DataFrame:
    """(of, part, entry, pos, n, total): sums of the parts that each entry has, added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}
        for batch in batches:
            lists = batch.column("v")
            lengths = np.diff(lists.offsets.to_numpy())
            for length in np.unique(lengths).tolist():
                if length not in books.entries:
                    continue
                rows_of = np.flatnonzero(lengths == length)
                x = lists.take(pa.array(rows_of)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows_of), length)
                near = batch.column("near").take(pa.array(rows_of)).to_pylist()
                own = np.array([[s[p * len(s) // PARTS] for p in range(PARTS)] for s in near])
                count = len(books.entries[length][0])
                if length not in held:
                    held[length] = (np.zeros((PARTS, count), np.int64), [np.zeros((count, hi - lo), object) for lo, hi in cut(length)])
                counts, sums = held[length]
                exact = _exact(x)
                for p, (lo, hi) in enumerate(cut(length)):
                    counts[p] += np.bincount(own[:, p], minlength=count)
                    here = np.zeros((count, hi - lo), exact.dtype)
                    np.add.at(here, own[:, p], exact[:, lo:hi])
                    sums[p] += here
        for length, (counts, sums) in held.items():
            for p, part in enumerate(sums):
                used = np.flatnonzero(counts[p])
                width = part.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(used) * width, length), pa.int32()),
                        pa.array(np.full(len(used) * width, p), pa.int32()),
                        pa.array(np.repeat(used, width), pa.int32()),
                        pa.array(np.tile(np.arange(width), len(used)), pa.int32()),
                        pa.array(np.repeat(counts[p][used], width), pa.int64()),
                        pa.array([str(x) for x in part[used].ravel()], pa.string()),
                    ],
                    names=["of", "part", "entry", "pos", "n", "total"],
                )

    summed = state.select("v", "near").mapInArrow(run, "of int, part int, entry int, pos int, n long, total string")
    return summed.groupBy("of", "part", "entry", "pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )


def _moved(books: Codebooks, sums: DataFrame) -> Codebooks:
    """Entries at the floors of their parts' means; unused ones stay. One row per component of a codebook."""
    entries = {length: [part.astype(object) for part in parts] for length, parts in books.entries.items()}
    for row in sums.collect():
        entries[row["of"]][row["part"]][row["entry"], row["pos"]] = int(row["total"]) // row["n"]
    moved = {}
    for length, parts in entries.items():
        before = books.entries[length]
        moved[length] = [
            _root(((new - old) * (new - old)).sum(1)) * (1 + 1e-9) if new.shape[1] else np.zeros(len(new))
            for new, old in zip(parts, before)
        ]
        entries[length] = [_narrow(part) for part in parts]
    return Codebooks(entries, moved)


def _narrow(x: np.ndarray) -> np.ndarray:
    return _exact(x.astype(np.int64))
