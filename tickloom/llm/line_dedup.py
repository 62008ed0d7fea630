"""Line dedup over three-line windows, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, quoted, quoted_all, stored, text_or_empty

WINDOW_LINES = 3


def line_windows(docs: DataFrame, size: int = WINDOW_LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_key, pos, h1, h2): two 64-bit hashes of each `size` lines that follow each other.

    Windows of blank lines alone are left out. Texts with fewer lines have no window.
    """
    lines = F.split(text_or_empty(text_col), "\n", -1)
    hashed = docs.select(
        quoted(id_col).alias("id"),
        F.xxhash64(text_or_empty(text_col)).alias("text_key"),
        F.transform(
            lines,
            lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (F.trim(x) == "").alias("blank")),
        ).alias("lines"),
    ).where(F.size("lines") >= size)
    at = [lambda i, k=k: F.get(F.col("lines"), i + k) for k in range(size)]
    windows = F.transform(
        F.sequence(F.lit(0), F.size("lines") - size),
        lambda i: F.when(
            ~_all([f(i)["blank"] for f in at]),
            F.struct(
                i.alias("pos"),
                F.xxhash64(*[f(i)["a"] for f in at]).alias("h1"),
                F.xxhash64(*[f(i)["b"] for f in at]).alias("h2"),
            ),
        ),
    )
    return (
        hashed.select("id", "text_key", F.explode(windows).alias("w"))
        .where(F.col("w").isNotNull())
        .select("id", "text_key", "w.pos", "w.h1", "w.h2")
    )


def _all(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def dedup_lines(
    docs: DataFrame,
    size: int = WINDOW_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """`docs` with repeated passages of `size` or more lines cut from all places but the first.

    Every run of `size` lines is hashed; where one occurs more than once in all documents, or in one,
    it stays in the place with the smallest (id, position), and all lines that a later occurrence
    covers go. Overlapping occurrences merge. The lines left are joined by line breaks; a text that
    loses all its lines becomes empty. Null texts and texts without a loss stay as they are.
    Rows with the same id and the same text count as one document and are treated alike. Null ids
    come first. `counts` names two columns to add: lines before, and lines removed.

    Only hashes are shuffled to find repeats; minima are combined before the shuffle, and no group
    of equal windows is ever gathered. The texts are shuffled once, to meet their removed lines.
    """
    windows = stored(line_windows(docs, size, id_col, text_col), "line-windows")
    repeats = (
        windows.groupBy("h1", "h2")
        .agg(F.min(F.struct("id", "text_key", "pos")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("h1", "h2", "first")
    )
    later = windows.join(repeats, ["h1", "h2"]).where(F.struct("id", "text_key", "pos") != F.col("first"))
    i, k, removed, lines = fresh(docs, "dedup_id", "dedup_key", "dedup_covered", "dedup_lines")
    covered = later.groupBy(F.col("id").alias(i), F.col("text_key").alias(k)).agg(F.collect_set("pos").alias(removed))
    met = docs.join(
        covered, quoted(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(text_or_empty(text_col)) == F.col(k)), "left"
    )
    split = F.split(text_or_empty(text_col), "\n", -1)
    places = F.flatten(F.transform(F.col(removed), lambda p: F.sequence(p, p + size - 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), places)
    text = F.when(F.col(removed).isNull(), quoted(text_col)).otherwise(
        F.array_join(F.transform(left, lambda p: F.get(F.col(lines), p)), "\n")
    )
    out = met.withColumn(lines, split)
    columns = [text.alias(c) if c == text_col else quoted(c) for c in docs.columns]
    if counts:
        gone = F.coalesce(F.size(F.array_distinct(places)), F.lit(0))
        columns += [
            F.size(lines).cast("long").alias(counts[0]),
            F.when(F.col(removed).isNull(), 0).otherwise(gone).cast("long").alias(counts[1]),
        ]
    return out.select(*columns)


def without_repeats(docs: DataFrame, size: int = WINDOW_LINES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`dedup_lines`, less the documents that lost all their text but white space. All columns stay."""
    before, gone = fresh(docs, "lines_before", "lines_gone")
    left = dedup_lines(docs, size, id_col, text_col, (before, gone))
    return left.where((F.col(gone) == 0) | quoted(text_col).rlike(r"\S")).select(*quoted_all(docs.columns))
