"""How the sources of a language differ in their words, by ranking cells of equal counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import quoted, stored

LEAST_DOCUMENTS, LEAST_RANKS, PRECISION = 3, 200, 1_000_000_000
# Distinct words, and bytes of texts, whose counts a task holds before it passes them on.
HELD_WORDS, HELD_BYTES = 300_000, 64 << 20
# Numbers that a task compares at once.
TABLE_CELLS = 1 << 20
# Everything but letters A to Z and characters beyond ASCII ends a term; A to Z become lower case.
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def source_divergence(
    docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", ranks: int = LEAST_RANKS
) -> DataFrame:
    """(lang, source, part, item, value, rank): how a source differs from the others of its language.

    Null texts, languages and sources count as ''. Terms are those in at least three documents (rows) of
    a language. In every (lang, source) that occurs, and in the language, a term has the share
    p = 1 + floor(10^9 (count + 1) / (N + V)), and two shares differ by f = floor((p - q)^2 / q), all in
    whole numbers. Part `pair` has the sum of f over all kept terms against each other source of the
    language; part `term` the terms of the source that are more common than in the language, those of
    the highest f, up to the rank given. Ranks go by value, then by item in UTF-8 order.

    Texts are counted once. Terms of equal counts (in source and language) are one cell, f is found per
    cell, cells of equal f are merged, and only terms of cells that begin within the ranks asked for are
    looked at again. For pairs, terms whose counts agree in all sources are one cell, and each task adds
    up f for the whole grid of sources of a language, which is as large as the part `pair` itself; no
    pairs of rows are made. The totals of sources, a row each, are on the driver.
    """
    counted = stored(_counts(docs, lang_col, source_col, text_col), "term-counts")
    groups = counted.where("term is null").select("lang", "source").distinct()
    kept = stored(_kept(counted), "kept-terms")
    per_source = kept.select("lang", F.explode("held").alias("h")).groupBy("lang", "h.source").agg(F.sum("h.n").alias("n"))
    per_lang = kept.groupBy(F.col("lang").alias("l")).agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    totals = groups.join(per_source.withColumnsRenamed({"lang": "l", "source": "s"}), F.expr("lang = l AND source = s"), "left")
    totals = totals.drop("l", "s").join(per_lang, F.expr("lang = l"), "left").drop("l")
    totals = totals.na.fill(0, ["n", "lang_total", "terms"]).withColumnRenamed("n", "total")
    totals = stored(totals, "source-totals")
    return _pairs(kept, totals).unionByName(_terms(kept, totals, ranks))


def _counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, documents): counts that tasks have added up in part, and one row with a null
    term at least for each source."""
    texts = docs.select(
        *[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))],
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        words = size = 0
        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns)):
                group = held.get((lang, source))
                if group is None:
                    group = held[lang, source] = (Counter(), Counter())
                    words += 1
                terms = text.translate(TERM_BYTES).split()
                before = len(group[1])
                group[0].update(terms)
                group[1].update(set(terms))
                words += len(group[1]) - before
                size += len(text)
                if words > HELD_WORDS or size > HELD_BYTES:
                    yield from _rows(held)
                    held, words, size = {}, 0, 0
        yield from _rows(held)

    return texts.mapInArrow(run, "lang string, source string, term string, n long, documents long")


def _rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, documents) in held.items():
        terms = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * (len(terms) + 1), pa.string()),
                pa.array([source] * (len(terms) + 1), pa.string()),
                pa.array([None, *terms], pa.binary()).cast(pa.string()),
                pa.array([0, *counts.values()], pa.int64()),
                pa.array([0, *map(documents.__getitem__, terms)], pa.int64()),
            ],
            names=["lang", "source", "term", "n", "documents"],
        )


def _kept(counted: DataFrame) -> DataFrame:
    """(lang, term, n, held): kept terms with their counts in the sources that have them, in order.

    One shuffle, by language and term, serves both groupings; a term has a row per source.
    """
    terms = counted.where("term is not null").repartition("lang", "term")
    per_source = terms.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    whole = per_source.groupBy("lang", "term").agg(
        F.sum("n").alias("n"),
        F.sum("documents").alias("documents"),
        F.sort_array(F.collect_list(F.struct("source", "n"))).alias("held"),
    )
    return whole.where(F.col("documents") >= LEAST_DOCUMENTS).drop("documents")


def _share(count: str, total: str) -> str:
    """p as a long; the product is a decimal, as counts of a large corpus exceed a long with it."""
    scaled = f"CAST({PRECISION} AS DECIMAL(10,0)) * (CAST({count} AS DECIMAL(20,0)) + 1)"
    return f"(1 + ({scaled}) div (CAST({total} AS DECIMAL(20,0)) + terms))"


def _divergence(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def _terms(kept: DataFrame, totals: DataFrame, ranks: int) -> DataFrame:
    """Part `term`. Shares are below 2^30, so that squares of their differences fit a long."""
    rows = kept.select("lang", "term", F.col("n").alias("lang_n"), F.explode("held").alias("h")).select(
        "lang", "term", "lang_n", F.col("h.source").alias("source"), F.col("h.n").alias("n")
    )
    cells = rows.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("many"))
    known = totals.withColumnsRenamed({"lang": "l", "source": "s"})
    cells = cells.join(known, F.expr("lang = l AND source = s")).selectExpr(
        "lang", "source", "n", "lang_n", "many", f"{_share('n', 'total')} AS p", f"{_share('lang_n', 'lang_total')} AS q"
    )
    cells = cells.where("p > q").selectExpr("lang", "source", "n", "lang_n", "many", f"{_divergence('p', 'q')} AS value")
    cells = stored(cells, "count-cells")
    # A value holds one term at least, so the ranks asked for lie in as many of the highest values.
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = cells.groupBy("lang", "source", "value").agg(F.sum("many").alias("many"))
    values = values.withColumn("place", F.row_number().over(by_value)).where(F.col("place") <= ranks)
    earlier = F.sum("many").over(by_value.rowsBetween(Window.unboundedPreceding, -1))
    values = values.withColumn("before", F.coalesce(earlier, F.lit(0))).where(F.col("before") < ranks)
    wanted = cells.join(values.select("lang", "source", "value"), ["lang", "source", "value"])
    wanted = wanted.selectExpr("lang AS l", "source AS s", "n AS own", "lang_n AS whole", "value")
    found = rows.join(wanted, F.expr("lang = l AND source = s AND n = own AND lang_n = whole"))
    return (
        found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
        .where(F.col("rank") <= ranks)
    )


def _long_share(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """p in 64 bits: the long division goes three digits at a time, for totals up to 9 * 10^15."""
    found, rest = (count + 1) // total, (count + 1) % total
    for _ in range(3):
        rest = rest * 1000
        found, rest = found * 1000 + rest // total, rest % total
    return found + 1


def _pairs(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """Part `pair`: sums of f over the grid of sources, added up in each task and then over tasks."""
    place: dict[str, dict[str, int]] = {}
    sums: dict[str, list[int]] = {}
    for row in totals.select("lang", "source", "total", "terms").orderBy("lang", "source").toLocalIterator():
        own = place.setdefault(row["lang"], {})
        own[row["source"]] = len(own)
        sums.setdefault(row["lang"], []).append(row["total"] + row["terms"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids: dict[str, np.ndarray] = {}
        for batch in batches:
            rows: dict[str, list[tuple[list[dict], int]]] = {}
            for lang, held, many in zip(*(column.to_pylist() for column in batch.columns)):
                rows.setdefault(lang, []).append((held, many))
            for lang, cells in rows.items():
                index, total = place[lang], np.array(sums[lang], np.int64)
                grid = grids.setdefault(lang, np.zeros((len(total), len(total)), np.int64))
                step = max(1, TABLE_CELLS // len(total))
                for start in range(0, len(cells), step):
                    some = cells[start : start + step]
                    count = np.zeros((len(some), len(total)), np.int64)
                    for k, (held, _) in enumerate(some):
                        for h in held:
                            count[k, index[h["source"]]] = h["n"]
                    p = _long_share(count, total)
                    many = np.array([m for _, m in some], np.int64)
                    for a in range(len(total)):
                        gap = p[:, a : a + 1] - p
                        grid[a] += many @ (gap * gap // p)
        for lang, grid in grids.items():
            names = list(place[lang])
            for a, source in enumerate(names):
                others = [b for b in range(len(names)) if b != a]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(others), pa.string()),
                        pa.array([source] * len(others), pa.string()),
                        pa.array([names[b] for b in others], pa.string()),
                        pa.array(grid[a, others], pa.int64()),
                    ],
                    names=["lang", "source", "item", "value"],
                )

    cells = kept.groupBy("lang", "held").agg(F.count(F.lit(1)).alias("many"))
    part = cells.select("lang", "held", "many").mapInArrow(run, "lang string, source string, item string, value long")
    summed = part.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    # Languages without a kept term have pairs too.
    others = totals.where("terms = 0").select("lang", "source")
    empty = others.join(others.select("lang", F.col("source").alias("item")), "lang").where("source <> item")
    found = summed.unionByName(empty.select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
