"""Mixing sources to target weights by Poisson replication, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, quoted, quoted_all, stored

TEMPERATURE = 0.5
SEED = "mix"
# Above this mean the draw is a sum of independent draws with an equal share of the mean each.
MAX_MEAN = 64.0
# Rows up to which a table of sources may be broadcast (about 10 MB).
SMALL_SOURCES = 20_000


def source_rates(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    epochs: float = 1.0,
    temperature: float = TEMPERATURE,
    source_col: str = "source",
) -> DataFrame:
    """(source, n_docs, rate): how often a document of each source is to be repeated on average.

    `epochs` times the number of documents are dealt to the sources in proportion to `weights`
    (sources without a weight get none), or by default to n_docs ** temperature, and spread evenly
    over each source's documents. A null source is a source like any other; its weight is that of
    key None.
    """
    counted = stored(docs.groupBy(quoted(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n_docs")), "sources")
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(temperature))
    else:
        named = [x for k, w in weights.items() if k is not None for x in (F.lit(k), F.lit(float(w)))]
        known = F.create_map(*named)[F.col("source")] if named else F.lit(None).cast("double")
        weight = F.coalesce(F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 0.0)))).otherwise(known), F.lit(0.0))
    weighted = counted.withColumn("w", weight)
    all_w, all_n = weighted.agg(F.sum("w"), F.sum("n_docs")).first()
    rate = F.lit(epochs * all_n / all_w) * F.col("w") / F.col("n_docs") if all_w else F.lit(0.0)
    return weighted.select("source", "n_docs", rate.alias("rate"))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    epochs: float = 1.0,
    temperature: float = TEMPERATURE,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    copy_col: str | None = None,
) -> DataFrame:
    """`docs` with each row repeated by a Poisson draw, in a random order over all rows.

    The draw inverts the Poisson distribution whose mean is the rate of the row's source, at a
    uniform number made from the seed and the document's id (its text, where the id is null). The
    result depends on the data alone: rows with the same id and source get the same number of copies.
    The rows then go to random partitions and a random place there, by a hash of seed, id and copy.
    `copy_col` adds the number of the copy, from 1. All columns of `docs` stay; an empty table gives an empty one.
    """
    rates = source_rates(docs, weights, epochs, temperature, source_col)
    s, rate, steps, draws, count, copy, key = fresh(docs, "mix_source", "rate", "steps", "draws", "copies", "copy", "mix_key")
    # Cumulative probabilities are made once for each source, not once for each row.
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_MEAN)).cast("int")
    tables = rates.select(
        F.col("source").alias(s), F.col("rate").alias(rate), parts.alias(draws), _cumulative(F.col("rate") / parts).alias(steps)
    )
    if tables.count() <= SMALL_SOURCES:
        tables = F.broadcast(tables)
    name = F.coalesce(quoted(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(quoted(text_col), F.lit("")))))
    drawn = docs.join(tables, quoted(source_col).eqNullSafe(F.col(s))).withColumn(
        count,
        F.aggregate(
            F.sequence(F.lit(1), F.col(draws)),
            F.lit(0).cast("long"),
            lambda sum_, i: sum_ + _inverse(F.col(steps), uniform(F.lit(seed), name, i)),
        ),
    )
    copies = drawn.where(F.col(count) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(count))))
    shuffled = copies.withColumn(key, F.md5(F.concat_ws(":", F.lit(seed), name, F.col(copy).cast("string"))))
    shuffled = shuffled.repartition(key).sortWithinPartitions(key)
    kept = quoted_all(docs.columns)
    return shuffled.select(*kept, F.col(copy).alias(copy_col)) if copy_col else shuffled.select(*kept)


def uniform(seed: Column, name: Column, part: Column) -> Column:
    """A number from 0 to below 1 with 52 bits, made from an MD5 hash."""
    digest = F.md5(F.concat_ws(":", seed, name, part.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _cumulative(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable, far enough for any 52-bit number."""
    last = F.ceil(mean + 10 * F.sqrt(mean) + 40).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["c"])


def _inverse(steps: Column, u: Column) -> Column:
    """The smallest k with P(X <= k) > u."""
    return F.size(F.filter(steps, lambda c: c <= u)).cast("long")
