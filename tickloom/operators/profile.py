"""Table profile, histograms, and the long and wide forms of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, non-null count, row count. One pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.col(f"c{i}").alias("non_null"),
                F.col("n_rows"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return counts.select(F.inline(rows))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 15) -> DataFrame:
    """Equal-width bins over [min, max] of each numeric column, the last bin closed.

    Every bin is listed, with n = 0 where it is empty; nulls, NaN and infinities are not counted (see
    `not_finite`). A constant
    column has all its rows in bin 1. The bounds joined back are one row per column.
    """
    columns = list(columns or numeric_columns(df))
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot([], columns, "column_name", "v").where(_finite("v"))
    bounds = long.groupBy("column_name").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    step = (F.col("hi") - F.col("lo")) / bins
    position = F.when(F.col("hi") > F.col("lo"), F.floor((F.col("v") - F.col("lo")) / step) + 1).otherwise(1)
    counted = (
        long.join(F.broadcast(bounds), "column_name")
        .select("column_name", F.least(position, F.lit(bins)).cast("int").alias("bin"))
        .groupBy("column_name", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = bounds.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins)))).select(
        "column_name",
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * step).alias("bin_start"),
        F.when(F.col("bin") == bins, F.col("hi")).otherwise(F.col("lo") + F.col("bin") * step).alias("bin_end"),
    )
    # `counted` has at most `bins` rows per column, whatever the table.
    return edges.join(F.broadcast(counted), ["column_name", "bin"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("bigint"))
    )


def _finite(name: str) -> Column:
    return F.col(name).isNotNull() & ~F.isnan(name) & (F.abs(name) < float("inf"))


def not_finite(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, n): the values that a histogram leaves out, nulls not counted."""
    columns = list(columns or numeric_columns(df))
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "v")
    odd = F.col("v").isNotNull() & ~_finite("v")
    return long.groupBy("column_name").agg(F.count(F.when(odd, 1)).alias("n"))


def to_long(df: DataFrame, fields: Sequence[str], time: str = "date", tags: Sequence[str] = ("symbol",)) -> DataFrame:
    """Wide bars to (_time, tags, _field, _value)."""
    return df.unpivot([time, *tags], list(fields), "_field", "_value").withColumnRenamed(time, "_time")


def pivot_fields(long: DataFrame, fields: Sequence[str], tags: Sequence[str] = ("symbol",)) -> DataFrame:
    """One row per (_time, tags) and one column per field.

    A series holds one value per time and field; should there be more, the largest is kept so
    that reruns agree. The field list is given, so no extra pass looks for it.
    """
    return long.groupBy("_time", *tags).pivot("_field", list(fields)).agg(F.max("_value"))


def pivot_conflicts(long: DataFrame, tags: Sequence[str] = ("symbol",)) -> DataFrame:
    """(_time, tags, _field, n): where a series holds several values, of which `pivot_fields` keeps the largest."""
    counted = long.groupBy("_time", *tags, "_field").agg(F.count("_value").alias("n"))
    return counted.where(F.col("n") > 1)
