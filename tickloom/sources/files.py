"""File sources with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schema import BAR_SCHEMA


def read_bar_csv(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """OHLCV history as CSV with a header; the first column is the date.

    A file with a `symbol` column keeps it; for a single-instrument file pass `symbol`.
    """
    fields = BAR_SCHEMA.fields if symbol is None else BAR_SCHEMA.fields[1:]
    names = [f.name for f in fields]
    reader = spark.read.schema(T.StructType(fields)).option("header", True).option("enforceSchema", True)
    bars = reader.csv(path)
    if symbol is not None:
        bars = bars.withColumn("symbol", F.lit(symbol))
    return bars.select("symbol", *[n for n in names if n != "symbol"])


def stream_parquet(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 1) -> DataFrame:
    """A Parquet table as a stream, oldest file first, a bounded number of files per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_text(spark: SparkSession, path: str, max_files_per_trigger: int = 1) -> DataFrame:
    """A folder of one-message-per-line files as a stream with a `value` column."""
    return spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path)
