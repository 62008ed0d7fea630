"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import configure, scratch_dir

# Arrow batches end at whichever comes first, so that very long texts do not pile up in one batch.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def ready(spark: SparkSession) -> SparkSession:
    """The session with the settings that these operators rely on."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared scratch folder and read back.

    Later steps then neither repeat its work nor depend on the executors that did it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> tuple[str, ...]:
    """Column names that `df` does not have yet, made from `names`."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return tuple(found)


def quoted(name: str) -> Column:
    """The column of this very name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def quoted_all(names: list[str]) -> list[Column]:
    return [quoted(n) for n in names]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def remainder(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus


def per_text(
    docs: DataFrame,
    make: Callable[[], Callable[[list[str]], dict[str, list]]],
    fields: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    cast: bool = True,
) -> DataFrame:
    """One row per document: its id and what the function that `make` gives returns for its text.

    `make` runs once per task, on the executor; the function takes a batch of whole texts (null as
    empty) and gives one list per field of `fields`. Without `cast` it gets the column as it is.
    """
    added = T.StructType.fromDDL(fields)
    source = docs.select(quoted(id_col), (text_or_empty(text_col) if cast else quoted(text_col)).alias("text"))
    schema = T.StructType([source.schema.fields[0], *added.fields])
    out = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            got = work(batch.column(1).to_pylist())
            arrays = [batch.column(0).cast(out.field(0).type)]
            arrays += [pa.array(got[f.name], type=out.field(f.name).type) for f in added.fields]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return source.mapInArrow(run, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
