"""Typed rows into tables: Parquet folders, JDBC databases, Kafka topics, the console."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.ingest import to_messages


def write_parquet(path: str) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: a repeated batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


ROW_NO = "row_no"


def append_missing(
    read_batch: Callable[[DataFrame, int], DataFrame], append: Callable[[DataFrame], None], keys: Sequence[str]
) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: append the rows of a batch that the target does not hold yet.

    A database append commits task by task, so a failed batch may leave some rows behind.
    `read_batch` gives the target's rows of this batch; the repeated batch adds only the rest. Rows of
    a batch that share their keys (nulls are values) are numbered by their other columns, so the number is
    the same when a batch is repeated. The target has columns `batch_id` and `row_no` for this.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        others = [c for c in batch.columns if c not in keys] or list(keys)
        number = F.row_number().over(Window.partitionBy(*keys).orderBy(*others))
        rows = batch.withColumns({ROW_NO: number, "batch_id": F.lit(batch_id).cast("bigint")})
        names = [*keys, ROW_NO]
        present = read_batch(batch, batch_id).select(*[F.col(k).alias(f"_p_{k}") for k in names])
        same = " AND ".join(f"`{k}` <=> `_p_{k}`" for k in names)
        append(rows.join(present, F.expr(same), "left_anti"))

    return write


def write_jdbc(
    url: str, table: str, keys: Sequence[str] = ("symbol", "date"), properties: Mapping[str, str] | None = None
) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: typed rows into a database table that also has the columns `batch_id` and `row_no`.

    Message text is never run as SQL. The batch filter is pushed down to the database.
    """
    options = {"url": url, "dbtable": table, **(properties or {})}

    def read_batch(batch: DataFrame, batch_id: int) -> DataFrame:
        table_rows = batch.sparkSession.read.format("jdbc").options(**options).load()
        return table_rows.where(F.col("batch_id") == batch_id)

    def append(rows: DataFrame) -> None:
        rows.write.format("jdbc").options(**options).mode("append").save()

    return append_missing(read_batch, append, keys)


def publish(ticks: DataFrame, servers: str, topic: str) -> None:
    """A batch of ticks to a Kafka topic, keyed by symbol."""
    to_messages(ticks).write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def publish_stream(ticks: DataFrame, servers: str, topic: str, checkpoint: str):
    """A stream of ticks to a Kafka topic, keyed by symbol."""
    writer = to_messages(ticks).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("topic", topic).option("checkpointLocation", checkpoint).start()


def show_stream(df: DataFrame, checkpoint: str, mode: str = "append"):
    """Print each micro-batch to the console."""
    return df.writeStream.format("console").outputMode(mode).option("checkpointLocation", checkpoint).start()
