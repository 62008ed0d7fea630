"""Starting streaming queries: a checkpoint is always required."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tickloom.session import scratch_dir
from tickloom.sinks.tables import write_parquet


def start_batches(
    df: DataFrame,
    receiver: Callable[..., None],
    checkpoint: str,
    *args,
    mode: str = "append",
    trigger: dict | None = None,
    skip_empty: bool = True,
    **kwargs,
) -> StreamingQuery:
    """Call `receiver(batch_df, batch_id, *args, **kwargs)` once per micro-batch.

    With `skip_empty` batches without rows are not passed on. The batch id does not change when
    a batch is repeated after a failure, which lets sinks replace what they wrote.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if skip_empty and batch.isEmpty():
            return
        partial(receiver, batch, batch_id, *args, **kwargs)()

    writer = df.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "0 seconds"})).start()


def write_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what the source holds now into a Parquet file sink, then stop."""
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def collect_stream(spark: SparkSession, df: DataFrame, label: str, least_batches: int = 1) -> DataFrame:
    """Run a streaming DataFrame over the available input and return its output as a table."""
    path = scratch_dir(spark, label)
    require_batches(write_available(df, path + "/out", path + "/checkpoint"), least_batches)
    return spark.read.schema(df.schema).parquet(path + "/out")


def latest_of_updates(
    spark: SparkSession, df: DataFrame, keys: Sequence[str], label: str, least_batches: int = 1
) -> DataFrame:
    """Run an aggregate in update mode and return the last update of each key.

    Unlike append mode this also gives the groups that no watermark has closed yet. A micro-batch
    that is repeated replaces its own updates. An empty one is written too, as seeing that it is empty
    would run the aggregate once more.
    """
    path = scratch_dir(spark, label)
    receiver = write_parquet(path + "/out")
    query = start_batches(
        df, receiver, path + "/checkpoint", mode="update", trigger={"availableNow": True}, skip_empty=False
    )
    query.awaitTermination()
    require_batches(query, least_batches)
    rest = [c for c in df.columns if c not in keys]
    schema = T.StructType([*df.schema.fields, T.StructField("batch_id", T.LongType())])
    updates = spark.read.schema(schema).parquet(path + "/out")
    return updates.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in rest]).select(*df.columns)


def require_batches(query: StreamingQuery, least: int) -> None:
    """Fails unless the query has taken that many micro-batches."""
    seen = query.lastProgress["batchId"] + 1 if query.lastProgress else 0
    if seen < least:
        raise RuntimeError(f"{seen} micro-batches, expected {least} at least")


class DeliveryCount(StreamingQueryListener):
    """Counts all micro-batches and rows of a query, however long it runs.

    Add it to `spark.streams` before the query starts; `recentProgress` forgets all but the last ones.
    """

    def __init__(self, name: str | None = None):
        self.name, self.batches, self.rows = name, 0, 0

    def onQueryProgress(self, event) -> None:
        if self.name in (None, event.progress.name):
            self.batches += 1
            self.rows += event.progress.numInputRows

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def delivery_report(query: StreamingQuery) -> dict[str, int]:
    """Batches and rows of the recent progress of a query; see `DeliveryCount` for all of them."""
    progress = query.recentProgress
    return {"batches": len(progress), "rows": sum(p["numInputRows"] for p in progress)}
