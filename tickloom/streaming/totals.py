"""Running totals and leave-one-out means on a stream, from a carry per symbol."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.bars import rank_screener, volume_totals
from tickloom.operators.scan import OLD
from tickloom.operators.series import DEFAULT_SPLIT, Split, as_keys
from tickloom.operators.studies import cumulative_sum
from tickloom.session import scratch_scope
from tickloom.sinks.tables import write_parquet
from tickloom.streaming.state import NEW, TURN, StateLog, in_turn, of_keys


def carry_totals(
    value: Column,
    out: str,
    path: str,
    write: Callable[[DataFrame, int], None],
    keys: str | Sequence[str] = "symbol",
    order: Sequence[str] = ("ts", "seq"),
    split: Split = DEFAULT_SPLIT,
    full_every: int = 32,
) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch` (with `skip_empty=False`): `cumulative_sum` over all rows so far.

    The folder `path` is a ledger with one row per symbol: its last row's time and total (see `StateLog`).
    That row comes before those of the batch as one more value, so the sum goes on from it also where a
    busy symbol is cut. A repeated batch starts from the same totals. Give a DECIMAL value, as sums of
    doubles depend on the batches. A row that comes late counts as later.
    """
    names, order = as_keys(keys), list(order)
    log = StateLog(path, names, full_every)

    def handle(batch: DataFrame, batch_id: int) -> None:
        plain = batch.columns
        valued = batch.withColumn("_value", value)
        kind = valued.agg(F.sum("_value").alias("total")).schema["total"].dataType
        rows = valued.withColumns({OLD: F.lit(False), "_value": F.col("_value").cast(kind)})
        carried = T.StructType([*[batch.schema[c] for c in dict.fromkeys([*names, *order])], T.StructField("_value", kind)])
        before = log.before(batch.sparkSession, carried, batch_id)
        if before is not None:
            old = of_keys(before, batch, names, "left_semi").withColumn(OLD, F.lit(True))
            rows = rows.unionByName(old, allowMissingColumns=True)
        rows.persist()
        summed = None
        try:
            with scratch_scope():
                most, turn = rows.count(), [TURN, NEW, *order]
                placed = in_turn(rows, names, order[0], most <= split.rows)
                summed = cumulative_sum(placed, F.col("_value"), out, names, turn, split, most)
                summed = summed.withColumn(out, F.col(out).cast(kind)).persist()
                write(summed.where(~F.col(OLD)).select(*plain, out), batch_id)
                last = summed.groupBy(*names).agg(
                    *[F.max_by(c, F.struct(*turn)).alias(c) for c in order if c not in names], F.max_by(out, F.struct(*turn)).alias("_value")
                )
                log.write(last.select(*carried.names), batch_id)
        finally:
            for held in (summed, rows):
                if held is not None:
                    held.unpersist()

    return handle


class ClosedWindows:
    """Screener windows that a stream has closed, with a running sum and count of each symbol's volumes.

    `receive` is for `foreachBatch` on `screener_metrics_stream` (with `skip_empty=False`). The mean of a
    symbol's other windows then takes one row of the state and the window itself, not the symbol's history.
    """

    def __init__(self, path: str, full_every: int = 32):
        self.log = StateLog(f"{path}/totals", "symbol", full_every)
        self.folder = f"{path}/windows"
        self.state = T.StructType().add("symbol", "string").add("windows", "long").add("total", "double")

    def _after(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The totals of the batch's symbols, this batch included."""
        own = volume_totals(batch).select(*[F.col(f.name).cast(f.dataType) for f in self.state])
        before = self.log.before(batch.sparkSession, self.state, batch_id)
        if before is not None:
            own = own.unionByName(of_keys(before, batch, ["symbol"], "left_semi"))
        return own.groupBy("symbol").agg(F.sum("windows").alias("windows"), F.sum("total").alias("total"))

    def receive(self, write: Callable[[DataFrame, int], None] | None = None, sort_field: str = "AVERAGE_PERCENT_VOLUME", k: int = 10):
        """Keeps closed windows; `write` gets the ranks of each batch's windows against all closed so far."""

        def handle(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                write_parquet(self.folder)(batch, batch_id)
                self.log.write(self._after(batch, batch_id), batch_id)
                if write is not None:
                    totals = self.log.before(batch.sparkSession, self.state, batch_id + 1)
                    write(rank_screener(batch, sort_field, k, totals), batch_id)
            finally:
                batch.unpersist()

        return handle

    def ranked(self, spark: SparkSession, batches: int, sort_field: str = "AVERAGE_PERCENT_VOLUME", k: int = 10) -> DataFrame:
        """All windows closed in that many batches, ranked with the totals after them."""
        totals = self.log.before(spark, self.state, batches)
        windows = spark.read.parquet(self.folder).where(F.col("batch_id") < batches).drop("batch_id")
        return rank_screener(windows, sort_field, k, totals)
