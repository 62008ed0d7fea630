"""A tick or bar store as Parquet, partitioned by day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DAY = "day"


def write_store(df: DataFrame, path: str, ts: str = "ts", symbol: str = "symbol", mode: str = "append") -> None:
    """Write one folder per day, each file sorted by symbol and time.

    Rows are spread by ranges of (day, symbol, time), so a busy day or symbol fills several
    files, and a reader of one symbol skips most row groups.
    """
    order = [DAY, symbol, ts]
    dated = df.withColumn(DAY, F.to_date(ts)).repartitionByRange(*order).sortWithinPartitions(*order)
    dated.write.mode(mode).partitionBy(DAY).parquet(path)


def write_store_batches(path: str, ts: str = "ts", symbol: str = "symbol") -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: a repeated batch replaces its own folder `batch_id=N`."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_store(batch, f"{path}/batch_id={batch_id}", ts, symbol, mode="overwrite")

    return write
