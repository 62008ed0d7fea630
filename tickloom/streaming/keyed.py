"""Moving average over arrival order with bounded keyed state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


# Rows of a symbol that one micro-batch may bring, and rows that are given out at a time.
MOST_ROWS, OUT_ROWS = 10_000_000, 100_000


def keyed_sma(
    ticks: DataFrame, n: int = 3, symbol: str = "symbol", ts: str = "ts", seq: str = "seq", price: str = "price", most_rows: int = MOST_ROWS
) -> DataFrame:
    """(symbol, ts, seq, price, sma) from a symbol's n-th price on.

    State is the last n - 1 prices of a symbol. Rows of one micro-batch are taken in (ts, seq)
    order; a tick that comes in a later micro-batch counts as later, as in arrival order. To be put in
    order they are held as three numbers a row; a symbol with more than `most_rows` in one micro-batch
    fails it before memory does: limit the trigger, or use `carry_studies`, which cuts busy symbols. Null
    prices are left out.
    """

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        parts, rows = [], 0
        for frame in frames:
            rows += len(frame)
            if rows > most_rows:
                raise ValueError(f"symbol {key[0]!r} has more than {most_rows} rows in one micro-batch: limit the trigger")
            parts.append((frame["ts"].to_numpy(), frame["seq"].to_numpy(dtype="int64"), frame["price"].to_numpy(dtype="float64")))
        at, number, price_now = (np.concatenate(column) for column in zip(*parts))
        place = np.lexsort((number, at))
        prices = np.concatenate([np.asarray(held, dtype="float64"), price_now[place]])
        full = len(prices) - n + 1
        if full > 0:
            # Added in row order, so that sums equal those of the batch form to the bit.
            total = np.zeros(full)
            for j in range(n):
                total += prices[j : j + full]
            out = place[rows - full :]
            for start in range(0, full, OUT_ROWS):
                some = out[start : start + OUT_ROWS]
                means = total[start : start + OUT_ROWS] / n
                yield pd.DataFrame({"symbol": key[0], "ts": at[some], "seq": number[some], "price": price_now[some], "sma": means})
        state.update((prices[len(prices) - min(n - 1, len(prices)) :].tolist(),))

    rows = ticks.select(
        F.col(symbol).alias("symbol"),
        F.col(ts).cast("timestamp").alias("ts"),
        F.col(seq).cast("bigint").alias("seq"),
        F.col(price).cast("double").alias("price"),
    ).where(F.col("price").isNotNull())
    return rows.groupBy("symbol").applyInPandasWithState(
        advance,
        outputStructType="symbol string, ts timestamp, seq bigint, price double, sma double",
        stateStructType="held array<double>",
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )


def sma_text(df: DataFrame, price: str = "price") -> DataFrame:
    """The message form of a moving average; `sma` itself stays numeric."""
    # Fixed value: the message form.
    text = F.format_string("Stock: %s, New Price: %s, SMA: %.2f", "symbol", F.col(price).cast("string"), "sma")
    return df.withColumn("message", text)
