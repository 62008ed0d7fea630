"""Event-time operators on streams: bars, screener windows, latest quotes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import order_key
from tickloom.operators.bars import _merged, latest_quote, ohlcv_bars, rank_screener, screener_metrics


def _event_time(ticks: DataFrame, ts: str, delay: str) -> DataFrame:
    # Watermarks need a timestamp with zone.
    return ticks.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def ohlcv_bars_stream(
    ticks: DataFrame, interval: str = "1 hour", delay: str = "10 minutes", ts: str = "ts", **columns: str
) -> DataFrame:
    """Bars that the watermark has closed. Ticks later than `delay` are dropped by Spark."""
    return ohlcv_bars(_event_time(ticks, ts, delay), interval, ts=ts, **columns)


def ohlcv_bars_sliding_stream(
    ticks: DataFrame,
    width: str = "1 hour",
    step: str = "10 minutes",
    delay: str = "10 minutes",
    price: str = "price",
    volume: str = "volume",
    symbol: str = "symbol",
    ts: str = "ts",
    seq: str = "seq",
) -> DataFrame:
    """`ohlcv_bars_sliding` of the windows that the watermark has closed.

    Ticks are reduced to panes of one step, each of them once; windows are then merged from closed panes
    by a second aggregate, whose state holds one row per symbol and open window.
    """
    at = F.when(F.col(price).isNotNull(), order_key(F.col(ts), F.col(seq)))
    panes = (
        _event_time(ticks, ts, delay)
        .withColumn("_at", at)
        .groupBy(symbol, F.window(ts, step).alias("_pane"))
        .agg(
            F.min_by(price, "_at").alias("open"),
            F.min("_at").alias("_first"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, "_at").alias("close"),
            F.max("_at").alias("_last"),
            F.sum(volume).alias("volume"),
            F.count(F.lit(1)).alias("trades"),
        )
    )
    windows = panes.groupBy(symbol, F.window(F.window_time("_pane"), width, step).alias("_w")).agg(*_merged(lambda c: c))
    return windows.select(symbol, F.col("_w.start").alias("date"), "open", "high", "low", "close", "volume", "trades")


def tick_sessions_stream(
    ticks: DataFrame,
    gap: str = "30 minutes",
    delay: str = "10 minutes",
    price: str = "price",
    volume: str = "volume",
    symbol: str = "symbol",
    ts: str = "ts",
    seq: str = "seq",
) -> DataFrame:
    """`sessions.tick_sessions` that the watermark has closed; the state holds one row per open session."""
    at = order_key(F.col(ts), F.col(seq))
    sessions = (
        _event_time(ticks, ts, delay)
        .withColumns({"_at": at, "_priced": F.when(F.col(price).isNotNull(), at)})
        .groupBy(symbol, F.session_window(ts, gap).alias("_w"))
        .agg(
            F.max(ts).alias("session_end"),
            F.count(F.lit(1)).alias("ticks"),
            F.min_by(price, "_priced").alias("open"),
            F.max_by(price, "_priced").alias("close"),
            F.sum(volume).alias("volume"),
        )
    )
    return sessions.select(symbol, F.col("_w.start").alias("session_start"), "session_end", "ticks", "open", "close", "volume")


def screener_metrics_stream(
    ticks: DataFrame, minutes: int = 60, delay: str = "10 minutes", ts: str = "ts", **columns: str
) -> DataFrame:
    """Closed windows of screener metrics; rank them per micro-batch with `rank_closed`."""
    return screener_metrics(_event_time(ticks, ts, delay), minutes, ts=ts, **columns)


def rank_closed(sort_field: str, k: int, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch` on `screener_metrics_stream`: all symbols of a closed window come in
    one micro-batch, so ranking the batch ranks the window."""
    if sort_field == "AVERAGE_PERCENT_VOLUME":
        raise ValueError("needs the symbol's other windows: use totals.ClosedWindows")

    def handle(batch: DataFrame, batch_id: int) -> None:
        write(rank_screener(batch, sort_field, k), batch_id)

    return handle


def latest_quote_stream(ticks: DataFrame, **columns: str) -> DataFrame:
    """The last tick per symbol so far; run in update mode. One state row per symbol."""
    return latest_quote(ticks, **columns)
