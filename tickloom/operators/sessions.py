"""Activity sessions: runs of a symbol's ticks without a long pause between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import order_key
from tickloom.operators.bars import _micros
from tickloom.operators.series import CHUNK, DEFAULT_SPLIT, HALO, Split, as_keys, cut_series


def tick_sessions(
    ticks: DataFrame,
    gap: str = "30 minutes",
    price: str = "price",
    volume: str = "volume",
    keys: str | Sequence[str] = "symbol",
    order: Sequence[str] = ("ts", "seq"),
    split: Split = DEFAULT_SPLIT,
) -> DataFrame:
    """(keys, session_start, session_end, ticks, open, close, volume): a tick at least `gap` after the one
    before it begins a new session.

    Symbols are cut along time. Within a chunk, sessions are numbered by a running count of their first
    ticks and reduced to a row each. What comes before a chunk's first such tick goes on from a chunk
    before: the start is then the last one of the chunks before, of which there is one row each, and the
    parts of a session that chunks share are merged by it. Ticks without a time are in no session.
    """
    keys, (ts, seq) = as_keys(keys), order
    timed = ticks.where(F.col(ts).isNotNull())
    cut, frame = cut_series(timed, keys, order, look_back=1, split=split)
    at = f"unix_micros(CAST(`{ts}` AS TIMESTAMP))"
    starts = f"coalesce({at} - lag({at}) OVER ({frame}) >= {_micros(gap)}L, true)"
    # The copied row before a chunk is only looked back at; without one the first row starts a session.
    numbered = (
        cut.withColumn("_at", order_key(F.col(ts), F.col(seq)))
        .selectExpr("*", f"NOT {HALO} AND {starts} AS _starts")
        .where(~F.col(HALO))
        .selectExpr("*", f"count_if(_starts) OVER ({frame} ROWS UNBOUNDED PRECEDING) AS _number")
    )
    parts = numbered.groupBy(*keys, CHUNK, "_number").agg(
        F.min(ts).alias("_lo"),
        F.max(ts).alias("_hi"),
        F.min("_at").alias("_first"),
        F.max("_at").alias("_last"),
        F.count(F.lit(1)).alias("n"),
        F.min_by(price, F.when(F.col(price).isNotNull(), F.col("_at"))).alias("open"),
        F.min(F.when(F.col(price).isNotNull(), F.col("_at"))).alias("_open_at"),
        F.max_by(price, F.when(F.col(price).isNotNull(), F.col("_at"))).alias("close"),
        F.max(F.when(F.col(price).isNotNull(), F.col("_at"))).alias("_close_at"),
        F.sum(volume).alias("volume"),
    )
    if frame.cut:
        started = F.max(F.when(F.col("_number") > 0, F.col("_first")))
        chunks = parts.groupBy(*[F.col(k).alias(f"_j_{k}") for k in keys], F.col(CHUNK).alias("_j_chunk")).agg(started.alias("_started"))
        earlier = Window.partitionBy(*[f"_j_{k}" for k in keys]).orderBy("_j_chunk").rowsBetween(Window.unboundedPreceding, -1)
        chunks = chunks.withColumn("_carried", F.max("_started").over(earlier)).drop("_started")
        same = " AND ".join([*[f"`{k}` <=> `_j_{k}`" for k in keys], f"{CHUNK} = _j_chunk"])
        # One row per chunk, whose number the settings of the cut bound.
        parts = parts.join(F.broadcast(chunks), F.expr(same))
        parts = parts.withColumn("_first", F.when(F.col("_number") > 0, F.col("_first")).otherwise(F.col("_carried")))
    return (
        parts.groupBy(*keys, "_first")
        .agg(
            F.min("_lo").alias("session_start"),
            F.max("_hi").alias("session_end"),
            F.sum("n").alias("ticks"),
            F.min_by("open", "_open_at").alias("open"),
            F.max_by("close", "_close_at").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .drop("_first")
    )
