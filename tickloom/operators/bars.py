"""Bars, latest quotes and screeners from ticks.

All are plain grouped aggregates over numbers, so rows are combined before the shuffle and a
busy symbol costs one small row per task and group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tickloom.functions.columns import order_key
from tickloom.operators.series import as_keys
from tickloom.schema import FREQUENCIES, SORT_FIELDS


def ohlcv_bars(
    ticks: DataFrame,
    interval: str = "1 hour",
    price: str = "price",
    volume: str = "volume",
    keys: str | Sequence[str] = "symbol",
    ts: str = "ts",
    seq: str = "seq",
) -> DataFrame:
    """Open, high, low, close and volume per symbol and tumbling interval.

    Works on a stream too, after `withWatermark` on `ts`.
    """
    return (
        # A tick without a price neither opens nor closes a bar.
        ticks.withColumn("_at", F.when(F.col(price).isNotNull(), order_key(F.col(ts), F.col(seq))))
        .groupBy(*as_keys(keys), F.window(F.col(ts), interval).alias("_w"))
        .agg(
            F.min_by(price, "_at").alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, "_at").alias("close"),
            F.sum(volume).alias("volume"),
            F.count(F.lit(1)).alias("trades"),
        )
        .select(
            *as_keys(keys), F.col("_w.start").alias("date"), "open", "high", "low", "close", "volume", "trades"
        )
    )


def ohlcv_bars_sliding(
    ticks: DataFrame,
    width: str = "1 hour",
    step: str = "10 minutes",
    price: str = "price",
    volume: str = "volume",
    keys: str | Sequence[str] = "symbol",
    ts: str = "ts",
    seq: str = "seq",
) -> DataFrame:
    """Bars of all windows of `width` that begin at a multiple of `step` and hold a tick.

    `width` is a multiple of `step`. Ticks are reduced once to panes of one step. Panes are taken in
    blocks of as many as a window holds, counted from the epoch; a window is then the rest of one block
    and the beginning of the next, so its bar is merged from two rows, however many panes it spans. The
    windows over panes stay within a symbol's block, so that no task holds a symbol.
    """
    keys = as_keys(keys)
    length, pane = _micros(width), _micros(step)
    if length % pane:
        raise ValueError(f"{width} is no multiple of {step}")
    panes = length // pane
    key = order_key(F.col(ts), F.col(seq))
    at = F.when(F.col(price).isNotNull(), key)
    reduced = (
        ticks.where(F.col(ts).isNotNull())
        .withColumns({"_at": at, "_i": F.expr(_floor_div(ts, pane))})
        .groupBy(*keys, "_i")
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
        .withColumn("_block", F.expr(f"_i - pmod(_i, {panes}L)"))
    )
    block = Window.partitionBy(*keys, "_block")
    onwards = block.orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, 0)
    so_far = block.orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("_block") + panes - 1
    after = F.coalesce(F.lead("_i").over(block.orderBy("_i")) - 1, end)
    before = F.coalesce(F.lag("_i").over(block.orderBy("_i")) + 1, F.col("_block"))
    # From each pane on to its block's end, for the windows whose first pane in the block it is; and up to
    # each pane, for those that began in the block before and of which it is the last pane here.
    rest = reduced.select(*keys, before.alias("_lo"), F.col("_i").alias("_hi"), *_merged(lambda c: c.over(onwards)))
    begun = reduced.select(*keys, F.col("_i").alias("_lo"), F.least(after, end - 1).alias("_hi"), *_merged(lambda c: c.over(so_far)))
    begun = begun.withColumns({"_lo": F.col("_lo") - (panes - 1), "_hi": F.col("_hi") - (panes - 1)}).where("_lo <= _hi")
    halves = rest.unionByName(begun).withColumn("_start", F.explode(F.sequence("_lo", "_hi")))
    zone = isinstance(ticks.schema[ts].dataType, TimestampNTZType)
    start = F.timestamp_micros(F.col("_start") * pane)
    return (
        halves.groupBy(*keys, "_start")
        .agg(*_merged(lambda c: c))
        .select(
            *keys, (start.cast("timestamp_ntz") if zone else start).alias("date"), "open", "high", "low", "close", "volume", "trades"
        )
    )


def _micros(interval: str) -> int:
    """A fixed length such as '10 minutes' in microseconds."""
    number, unit = interval.split()
    sizes = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6}
    size = sizes.get(unit.rstrip("s"))
    if size is None or int(number) <= 0:
        raise ValueError(f"not a fixed length: {interval!r}")
    return int(number) * size


def _floor_div(ts: str, size: int) -> str:
    at = f"unix_micros(CAST(`{ts}` AS TIMESTAMP))"
    return f"({at} - pmod({at}, {size}L)) div {size}L"


def _merged(over) -> list[Column]:
    """Two or more parts of a bar made one; `over` places the aggregates."""
    parts = {
        "open": F.min_by("open", "_first"),
        "_first": F.min("_first"),
        "high": F.max("high"),
        "low": F.min("low"),
        "close": F.max_by("close", "_last"),
        "_last": F.max("_last"),
        "volume": F.sum("volume"),
        "trades": F.sum("trades"),
    }
    return [over(part).alias(name) for name, part in parts.items()]


def latest_quote(
    ticks: DataFrame,
    keys: str | Sequence[str] = "symbol",
    ts: str = "ts",
    seq: str = "seq",
    per_field: bool = False,
) -> DataFrame:
    """The last tick of each symbol by (ts, seq); with `per_field` the last known value of each column.

    The feed sends only what changed, so a whole last tick may lack most fields.
    """
    keys = as_keys(keys)
    rest = [c for c in ticks.columns if c not in keys]
    keyed = ticks.withColumn("_at", order_key(F.col(ts), F.col(seq)))
    at = {c: F.when(F.col(c).isNotNull(), F.col("_at")) if per_field else F.col("_at") for c in rest}
    return keyed.groupBy(*keys).agg(*[F.max_by(c, at[c]).alias(c) for c in rest]).select(*ticks.columns)


def parse_screener_key(key: str) -> tuple[str, str, int]:
    """PREFIX_SORTFIELD_FREQUENCY, e.g. `NASDAQ_VOLUME_30`; the prefix may hold underscores."""
    head, _, minutes = key.rpartition("_")
    # Longest first, as AVERAGE_PERCENT_VOLUME also ends in VOLUME.
    for field in sorted(SORT_FIELDS, key=len, reverse=True):
        if head.endswith(f"_{field}") and minutes.isdigit() and int(minutes) in FREQUENCIES:
            return head[: -len(field) - 1], field, int(minutes)
    raise ValueError(f"not a screener key: {key!r}")


def screener_metrics(
    ticks: DataFrame,
    minutes: int = 60,
    price: str = "price",
    volume: str = "volume",
    symbol: str = "symbol",
    ts: str = "ts",
    seq: str = "seq",
) -> DataFrame:
    """Volume, trades and percent change per symbol and window; 0 minutes is a whole day."""
    interval = f"{minutes} minutes" if minutes else "1 day"
    bars = ohlcv_bars(ticks, interval, price, volume, symbol, ts, seq)
    first = F.when(F.col("open") != 0, F.col("open"))
    return bars.select(
        F.col(symbol).alias("symbol"),
        F.col("date").alias("window_start"),
        F.col("volume"),
        F.col("trades"),
        ((F.col("close") - first) / first * 100).alias("percent_change"),
    )


def volume_totals(metrics: DataFrame) -> DataFrame:
    """(symbol, windows, total): how many windows of a symbol have a volume, and its sum."""
    return metrics.groupBy("symbol").agg(F.count("volume").alias("windows"), F.sum("volume").alias("total"))


def rank_screener(metrics: DataFrame, sort_field: str, k: int = 10, totals: DataFrame | None = None) -> DataFrame:
    """Top k symbols of each window; ties by symbol, symbols without the metric left out.

    AVERAGE_PERCENT_VOLUME is 100 * volume / mean volume of the symbol's other windows, of which `totals`
    (see `volume_totals`) has the sums; by default those of `metrics`.
    """
    if sort_field not in SORT_FIELDS:
        raise ValueError(f"unknown sort field: {sort_field!r}")
    if sort_field == "AVERAGE_PERCENT_VOLUME":
        own = (volume_totals(metrics) if totals is None else totals).select(
            F.col("symbol").alias("_symbol"), F.col("windows").alias("_windows"), F.col("total").alias("_total")
        )
        metrics = metrics.join(own, F.col("symbol").eqNullSafe(F.col("_symbol")))
        others, windows = F.col("_total") - F.col("volume"), F.col("_windows") - 1
        mean = F.when((windows > 0) & (others != 0), others / windows)
        score = 100 * F.col("volume") / mean
    else:
        score = {
            "VOLUME": F.col("volume"),
            "TRADES": F.col("trades"),
            "PERCENT_CHANGE_UP": F.col("percent_change"),
            "PERCENT_CHANGE_DOWN": F.col("percent_change"),
        }[sort_field].cast("double")
    scored = metrics.withColumn("score", score).where(F.col("score").isNotNull())
    best = F.col("score").asc() if sort_field == "PERCENT_CHANGE_DOWN" else F.col("score").desc()
    rank = F.row_number().over(Window.partitionBy("window_start").orderBy(best, F.col("symbol")))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("window_start", "rank", "symbol", "score")


def screener(ticks: DataFrame, key: str, k: int = 10, **columns: str) -> DataFrame:
    """Top k per window for a screener key.

    The key's prefix names a universe of symbols, which ticks do not carry: pass the ticks of
    that universe.
    """
    _, sort_field, minutes = parse_screener_key(key)
    return rank_screener(screener_metrics(ticks, minutes, **columns), sort_field, k)
