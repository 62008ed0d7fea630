"""The registered queries: each takes (spark, sf_dir) and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import bars as B
from tickloom.operators import ingest as I
from tickloom.operators import select as S
from tickloom.operators import studies as T
from tickloom.operators.instruments import chain_summary, instrument_dimension
from tickloom.operators.profile import histogram, not_finite, pivot_fields, table_profile, to_long
from tickloom.operators.series import Split
from tickloom.operators.sessions import tick_sessions as sessions_of
from tickloom.operators.subscriptions import subscribed, subscribed_as_of, subscription_state
from tickloom.plans import adapters as A
from tickloom.schema import BAR_SCHEMA, SERVICES, SORT_FIELDS
from tickloom.session import configure, scratch_dir
from tickloom.sinks.compaction import CompactedStore
from tickloom.sinks.outcomes import split_feed
from tickloom.sinks.points import BAR_FIELDS, lines_rejects, to_lines, to_points, write_lines
from tickloom.sinks.tables import write_parquet
from tickloom.sources.files import read_bar_csv
from tickloom.streaming.carried import studies_over_available
from tickloom.streaming.keyed import keyed_sma
from tickloom.streaming.revised import revised_over_available
from tickloom.streaming.run import collect_stream, latest_of_updates, require_batches, start_batches
from tickloom.streaming.subscriptions import SubscriptionFold
from tickloom.streaming.totals import ClosedWindows, carry_totals
from tickloom.streaming.windows import (
    ohlcv_bars_sliding_stream as sliding_stream,
    ohlcv_bars_stream,
    screener_metrics_stream,
    tick_sessions_stream as sessions_stream,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Cuts every symbol, so that the checks at small scale also cover the cut form.
SMALL_SPLIT = Split(rows=500)


def _query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


# Moving averages and studies


@_query
def sma_trend_counts(spark, sf_dir):
    trends = T.sma_trend(A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "close"))
    return trends.groupBy("symbol", "trend").agg(F.count(F.lit(1)).alias("n"))


@_query
def sma_trend(spark, sf_dir):
    return T.sma_trend(A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "close"))


@_query
def sma_trend_split(spark, sf_dir):
    return T.sma_trend(A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "close"), split=SMALL_SPLIT)


@_query
def sma_full_window(spark, sf_dir):
    return T.sma_full(A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "price"))


@_query
def sma_stream(spark, sf_dir):
    """Only rows that close a full window of prices, as in `sma_full_window`."""
    ticks = A.tick_stream(spark, sf_dir).select("symbol", "ts", "seq", "price").where(F.col("price").isNotNull())
    study = T.sma("price", 3, full=True)
    out = studies_over_available(spark, ticks, [study], "sma_stream", least_batches=A.STREAM_FILES)
    return out.where(F.col("sma").isNotNull())


@_query
def sma_keyed_stream(spark, sf_dir):
    out = collect_stream(spark, keyed_sma(A.tick_stream(spark, sf_dir)), "sma_keyed", least_batches=A.STREAM_FILES)
    return _ntz(out, "ts")


@_query
def sma_trend_stream(spark, sf_dir):
    ticks = A.tick_stream(spark, sf_dir).select("symbol", "ts", "seq", "close")
    return studies_over_available(spark, ticks, [T.sma(), T.trend()], "sma_trend_stream", least_batches=A.STREAM_FILES)


@_query
def sma_late_stream(spark, sf_dir):
    """As `sma_trend`, from files in which most ticks come late."""
    ticks = A.late_tick_stream(spark, sf_dir).select("symbol", "ts", "seq", "close")
    return revised_over_available(spark, ticks, [T.sma(), T.trend()], "sma_late_stream", least_batches=A.STREAM_FILES)


@_query
def rsi_14(spark, sf_dir):
    df = A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "close")
    return _rounded(T.indicators(df, [T.rsi()]), "rsi")


@_query
def rsi_14_split(spark, sf_dir):
    df = A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "close")
    return _rounded(T.indicators(df, [T.rsi()], split=SMALL_SPLIT), "rsi")


@_query
def rsi_14_wilder(spark, sf_dir):
    df = A.bars(spark, sf_dir).select("symbol", "date", "close")
    return _rounded(T.indicators(df, [T.rsi(wilder=True)], order=("date",)), "rsi")


@_query
def rsi_14_wilder_flat(spark, sf_dir):
    return _rounded(T.indicators(A.flat_ticks(spark, sf_dir), [T.rsi(wilder=True)]), "rsi")


@_query
def rsi_14_wilder_flat_split(spark, sf_dir):
    return _rounded(T.indicators(A.flat_ticks(spark, sf_dir), [T.rsi(wilder=True)], split=SMALL_SPLIT), "rsi")


@_query
def ema_nulls(spark, sf_dir):
    df = A.sparse_ticks(spark, sf_dir).select("symbol", "ts", "seq", "close")
    return _rounded(T.with_studies(df, [T.ema(n=26)]), "ema")


@_query
def ema_nulls_split(spark, sf_dir):
    df = A.sparse_ticks(spark, sf_dir).select("symbol", "ts", "seq", "close")
    return _rounded(T.with_studies(df, [T.ema(n=26)], split=SMALL_SPLIT), "ema")


def _nonfinite(spark, sf_dir):
    return A.odd_ticks(spark, sf_dir).select("symbol", "ts", "seq", "close")


@_query
def ema_nonfinite(spark, sf_dir):
    return _rounded(T.with_studies(_nonfinite(spark, sf_dir), [T.ema()]).drop("close"), "ema")


@_query
def ema_nonfinite_split(spark, sf_dir):
    return _rounded(T.with_studies(_nonfinite(spark, sf_dir), [T.ema()], split=SMALL_SPLIT).drop("close"), "ema")


@_query
def rsi_wilder_nonfinite(spark, sf_dir):
    return _rounded(T.indicators(_nonfinite(spark, sf_dir), [T.rsi(wilder=True)]), "rsi")


@_query
def rsi_wilder_nonfinite_split(spark, sf_dir):
    return _rounded(T.indicators(_nonfinite(spark, sf_dir), [T.rsi(wilder=True)], split=SMALL_SPLIT), "rsi")


@_query
def rsi_wilder_stream(spark, sf_dir):
    ticks = A.tick_stream(spark, sf_dir).select("symbol", "ts", "seq", "close")
    out = studies_over_available(spark, ticks, [T.rsi(wilder=True)], "rsi_wilder_stream", least_batches=A.STREAM_FILES)
    return _rounded(out, "rsi")


@_query
def macd_stream(spark, sf_dir):
    ticks = A.tick_stream(spark, sf_dir).select("symbol", "ts", "seq", "close")
    out = studies_over_available(spark, ticks, [T.macd()], "macd_stream", least_batches=A.STREAM_FILES)
    return _rounded(out, "macd", "macd_signal", "macd_hist")


@_query
def macd(spark, sf_dir):
    df = A.bars(spark, sf_dir).select("symbol", "date", "close")
    return _rounded(T.indicators(df, [T.macd()], order=("date",)), "macd", "macd_signal", "macd_hist")


@_query
def macd_split(spark, sf_dir):
    df = A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "close")
    return _rounded(T.indicators(df, [T.macd()], split=SMALL_SPLIT), "macd", "macd_signal", "macd_hist")


@_query
def bollinger_15_2(spark, sf_dir):
    df = A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "close")
    return _rounded(T.with_studies(df, [T.bollinger()]), "bb_mid", "bb_upper", "bb_lower")


@_query
def price_diff(spark, sf_dir):
    return T.with_studies(A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "close"), [T.diff("close", "change")])


def _cumulative_value(spark, sf_dir, **options):
    df = S.rescale(A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "price"), ["price"])
    return T.cumulative_sum(df, F.col("price").cast("decimal(18,2)"), "total", **options).select(
        "symbol", "ts", "seq", F.round("price", 6).alias("price"), "total"
    )


@_query
def cumulative_value(spark, sf_dir):
    return _cumulative_value(spark, sf_dir)


@_query
def cumulative_value_split(spark, sf_dir):
    return _cumulative_value(spark, sf_dir, split=SMALL_SPLIT)


@_query
def cumulative_value_stream(spark, sf_dir):
    path = scratch_dir(spark, "cumulative")
    ticks = S.rescale(A.tick_stream(spark, sf_dir).select("symbol", "ts", "seq", "price"), ["price"])
    receiver = carry_totals(F.col("price").cast("decimal(18,2)"), "total", path + "/carry", write_parquet(path + "/out"))
    query = start_batches(ticks, receiver, path + "/checkpoint", trigger={"availableNow": True}, skip_empty=False)
    query.awaitTermination()
    require_batches(query, A.STREAM_FILES)
    out = spark.read.parquet(path + "/out")
    return out.select("symbol", "ts", "seq", F.round("price", 6).alias("price"), "total")


def _cumulative_nulls(spark, sf_dir, **options):
    df = A.sparse_ticks(spark, sf_dir).select("symbol", "ts", "seq", "price")
    return T.cumulative_sum(df, F.col("price").cast("decimal(18,2)"), "total", **options)


@_query
def cumulative_nulls(spark, sf_dir):
    return _cumulative_nulls(spark, sf_dir)


@_query
def cumulative_nulls_split(spark, sf_dir):
    return _cumulative_nulls(spark, sf_dir, split=SMALL_SPLIT)


@_query
def volume_direction(spark, sf_dir):
    df = A.bars(spark, sf_dir).select("symbol", "date", "close", "volume")
    return T.with_studies(df, [T.volume_direction()], order=("date",))


@_query
def studies_tail_60(spark, sf_dir):
    df = A.bars(spark, sf_dir).select("symbol", "date", "close", "volume")
    out = T.indicators(df, tail=60, order=("date",))
    return _rounded(out, "rsi", "macd", "macd_signal", "macd_hist")


# Ingest


@_query
def envelope_route_counts(spark, sf_dir):
    routed = I.route(I.parse_envelopes(A.envelopes(spark, sf_dir)))
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@_query
def envelope_flatten(spark, sf_dir):
    return _ntz(I.flatten_ticks(A.envelopes(spark, sf_dir)), "date")


@_query
def parse_bars(spark, sf_dir):
    return _ntz(I.accepted(I.parse_bars(A.bar_messages(spark, sf_dir))).drop("value"), "date")


@_query
def rejected_counts(spark, sf_dir):
    bad = I.rejected(I.parse_bars(A.bar_messages(spark, sf_dir)))
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@_query
def tick_json(spark, sf_dir):
    """Published messages, read again as a consumer would."""
    df = A.ticks(spark, sf_dir).select("symbol", F.col("ts").alias("date"), "close", "volume")
    sent = I.to_messages(df)
    read = I.accepted(I.parse_bars(sent.select("value")))
    return _ntz(read.select("symbol", "date", "close", "volume"), "date")


@_query
def tick_json_full(spark, sf_dir):
    """All twelve columns of published ticks, read again."""
    df = A.sparse_ticks(spark, sf_dir)
    sent = df.select(
        "symbol",
        F.col("ts").alias("date"),
        *[F.col("close").alias(c) for c in ("open", "high", "low", "close")],
        "volume",
        F.col("price").alias("lastPrice"),
        F.col("price").alias("bidPrice"),
        F.col("volume").cast("int").alias("bidSize"),
        (F.col("price") + 1).alias("askPrice"),
        F.col("volume").cast("int").alias("askSize"),
    )
    return _ntz(I.accepted(I.parse_ticks(I.to_messages(sent).select("value"))).drop("value"), "date")


@_query
def price_messages(spark, sf_dir):
    sent = I.to_messages(A.sparse_ticks(spark, sf_dir).select("symbol", "price", "volume", "seq"))
    keyed = sent.select("value", F.get_json_object("value", "$.seq").cast("bigint").alias("seq"))
    return I.accepted(I.parse_prices(keyed)).drop("value")


@_query
def feed_rejected_counts(spark, sf_dir):
    bad = I.feed_rejects(A.faulty_envelopes(spark, sf_dir))
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@_query
def feed_accepted_counts(spark, sf_dir):
    ticks = I.flatten_ticks(A.faulty_envelopes(spark, sf_dir))
    return ticks.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.sum("lastPrice").alias("total"))


@_query
def feed_split_counts(spark, sf_dir):
    """Usable and rejected items of one parse and one write, with the count that was observed meanwhile."""
    written = split_feed(A.faulty_envelopes(spark, sf_dir), scratch_dir(spark, "feed_split"))
    usable = written.accepted(spark).groupBy(F.lit("accepted").alias("outcome"), "symbol").agg(F.count(F.lit(1)).alias("n"))
    reasons = written.rejected(spark).groupBy(F.col("reject_reason").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    rows = usable.unionByName(reasons, allowMissingColumns=True)
    return rows.withColumns({"all_accepted": F.lit(written.accepted_rows), "all_rejected": F.lit(written.rejected_rows)}).withColumns(
        {c: F.col(c).cast("bigint") for c in ("all_accepted", "all_rejected")}
    )


@_query
def bar_csv(spark, sf_dir):
    """Bars written as CSV and read back."""
    path = scratch_dir(spark, "bar_csv")
    bars = A.bars(spark, sf_dir).select(*BAR_SCHEMA.names)
    bars.withColumn("date", F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss")).write.option("header", True).csv(path)
    return _ntz(read_bar_csv(spark, path), "date")


def _untimely(bars):
    """Bars of which some have no time, and some no field with a value, or none with a finite one."""
    odd = F.hour("date")
    bars = bars.withColumns({f: F.when(odd == 9, float("inf")).when(odd != 5, F.col(f)) for f in BAR_FIELDS})
    return bars.withColumn("date", F.when(odd != 7, F.col("date")))


@_query
def lines_rejected_counts(spark, sf_dir):
    bad = lines_rejects(_untimely(A.bars(spark, sf_dir)))
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@_query
def points_tagged(spark, sf_dir):
    bars = A.bars(spark, sf_dir).withColumn("venue", F.concat(F.lit("v "), F.col("symbol")))
    lines = to_lines(bars, "bars", ["close"], {"stock": "symbol", "venue": "venue"})
    made = to_points(bars, "bars", ["close"], {"stock": "symbol", "venue": "venue"})
    return lines.unionByName(made.select(F.concat_ws("|", F.col("tags")["stock"], F.col("tags")["venue"]).alias("line")))


@_query
def line_protocol_stream(spark, sf_dir):
    """Lines of a stream's ticks, written per micro-batch and read back."""
    path = scratch_dir(spark, "lines")
    ticks = A.tick_stream(spark, sf_dir)
    receiver = write_lines(path + "/out", "ticks", fields=["price", "volume"], time="ts")
    query = start_batches(ticks, receiver, path + "/checkpoint", trigger={"availableNow": True})
    query.awaitTermination()
    require_batches(query, A.STREAM_FILES)
    return spark.read.text(path + "/out/*").select(F.col("value").alias("line"))


@_query
def line_protocol(spark, sf_dir):
    return to_lines(A.bars(spark, sf_dir), "bars")


@_query
def points(spark, sf_dir):
    made = to_points(A.bars(spark, sf_dir), "bars")
    return made.select(
        "measurement", "time", F.col("tags")["stock"].alias("stock"), *[F.col("fields")[f].alias(f) for f in BAR_FIELDS]
    )


# Filters, ranges and limits


@_query
def subscribe_filter(spark, sf_dir):
    content = I.explode_content(I.route(I.parse_envelopes(A.envelopes(spark, sf_dir))))
    fields = ("0,3,8", ["0", "3", "12"])
    wanted = {s: ("click,view", fields[i % 2]) for i, s in enumerate(SERVICES)}
    return _ntz(S.subscribe_many(content, wanted), "date")


@_query
def market_session(spark, sf_dir):
    return S.market_session(A.ticks(spark, sf_dir), zone="UTC").select("symbol", "ts", "seq", "price")


@_query
def market_session_new_york(spark, sf_dir):
    return S.market_session(A.ticks(spark, sf_dir), pre_hours=True).select("symbol", "ts", "seq", "price")


@_query
def price_signals(spark, sf_dir):
    return S.price_signals(A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "close"))


@_query
def range_scan(spark, sf_dir):
    recent = S.time_range(A.ticks(spark, sf_dir), "1 day", "2024-01-15 00:00:00")
    return recent.select("symbol", "ts", "seq", "price")


@_query
def range_scan_compacted(spark, sf_dir):
    """As `range_scan`, from a store written in eight batches whose closed days were merged meanwhile."""
    path = scratch_dir(spark, "compacted")
    rows = A.ticks(spark, sf_dir).select("symbol", "ts", "seq", "price")
    store = CompactedStore(path + "/store", rows.schema)

    def receive(batch, batch_id):
        store.receive(batch, batch_id)
        if batch_id % 3 == 2:
            today = batch.agg(F.min(F.to_date("ts"))).first()[0]
            if today is not None:
                store.compact(spark, store.closed_days(spark, today, batch_id - 1), batch_id - 1)
                store.vacuum(spark)

    query = start_batches(A.file_stream(spark, rows, "seq", files=8), receive, path + "/checkpoint", trigger={"availableNow": True})
    query.awaitTermination()
    require_batches(query, 8)
    recent = store.read(spark, date(2024, 1, 14), date(2024, 1, 15))
    return S.time_range(recent, "1 day", "2024-01-15 00:00:00").select("symbol", "ts", "seq", "price")


@_query
def range_pivot(spark, sf_dir):
    """The range bounds are those of bars, so that ticks outside it are never read."""
    recent = S.time_range(A.ticks(spark, sf_dir), "7 days", "2024-01-15 00:00:00")
    long = to_long(B.ohlcv_bars(recent, "1 hour"), BAR_FIELDS)
    return pivot_fields(S.time_range(long, "7 days", "2024-01-15 00:00:00", ts="_time"), BAR_FIELDS)


@_query
def last_60(spark, sf_dir):
    return S.last_rows(A.ticks(spark, sf_dir), 60)


@_query
def last_60_per_symbol(spark, sf_dir):
    return S.last_rows(A.ticks(spark, sf_dir), 60, "symbol")


@_query
def head_5(spark, sf_dir):
    return S.first_rows(A.ticks(spark, sf_dir), 5)


@_query
def business_days(spark, sf_dir):
    """Ticks per business day, days without ticks included."""
    ticks = A.ticks(spark, sf_dir)
    per_day = ticks.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("ticks"))
    return S.business_days(ticks).join(per_day, "day", "left").select("day", F.coalesce("ticks", F.lit(0)).alias("ticks"))


@_query
def business_days_from(spark, sf_dir):
    """Ticks on each of the first 20 business days from a start."""
    ticks = A.ticks(spark, sf_dir)
    per_day = ticks.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("ticks"))
    days = S.business_days_from(spark, "2024-01-06", 20)
    return days.join(per_day, "day", "left").select("day", F.coalesce("ticks", F.lit(0)).alias("ticks"))


# Aggregates


@_query
def histogram_nonfinite(spark, sf_dir):
    df = A.bursts(spark, sf_dir)
    bins = histogram(df, ["price"]).select("bin", "n")
    return bins.unionByName(not_finite(df, ["price"]).select(F.lit(0).alias("bin"), "n"))


@_query
def histogram_15(spark, sf_dir):
    return _rounded(histogram(A.ticks(spark, sf_dir).select("price", "volume")), "bin_start", "bin_end")


@_query
def table_profile_events(spark, sf_dir):
    return table_profile(A.events(spark, sf_dir)).select("column_name", "non_null", "n_rows")


@_query
def table_profile_lineitem(spark, sf_dir):
    return table_profile(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))


@_query
def ohlcv_bars(spark, sf_dir):
    return B.ohlcv_bars(A.ticks(spark, sf_dir), "1 hour")


@_query
def ohlcv_bars_sparse(spark, sf_dir):
    return B.ohlcv_bars(A.sparse_ticks(spark, sf_dir), "1 hour")


@_query
def ohlcv_bars_stream_all(spark, sf_dir):
    """Every bar, also those that no watermark has closed."""
    bars = ohlcv_bars_stream(A.tick_stream(spark, sf_dir))
    return _ntz(latest_of_updates(spark, bars, ["symbol", "date"], "ohlcv_bars_all", A.STREAM_FILES), "date")


@_query
def ohlcv_bars_closed_stream(spark, sf_dir):
    bars = ohlcv_bars_stream(A.tick_stream(spark, sf_dir))
    return _ntz(collect_stream(spark, bars, "ohlcv_bars_stream", A.STREAM_FILES), "date")


@_query
def ohlcv_bars_sliding(spark, sf_dir):
    return B.ohlcv_bars_sliding(A.ticks(spark, sf_dir), "1 hour", "10 minutes")


@_query
def ohlcv_bars_sliding_stream(spark, sf_dir):
    bars = sliding_stream(A.tick_stream(spark, sf_dir), "1 hour", "10 minutes")
    return _ntz(collect_stream(spark, bars, "ohlcv_sliding", A.STREAM_FILES), "date")


@_query
def tick_sessions(spark, sf_dir):
    return sessions_of(A.ticks(spark, sf_dir))


@_query
def tick_sessions_split(spark, sf_dir):
    return sessions_of(A.ticks(spark, sf_dir), split=SMALL_SPLIT)


@_query
def tick_sessions_stream(spark, sf_dir):
    sessions = sessions_stream(A.tick_stream(spark, sf_dir))
    return _ntz(collect_stream(spark, sessions, "tick_sessions", A.STREAM_FILES), "session_start", "session_end")


@_query
def latest_quote(spark, sf_dir):
    return B.latest_quote(A.ticks(spark, sf_dir))


@_query
def latest_quote_per_field(spark, sf_dir):
    return B.latest_quote(A.sparse_ticks(spark, sf_dir), per_field=True)


@_query
def screener_percent_change_up_sparse(spark, sf_dir):
    return _rounded(B.screener(A.sparse_ticks(spark, sf_dir), "EQUITY_ALL_PERCENT_CHANGE_UP_60", k=3), "score")


def _screener(field: str) -> Query:
    def run(spark, sf_dir):
        top = B.screener(A.ticks(spark, sf_dir), f"EQUITY_ALL_{field}_60", k=3)
        return _rounded(top, "score")

    run.__name__ = f"screener_{field.lower()}"
    return _query(run)


for _field in SORT_FIELDS:
    _screener(_field)


@_query
def screener_average_percent_volume_stream(spark, sf_dir):
    """Closed windows, ranked with the sums that the stream has kept of each symbol's windows."""
    path = scratch_dir(spark, "closed_windows")
    closed = ClosedWindows(path)
    metrics = screener_metrics_stream(A.tick_stream(spark, sf_dir), 60)
    query = start_batches(metrics, closed.receive(), path + "/checkpoint", trigger={"availableNow": True}, skip_empty=False)
    query.awaitTermination()
    require_batches(query, A.STREAM_FILES)
    top = closed.ranked(spark, query.lastProgress["batchId"] + 1, k=3)
    return _rounded(_ntz(top, "window_start"), "score")


@_query
def subscription_fold_stream(spark, sf_dir):
    path = scratch_dir(spark, "subscriptions")
    fold = SubscriptionFold(path + "/state")
    commands = A.file_stream(spark, A.command_log(spark, sf_dir), "seq")
    query = start_batches(commands, fold.receive(), path + "/checkpoint", trigger={"availableNow": True}, skip_empty=False)
    query.awaitTermination()
    require_batches(query, A.STREAM_FILES)
    state = fold.state(spark, query.lastProgress["batchId"] + 1)
    return state.select("service", "key", F.array_join("fields", ",").alias("fields"))


@_query
def subscription_fold(spark, sf_dir):
    state = subscription_state(A.command_log(spark, sf_dir))
    return state.select("service", "key", F.array_join("fields", ",").alias("fields"))


@_query
def subscribed_feed(spark, sf_dir):
    """The feed as the current subscriptions let it through."""
    content = I.explode_content(I.route(I.parse_envelopes(A.envelopes(spark, sf_dir))))
    feed = subscribed(content, subscription_state(A.feed_command_log(spark, sf_dir)))
    return _ntz(feed.select("service", "symbol", "date", "lastPrice", "volume", "close"), "date")


@_query
def subscribed_feed_as_of(spark, sf_dir):
    """The feed as the subscriptions of each item's own time let it through."""
    content = I.explode_content(I.route(I.parse_envelopes(A.envelopes(spark, sf_dir))))
    feed = subscribed_as_of(content, A.feed_command_log(spark, sf_dir))
    return _ntz(feed.select("service", "symbol", "date", "lastPrice", "volume", "close"), "date")


@_query
def instrument_chains(spark, sf_dir):
    return chain_summary(instrument_dimension(A.instrument_ticks(spark, sf_dir)))
