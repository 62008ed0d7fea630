"""Hand-made cases for columns, selection, bars, profile, instruments and studies."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions.columns import line_protocol, number_text, order_key
from tickloom.operators import bars as B
from tickloom.operators import profile as P
from tickloom.operators import select as S
from tickloom.operators import studies as T
from tickloom.operators.instruments import parse_instruments
from tickloom.sources.files import read_bar_csv
from tickloom.sources.kafka import kafka_options

T0 = dt.datetime(2024, 1, 2, 15, 0)


def series(spark, prices, symbol="A"):
    rows = [(symbol, T0 + dt.timedelta(minutes=i), i, p, 1.0) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, seq bigint, close double, volume double")


def column(df, name, order="seq"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_sma_trend_by_hand(spark):
    out = T.sma_trend(series(spark, [1.0, 3.0, 5.0, 5.0, 5.0, 2.0, None, 2.0])).cache()
    assert column(out, "sma") == [1.0, 2.0, 3.0, 13 / 3, 5.0, 4.0, 3.5, 2.0]
    assert column(out, "trend") == ["flat", "up", "up", "up", "up", "down", "down", "down"]


def test_trend_labels_are_a_parameter(spark):
    out = T.with_studies(series(spark, [1.0, 2.0, 1.0]), [T.trend("close", labels=("涨", "跌", "平"))])
    assert column(out, "trend") == ["平", "涨", "跌"]


def test_symbols_do_not_mix(spark):
    both = series(spark, [1.0, 2.0]).union(series(spark, [100.0, 200.0], "B"))
    assert sorted(column(T.sma_trend(both), "sma")) == [1.0, 1.5, 100.0, 150.0]


def test_sma_full_needs_n_prices(spark):
    out = T.sma_full(series(spark, [1.0, None, 2.0, 3.0, 4.0]), "close")
    assert column(out, "sma") == [2.0, 3.0]


def test_rsi_edges(spark):
    rising = T.with_studies(series(spark, [float(i) for i in range(17)]), [T.rsi()])
    assert column(rising, "rsi") == [None] * 14 + [100.0] * 3
    still = T.with_studies(series(spark, [5.0] * 16), [T.rsi()])
    assert column(still, "rsi") == [None] * 16
    falling = T.with_studies(series(spark, [float(-i) for i in range(16)]), [T.rsi()])
    assert column(falling, "rsi") == [None] * 14 + [0.0] * 2


@pytest.mark.parametrize("span", [2, 9, 12, 26])
def test_ema_equals_the_recurrence(spark, span):
    prices = [float((i * 7919) % 997) for i in range(2500)]
    out = column(T.with_studies(series(spark, prices), [T.ema(n=span)]), "ema")
    want = pd.Series(prices).ewm(span=span, adjust=False).mean()
    assert max(abs(a - b) for a, b in zip(out, want)) < 1e-9


def test_ema_over_chunks_and_blocks(spark):
    from tickloom.operators.series import Split

    prices = [float((i * 7919) % 997) for i in range(30000)]
    out = column(T.with_studies(series(spark, prices), [T.ema(n=26)], split=Split(rows=12000)), "ema")
    want = pd.Series(prices).ewm(span=26, adjust=False).mean()
    assert len(out) == 30000 and max(abs(a - b) for a, b in zip(out, want)) < 1e-9


def test_bollinger_equals_pandas(spark):
    prices = [float((i * 37) % 101) for i in range(40)]
    out = T.with_studies(series(spark, prices), [T.bollinger()]).orderBy("seq").toPandas()
    rolled = pd.Series(prices).rolling(15)
    pd.testing.assert_series_equal(out.bb_upper, rolled.mean() + 2 * rolled.std(), check_names=False)
    assert out.bb_mid.isna().sum() == 14


def test_several_studies_share_one_shuffle(spark):
    df = T.indicators(series(spark, [1.0, 2.0, 3.0]))
    assert {"rsi", "macd", "macd_signal", "macd_hist", "volume_direction"} <= set(df.columns)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_session_bounds_are_inclusive_in_market_time(spark):
    # New York is UTC-5 in January and UTC-4 in July.
    times = {
        "2024-01-02 14:28:59.999999": False,
        "2024-01-02 14:29:00": True,
        "2024-01-02 21:00:00": True,
        "2024-01-02 21:00:00.000001": False,
        "2024-07-02 13:29:00": True,
        "2024-07-02 20:00:00.000001": False,
        "2024-01-06 15:00:00": False,
    }
    df = spark.createDataFrame([(t,) for t in times], "t string").withColumn("ts", F.to_timestamp("t"))
    inside = {r.t for r in S.market_session(df).collect()}
    assert inside == {t for t, ok in times.items() if ok}
    longer = {r.t for r in S.market_session(df, pre_hours=True, after_hours=True).collect()}
    assert longer == set(times) - {"2024-01-06 15:00:00"}


def test_price_signals_are_strict(spark):
    out = S.price_signals(series(spark, [99.0, 100.0, 200.0, 201.0, None]))
    assert [(r.close, r.signal) for r in out.orderBy("seq").collect()] == [(99.0, "buy"), (201.0, "sell")]


def test_time_range_includes_start_only_and_is_pushed_down(spark, sf_dir):
    df = series(spark, [1.0, 2.0, 3.0])
    out = S.time_range(df, "1 minute", T0 + dt.timedelta(minutes=2))
    assert column(out, "close") == [2.0]
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    plan = S.time_range(events, "1 day", "2024-01-15 00:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-14T00:00)" in plan and "LessThan(ts,2024-01-15T00:00)" in plan


def test_limits(spark):
    df = series(spark, [float(i) for i in range(10)]).union(series(spark, [float(i) for i in range(10)], "B"))
    assert column(S.last_rows(df, 2, "symbol"), "close") == [8.0, 8.0, 9.0, 9.0]
    assert column(S.first_rows(df.where("symbol = 'A'"), 3), "close") == [0.0, 1.0, 2.0]
    plan = S.last_rows(df, 2, "symbol")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rescale(spark):
    assert column(S.rescale(series(spark, [1.0, 2.0]), ["close"]), "close") == [105.0, 110.0]


def test_business_days(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 1, 1),), (dt.datetime(2023, 12, 15),)], "ts timestamp")
    days = [r.day for r in S.business_days(df).orderBy("day").collect()]
    assert len(days) == 250 and days[0] == dt.date(2023, 1, 2)


def test_order_key_sorts_like_the_pair(spark):
    rows = [(T0, 5), (T0, -1), (T0, None), (dt.datetime(1960, 1, 1), 2**62), (T0 + dt.timedelta(microseconds=1), 0)]
    df = spark.createDataFrame(rows, "ts timestamp, seq bigint")
    by_key = [tuple(r) for r in df.orderBy(order_key(F.col("ts"), F.col("seq"))).collect()]
    assert by_key == [tuple(r) for r in df.orderBy("ts", "seq").collect()]


def test_bars_break_ties_by_seq_and_aggregate_by_hashing(spark):
    rows = [("A", T0, 2, 20.0, 1.0), ("A", T0, 1, 10.0, 2.0), ("A", T0, 3, 15.0, 4.0)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, seq bigint, price double, volume double")
    bars = B.ohlcv_bars(df, "1 minute")
    assert tuple(bars.first())[2:] == (10.0, 20.0, 10.0, 15.0, 7.0, 3)
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert B.latest_quote(df).first().price == 15.0


def test_screener_keys():
    assert B.parse_screener_key("$DJI_PERCENT_CHANGE_UP_60") == ("$DJI", "PERCENT_CHANGE_UP", 60)
    assert B.parse_screener_key("EQUITY_ALL_AVERAGE_PERCENT_VOLUME_0") == ("EQUITY_ALL", "AVERAGE_PERCENT_VOLUME", 0)
    assert B.parse_screener_key("OPTION_CALL_TRADES_30") == ("OPTION_CALL", "TRADES", 30)
    for bad in ("NASDAQ_VOLUME_7", "NASDAQ_PRICE_30", "VOLUME_30"):
        with pytest.raises(ValueError):
            B.parse_screener_key(bad)


def test_screener_ranks_per_window(spark):
    rows = [
        (s, T0 + dt.timedelta(minutes=m), i, p, v)
        for i, (s, m, p, v) in enumerate([("A", 0, 10.0, 5.0), ("A", 1, 12.0, 5.0), ("B", 0, 10.0, 10.0), ("B", 2, 9.0, 0.0), ("C", 0, 0.0, 1.0)])
    ]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, seq bigint, price double, volume double")
    ranked = {f: [(r.symbol, r.score) for r in B.screener(df, f"NYSE_{f}_60", 2).orderBy("rank").collect()]
              for f in ("VOLUME", "TRADES", "PERCENT_CHANGE_UP", "PERCENT_CHANGE_DOWN")}
    assert ranked["VOLUME"] == [("A", 10.0), ("B", 10.0)]
    assert ranked["TRADES"] == [("A", 2.0), ("B", 2.0)]
    assert [s for s, _ in ranked["PERCENT_CHANGE_UP"]] == ["A", "B"]
    assert [s for s, _ in ranked["PERCENT_CHANGE_DOWN"]] == ["B", "A"]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 7), (15.0, 7), (1.0, None), (float("nan"), 7)], "x double, c int")
    rows = {(r.column_name, r.bin): r.n for r in P.histogram(df).collect()}
    assert len(rows) == 30
    assert rows["x", 1] == 1 and rows["x", 2] == 1 and rows["x", 15] == 1 and rows["x", 7] == 0
    assert rows["c", 1] == 3 and rows["c", 15] == 0


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, `b.c` string")
    assert [tuple(r) for r in P.table_profile(df).collect()] == [("a", "int", 2, 2), ("b.c", "string", 1, 2)]


def test_long_and_wide_are_inverse(spark):
    bars = spark.createDataFrame([("A", T0, 1.0, 2.0), ("B", T0, 3.0, None)], "symbol string, date timestamp, open double, close double")
    long = P.to_long(bars, ["open", "close"])
    assert long.count() == 4
    wide = P.pivot_fields(long, ["open", "close"]).withColumnRenamed("_time", "date").select(*bars.columns)
    assert sorted(wide.collect()) == sorted(bars.collect())


def test_number_text(spark):
    values = {1.0: "1.0", 1e7: "10000000.0", 123456789.25: "123456789.25", 0.5: "0.5", 1e-5: "0.00001",
              0.0: "0.0", -2.5e8: "-250000000.0", 1e300: "1.0E300", float("nan"): None, None: None}
    df = spark.createDataFrame([(v,) for v in values], "v double").select(number_text(F.col("v")).alias("t"))
    assert [r.t for r in df.collect()] == list(values.values())


def test_line_protocol(spark):
    df = spark.createDataFrame([("A B", 1.0, None, T0), (None, 2.0, 3.0, T0), ("C", None, None, T0)], "s string, x double, y double, t timestamp")
    line = line_protocol("m", {"stock": F.col("s")}, {"x": F.col("x"), "y": F.col("y")}, F.col("t"))
    ms = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert [r[0] for r in df.select(line).collect()] == [f"m,stock=A\\ B x=1.0 {ms}", f"m x=2.0,y=3.0 {ms}", None]


@pytest.mark.parametrize(
    "key, want",
    [
        ("GOOG  240809C00095000", ("option", "GOOG", "2024-08-09", "C", 95.0)),
        ("AAPL  240517P00190500", ("option", "AAPL", "2024-05-17", "P", 190.5)),
        ("/ESF24", ("future", "ES", "2024-01", None, None)),
        ("./OZCZ23C565", ("future_option", "OZC", "2023-12", "C", 565.0)),
        ("EUR/USD", ("forex", "EUR", None, None, None)),
        ("$DJI_PERCENT_CHANGE_UP_60", ("screener", "$DJI", None, None, None)),
        ("OPTION_ALL_AVERAGE_PERCENT_VOLUME_30", ("screener", "OPTION_ALL", None, None, None)),
        ("NVDA", ("ticker", "NVDA", None, None, None)),
    ],
)
def test_instrument_keys(spark, key, want):
    assert tuple(parse_instruments(spark.createDataFrame([(key,)], "symbol string")).first())[1:] == want


def test_bar_csv(spark, tmp_path):
    path = tmp_path / "bars.csv"
    path.write_text("date,open,high,low,close,volume\n2024-01-02,1,2,0.5,1.5,100\n2024-01-03,1.5,2,1,,50\n")
    rows = read_bar_csv(spark, str(path), "NVDA").orderBy("date").collect()
    assert tuple(rows[0]) == ("NVDA", dt.datetime(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 100.0)
    assert rows[1].close is None


def test_kafka_options():
    assert kafka_options("h:9092", "ticks", "earliest", "g", 10) == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "ticks",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "10",
    }
    assert "startingOffsets" not in kafka_options("h:9092", "ticks")


def test_bars_open_and_close_at_the_first_and_last_price(spark):
    rows = [("A", T0, 0, None), ("A", T0, 1, 10.0), ("A", T0, 2, 11.0), ("A", T0, 3, None), ("B", T0, 4, None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "symbol string, ts timestamp, seq bigint, price double, volume double")
    bars = {r.symbol: (r.open, r.close, r.trades) for r in B.ohlcv_bars(df).collect()}
    assert bars == {"A": (10.0, 11.0, 4), "B": (None, None, 1)}
    assert B.latest_quote(df, per_field=True).where("symbol = 'A'").first().price == 11.0
    assert B.latest_quote(df).where("symbol = 'A'").first().price is None


def test_lines_escape_names_and_reject_what_has_no_time(spark):
    from tickloom.sinks.points import lines_rejects, to_lines

    df = spark.createDataFrame([("a\nb", T0, 1.0), ("c", None, 1.0), ("d", T0, None)], "symbol string, date timestamp, p double")
    lines = [r.line for r in to_lines(df, "m m", ["p"], {"my tag": "symbol"}).collect()]
    assert lines == [f"m\\ m,my\\ tag=a\\ b p=1.0 {int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)}"]
    assert sorted(r.reject_reason for r in lines_rejects(df, ["p"]).collect()) == ["no_time", "no_value"]


def test_histogram_leaves_out_what_is_not_finite(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, float("inf"), float("-inf"), float("nan"), None)], "v double")
    bins = {r.bin: r.n for r in P.histogram(df, bins=2).collect()}
    assert bins == {1: 1, 2: 2}
    assert P.not_finite(df).first().n == 3


def test_business_days_from_a_start(spark):
    days = [r.day for r in S.business_days_from(spark, "2024-01-06", 6).orderBy("day").collect()]
    assert days[0] == dt.date(2024, 1, 8) and len(days) == 6 and days[-1] == dt.date(2024, 1, 15)


def test_pivot_conflicts_are_listed(spark):
    rows = [(T0, "A", "open", 1.0), (T0, "A", "open", 2.0), (T0, "A", "close", 3.0), (T0, "B", "open", None)]
    long = spark.createDataFrame(rows, "_time timestamp, symbol string, _field string, _value double")
    assert [(r.symbol, r._field, r.n) for r in P.pivot_conflicts(long).collect()] == [("A", "open", 2)]
    assert P.pivot_fields(long, ["open", "close"]).where("symbol = 'A'").first().open == 2.0
