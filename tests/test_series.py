"""Cut series give the same windows as whole series, whatever the skew."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators import studies as T
from tickloom.operators.series import CHUNK, HALO, Split, drop_halo, split_series
from tickloom.plans import adapters as A

SCHEMA = "symbol string, ts timestamp, seq bigint, close double"
DAY = dt.datetime(2024, 1, 2)


def rows_like(kind, n=3000):
    rng = random.Random(kind)
    rows = []
    for i in range(n):
        ts = DAY + dt.timedelta(seconds=rng.randrange(86400))
        symbol = "HOT" if rng.random() < 0.7 else rng.choice(["A", "B", None])
        if kind == "stray_date" and i == 0:
            symbol, ts = "HOT", dt.datetime(1970, 1, 1)
        if kind == "null_time" and rng.random() < 0.5:
            ts = None
        if kind == "one_time" and rng.random() < 0.6:
            ts = dt.datetime(1970, 1, 1)
        if kind == "burst" and rng.random() < 0.9:
            ts = DAY + dt.timedelta(milliseconds=rng.randrange(300_000))
        rows.append((symbol, ts, i, float(rng.randrange(1, 500))))
    return rows


def hot_chunk_sizes(cut):
    own = cut.where(~F.col(HALO)).where("symbol = 'HOT'").groupBy(CHUNK).count()
    return [r["count"] for r in own.collect()]


@pytest.mark.parametrize("kind", ["even", "stray_date", "null_time", "one_time", "burst"])
def test_cut_windows_equal_whole_windows(spark, kind):
    df = spark.createDataFrame(rows_like(kind), SCHEMA)
    split = Split(rows=100)
    cut = split_series(df, look_back=7, split=split)
    assert drop_halo(cut).count() == 3000
    sizes = hot_chunk_sizes(cut)
    assert len(sizes) > 10 and max(sizes) <= 300

    whole = Window.partitionBy("symbol").orderBy("ts", "seq")
    want = df.withColumn("sma", F.avg("close").over(whole.rowsBetween(-7, 0))).withColumn("p", F.lag("close").over(whole))
    got = T.with_studies(df, [T.sma(n=8)], split=split)
    assert got.select("symbol", "seq", "sma").exceptAll(want.select("symbol", "seq", "sma")).count() == 0
    assert got.count() == 3000


def test_halo_reaches_over_several_chunks(spark):
    df = spark.createDataFrame(rows_like("even", 500), SCHEMA)
    split = Split(rows=10)
    whole = Window.partitionBy("symbol").orderBy("ts", "seq").rowsBetween(-59, 0)
    want = df.select("seq", F.avg("close").over(whole).alias("sma"))
    got = T.with_studies(df, [T.sma(n=60)], split=split).select("seq", "sma")
    assert got.exceptAll(want).count() == 0 and got.count() == 500


def test_pieces_are_bounded_by_the_settings(spark):
    df = spark.createDataFrame(rows_like("even"), SCHEMA)
    sizes = hot_chunk_sizes(split_series(df, split=Split(rows=1, max_chunks=10)))
    assert len(sizes) <= 20


def test_cumulative_sum_carries_over_chunks(spark):
    df = spark.createDataFrame(rows_like("burst"), SCHEMA)
    value = F.col("close").cast("decimal(18,2)")
    whole = Window.partitionBy("symbol").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("seq", F.sum(value).over(whole).alias("total"))
    got = T.cumulative_sum(df, value, "total", split=Split(rows=50)).select("seq", "total")
    assert {(r.seq, r.total) for r in got.collect()} == {(r.seq, r.total) for r in want.collect()}


@pytest.mark.parametrize("name, exchanges", [("sma_trend", 1), ("sma_trend_split", 1)])
def test_one_shuffle_of_the_data(spark, sf_dir, name, exchanges):
    from tickloom.plans.queries import QUERIES

    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    # The passes that count rows shuffle a symbol's counts, never the price.
    of_data = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    if name.endswith("_split"):
        of_data = [line for line in of_data if CHUNK in line]
    assert len(of_data) == exchanges


def recurrence(values, alpha):
    mean, out = None, []
    for v in values:
        if v is not None:
            mean = v if mean is None else alpha * v + (1 - alpha) * mean
        out.append(mean)
    return out


@pytest.mark.parametrize("rows", [1_000_000, 400, 23])
def test_exponential_means_over_flat_stretches_and_nulls(spark, rows):
    """Long after the last change a mean of changes is tiny, and its ratio must still be right."""
    rng = random.Random(rows)
    prices = [rng.uniform(50, 150) if i < 60 or i > 1500 else 80.0 for i in range(2000)]
    df = spark.createDataFrame([("A", DAY + dt.timedelta(seconds=i), i, p) for i, p in enumerate(prices)], SCHEMA)
    got = [r.rsi for r in T.indicators(df, [T.rsi(wilder=True)], split=Split(rows=rows)).orderBy("seq").collect()]
    moves = [None] + [b - a for a, b in zip(prices, prices[1:])]
    gain, loss = (recurrence([None if m is None else max(s * m, 0.0) for m in moves], 1 / 14) for s in (1, -1))
    for i in range(14, 2000):
        assert abs(got[i] - (100 - 100 / (1 + gain[i] / loss[i]))) < 1e-9

    gaps = [None if i < 5 or i % 7 == 0 or 300 < i < 380 else p for i, p in enumerate(prices)]
    df = spark.createDataFrame([("A", DAY + dt.timedelta(seconds=i), i, p) for i, p in enumerate(gaps)], SCHEMA)
    out = T.with_studies(df, [T.ema(n=12), T.sma("ema", 3, "smooth")], split=Split(rows=rows)).orderBy("seq").collect()
    want = recurrence(gaps, 2 / 13)
    for r, w in zip(out, want):
        assert (r.ema is None) == (w is None) and (w is None or abs(r.ema - w) < 1e-9)
    assert abs(out[-1].smooth - sum(want[-3:]) / 3) < 1e-9


def test_cumulative_sum_is_the_same_cut_and_uncut(spark):
    rows = [("A", DAY + dt.timedelta(seconds=i), i, None if i % 5 == 0 or i < 3 else 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    value = F.col("close").cast("decimal(18,2)")
    whole, cut = (T.cumulative_sum(df, value, "total", split=s) for s in (Split(), Split(rows=5)))
    assert whole.schema == cut.schema
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))
    assert whole.orderBy("seq").first().total is None


def test_equal_times_are_cut_along_a_text_tie_breaker(spark):
    df = spark.range(4000).selectExpr(
        "'HOT' AS symbol", "TIMESTAMP '2024-01-02' AS ts", "lpad(CAST(id AS STRING), 6, '0') AS seq", "CAST(id AS DOUBLE) AS close"
    )
    cut = split_series(df, look_back=1, split=Split(rows=400))
    assert max(hot_chunk_sizes(cut)) <= 1200
    whole = Window.partitionBy("symbol").orderBy("ts", "seq")
    want = df.select("seq", (F.col("close") - F.lag("close").over(whole)).alias("change"))
    got = T.with_studies(df, [T.diff("close", "change")], split=Split(rows=400)).select("seq", "change")
    assert got.exceptAll(want).count() == 0 and got.count() == 4000


@pytest.mark.parametrize("n", [1000, 1024])
def test_last_rows_are_ranked_before_a_key_is_gathered(spark, n):
    from tickloom.operators import select as S

    df = spark.createDataFrame(rows_like("even", 5000), SCHEMA)
    out = S.last_rows(df, n, "symbol")
    want = [r.seq for r in df.where("symbol = 'HOT'").orderBy(F.desc("ts"), F.desc("seq")).limit(n).collect()]
    assert sorted(r.seq for r in out.where("symbol = 'HOT'").collect()) == sorted(want)
    plan = S.last_rows(df, n, "symbol")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan if n <= 1000 else "_slice" in plan


@pytest.mark.parametrize("kind, passes", [("even", 3), ("burst", 4)])
def test_the_input_is_read_few_times(spark, tmp_path, kind, passes):
    """Two counting passes, or three where a slice is too large, and the data itself."""
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows_like(kind), SCHEMA).coalesce(1).write.parquet(path)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.read.parquet(path).mapInPandas(seen, SCHEMA)
    out = T.with_studies(df, [T.sma(), T.trend()], split=Split(rows=100))
    assert out.count() == 3000
    assert read.value == passes * 3000


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 100])
def test_flat_ticks_are_the_second_third_and_no_window_holds_a_symbol(spark, tmp_path, count):
    rows = [(k, k * 37 % 41 if k % 9 else None, "ab"[k % 2] if k % 7 else None, float(k)) for k in range(count)]
    events = spark.createDataFrame(rows, "event_id bigint, s int, event_type string, value double").selectExpr(
        "event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, s * 20) AS ts", "1L AS user_id",
        "event_type", "value", "'{\"k\": 1}' AS props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    third = F.ntile(3).over(Window.partitionBy("symbol").orderBy("ts", "seq"))
    want = A.ticks(spark, str(tmp_path)).select("symbol", "ts", "seq", F.when(third == 2, 50.0).otherwise(F.col("close")))
    got = A.flat_ticks(spark, str(tmp_path))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.toDF(*got.columns).collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "ntile" not in plan and "row_number()" in plan
