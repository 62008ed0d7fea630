"""Streams give the batch answer, however the input is cut, also after a restart."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickloom.operators import bars as B
from tickloom.operators import ingest as I
from tickloom.operators import studies as T
from tickloom.plans import adapters as A
from tickloom.session import scratch_dir
from tickloom.sinks.points import send_lines, write_lines
from tickloom.sinks.tables import append_missing, show_stream, write_parquet
from tickloom.sources.files import stream_parquet, stream_text
from tickloom.streaming.keyed import keyed_sma, sma_text
from tickloom.streaming.run import collect_stream, delivery_report, start_batches, write_available
from tickloom.streaming.windows import latest_quote_stream, ohlcv_bars_stream, rank_closed, screener_metrics_stream


@pytest.fixture(scope="module")
def ticks(spark):
    return A.ticks(spark, "/root/testdata/sf0.001").cache()


def feed(ticks, path, parts):
    """Write ticks as `parts` files, in time order, the oldest file first."""
    rows, known = ticks.count(), set()
    for i in range(parts):
        lo, hi = rows * i // parts, rows * (i + 1) // parts
        part = ticks.where((F.col("seq") >= lo) & (F.col("seq") < hi)).coalesce(1)
        part.write.mode("append").parquet(path)
        new = {e.path for e in os.scandir(path) if e.name.endswith(".parquet")} - known
        for file in new:
            os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
        known |= new


def source(spark, ticks, path):
    return stream_parquet(spark, path, ticks.schema)


def answers(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_keyed_sma_equals_batch(spark, ticks, tmp_path, parts):
    src = str(tmp_path / "in")
    feed(ticks, src, parts)
    query = write_available(keyed_sma(source(spark, ticks, src)), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert answers(got, "symbol", "seq", "sma") == answers(T.sma_full(ticks), "symbol", "seq", "sma")
    assert delivery_report(query)["rows"] == ticks.count()
    text = sma_text(got).orderBy("seq").first().message
    assert text.startswith("Stock: ") and ", SMA: " in text


def test_keyed_sma_restart_neither_loses_nor_repeats(spark, ticks, tmp_path):
    src, out, cp = (str(tmp_path / d) for d in ("in", "out", "cp"))
    half = ticks.count() // 2
    feed(ticks.where(F.col("seq") < half), src, 1)
    write_available(keyed_sma(source(spark, ticks, src)), out, cp)
    ticks.where(F.col("seq") >= half).coalesce(1).write.mode("append").parquet(src)
    write_available(keyed_sma(source(spark, ticks, src)), out, cp)
    got = spark.read.parquet(out)
    assert answers(got, "symbol", "seq", "sma") == answers(T.sma_full(ticks), "symbol", "seq", "sma")


def closed(bars, ticks, minutes=60):
    end = ticks.agg(F.max("ts")).first()[0] - dt.timedelta(minutes=10)
    return bars.where(F.col("date") + F.expr(f"interval {minutes} minutes") <= F.lit(end).cast("timestamp_ntz"))


@pytest.mark.parametrize("parts", [1, 3])
def test_closed_bars_equal_batch(spark, ticks, tmp_path, parts):
    src = str(tmp_path / "in")
    feed(ticks, src, parts)
    write_available(ohlcv_bars_stream(source(spark, ticks, src)), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out")).withColumn("date", F.col("date").cast("timestamp_ntz"))
    columns = ("symbol", "date", "open", "high", "low", "close", "volume", "trades")
    assert answers(got, *columns) == answers(closed(B.ohlcv_bars(ticks), ticks), *columns)


def test_screener_ranks_closed_windows(spark, ticks, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(ticks, src, 3)
    metrics = screener_metrics_stream(source(spark, ticks, src), 60)
    receiver = rank_closed("VOLUME", 2, write_parquet(out))
    start_batches(metrics, receiver, str(tmp_path / "cp"), trigger={"availableNow": True}).awaitTermination()
    got = spark.read.parquet(out).withColumn("date", F.col("window_start").cast("timestamp_ntz"))
    want = B.screener(ticks, "ALL_VOLUME_60", 2).withColumnRenamed("window_start", "date")
    columns = ("date", "rank", "symbol", "score")
    assert answers(got, *columns) == answers(closed(want, ticks), *columns)
    with pytest.raises(ValueError):
        rank_closed("AVERAGE_PERCENT_VOLUME", 2, write_parquet(out))


def test_latest_quote_updates(spark, ticks, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    feed(ticks, src, 3)
    stream = latest_quote_stream(source(spark, ticks, src))
    query = start_batches(stream, write_parquet(out), str(tmp_path / "cp"), mode="update", trigger={"availableNow": True})
    query.awaitTermination()
    last = B.latest_quote(spark.read.parquet(out).drop("batch_id"))
    assert answers(last, "symbol", "seq", "price") == answers(B.latest_quote(ticks), "symbol", "seq", "price")


def test_messages_to_ticks_as_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    sent = A.envelopes(spark, "/root/testdata/sf0.001")
    sent.coalesce(1).write.text(src)
    write_available(I.flatten_ticks(stream_text(spark, src)), str(tmp_path / "out"), str(tmp_path / "cp"))
    want = I.flatten_ticks(sent)
    got = spark.read.schema(want.schema).parquet(str(tmp_path / "out"))
    assert answers(got, "symbol", "date", "close", "volume") == answers(want, "symbol", "date", "close", "volume")


def test_receiver_gets_arguments_and_no_empty_batches(spark, ticks, tmp_path):
    src = str(tmp_path / "in")
    feed(ticks, src, 2)
    calls = []

    def receiver(batch, batch_id, label, extra=None):
        calls.append((batch_id, batch.count(), label, extra))

    nothing = source(spark, ticks, src).where("symbol = 'no such symbol'")
    some = source(spark, ticks, src)
    for name, df in (("none", nothing), ("some", some)):
        start_batches(df, receiver, str(tmp_path / name), name, extra=1, trigger={"availableNow": True}).awaitTermination()
    half = ticks.count() // 2
    assert calls == [(0, half, "some", 1), (1, half, "some", 1)]


def bars_of(spark):
    return A.bars(spark, "/root/testdata/sf0.001")


def test_repeated_batch_replaces_its_lines(spark, tmp_path):
    write = write_lines(str(tmp_path / "lines"), "bars")
    bars = bars_of(spark)
    write(bars, 0)
    write(bars, 0)
    write(bars.limit(3), 1)
    assert spark.read.text(str(tmp_path / "lines")).count() == bars.count() + 3


def test_lines_are_sent_by_tasks(spark, tmp_path):
    folder = str(tmp_path / "sent")
    os.makedirs(folder)

    def send(lines):
        import uuid

        with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(lines) + "\n")

    send_lines(send, "bars", lines_per_call=50)(bars_of(spark), 0)
    assert spark.read.text(folder).count() == bars_of(spark).count()


def test_append_adds_only_what_is_missing(spark, tmp_path):
    """A batch that failed half way is completed; a batch that was whole adds nothing."""
    table = str(tmp_path / "table")
    bars = bars_of(spark)
    partial = bars.where("symbol = 'click'").withColumns({"row_no": F.lit(1), "batch_id": F.lit(0).cast("bigint")})
    partial.write.parquet(table)
    # Rows of other batches with the same keys do not count as present.
    partial.withColumn("batch_id", F.lit(7).cast("bigint")).write.mode("append").parquet(table)

    def read_batch(batch, batch_id):
        return batch.sparkSession.read.parquet(table).where(F.col("batch_id") == batch_id)

    write = append_missing(read_batch, lambda rows: rows.write.mode("append").parquet(table), ["symbol", "date"])
    for _ in range(2):
        write(bars, 0)
    stored = spark.read.parquet(table).where("batch_id = 0")
    assert answers(stored, "symbol", "date", "close") == answers(bars, "symbol", "date", "close")


def test_console(spark, ticks, tmp_path, capfd):
    src = str(tmp_path / "in")
    feed(ticks.limit(3), src, 1)
    query = show_stream(source(spark, ticks, src), str(tmp_path / "cp"))
    query.processAllAvailable()
    query.stop()


class Session:
    """Only what `scratch_dir` asks of a session."""

    def __init__(self, master, folder):
        self.sparkContext = type("Context", (), {"master": master})
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder)})


def test_scratch_folder_comes_from_the_session(tmp_path):
    on_cluster = scratch_dir(Session("yarn", str(tmp_path)), "x")
    assert on_cluster.startswith(str(tmp_path)) and on_cluster != scratch_dir(Session("yarn", str(tmp_path)), "x")
    assert scratch_dir(Session("local[2]", None), "x")
    with pytest.raises(ValueError):
        scratch_dir(Session("yarn", None), "x")


def test_store_is_read_by_day(spark, ticks, tmp_path):
    from tickloom.operators.select import time_range
    from tickloom.sinks.store import write_store, write_store_batches

    path = str(tmp_path / "store")
    write_store(ticks, path)
    recent = time_range(spark.read.parquet(path), "1 day", "2024-01-15 12:00:00", day="day")
    want = time_range(ticks, "1 day", "2024-01-15 12:00:00")
    assert answers(recent, "symbol", "seq") == answers(want, "symbol", "seq")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]

    batches = str(tmp_path / "batches")
    write = write_store_batches(batches)
    write(ticks, 0)
    write(ticks, 0)
    assert spark.read.parquet(batches).count() == ticks.count()


STUDIES = [T.sma(), T.trend(), T.rsi(), T.macd(), T.bollinger()]


@pytest.mark.parametrize("parts", [1, 3])
def test_carried_studies_equal_batch(spark, ticks, tmp_path, parts):
    from tickloom.operators.series import Split
    from tickloom.streaming.carried import carry_studies

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = ticks.select("symbol", "ts", "seq", "close").cache()
    feed(rows, src, parts)
    receiver = carry_studies(STUDIES, str(tmp_path / "tail"), write_parquet(out), split=Split(rows=40), full_every=2)

    def twice(batch, batch_id):
        receiver(batch, batch_id)
        if batch_id % 2:  # as after a failure between the write and the commit of the batch
            receiver(batch, batch_id)

    start_batches(
        source(spark, rows, src), twice, str(tmp_path / "cp"), trigger={"availableNow": True}, skip_empty=False
    ).awaitTermination()
    names = ["sma", "rsi", "macd", "macd_signal", "bb_upper"]
    rounded = ["symbol", "seq", "trend", *[F.round(n, 6).alias(n) for n in names]]
    assert answers(spark.read.parquet(out), *rounded) == answers(T.with_studies(rows, STUDIES), *rounded)


def test_append_keeps_rows_of_equal_keys_and_matches_nulls(spark, tmp_path):
    """Two ticks of one symbol and time are two rows, also when a batch that failed half way is repeated."""
    table = str(tmp_path / "table")
    schema = "symbol string, seq long, price double"
    rows = spark.createDataFrame([("A", None, 1.0), ("A", 1, 2.0), (None, None, 3.0), ("A", 1, 2.0), ("A", 1, 5.0), ("A", 1, None)], schema)
    kept = []

    def read_batch(batch, batch_id):
        return spark.read.parquet(table).where(F.col("batch_id") == batch_id)

    def append(df):
        kept.append(df.count())
        df.write.mode("append").parquet(table)

    rows.limit(0).withColumns({"row_no": F.lit(1), "batch_id": F.lit(0).cast("bigint")}).write.parquet(table)
    write = append_missing(read_batch, lambda df: append(df.where("price = 2.0 or symbol is null")), ["symbol", "seq"])
    write(rows, 0)  # some tasks were done before the batch failed
    write = append_missing(read_batch, append, ["symbol", "seq"])
    for _ in range(2):
        write(rows, 0)
    assert kept == [3, 3, 0]
    assert sorted(r["price"] or 0.0 for r in spark.read.parquet(table).collect()) == [0.0, 1.0, 2.0, 2.0, 3.0, 5.0]


def test_all_batches_are_counted(spark, ticks, tmp_path):
    import time

    from tickloom.streaming.run import DeliveryCount

    src = str(tmp_path / "in")
    feed(ticks, src, 3)
    count = DeliveryCount()
    spark.streams.addListener(count)
    try:
        write_available(source(spark, ticks, src), str(tmp_path / "out"), str(tmp_path / "cp"))
        for _ in range(50):
            if count.rows == ticks.count():
                break
            time.sleep(0.2)
        assert count.rows == ticks.count() and count.batches >= 3
    finally:
        spark.streams.removeListener(count)


def test_tails_of_symbols_that_a_batch_lacks_are_kept(spark, tmp_path):
    from tickloom.streaming.carried import carry_studies

    schema = "symbol string, ts timestamp, seq bigint, close double"
    base = dt.datetime(2024, 1, 1)
    turns = [("A", "B"), ("B",), ("B", None), ("B",), ("A", None)]
    rows = [(s, base + dt.timedelta(minutes=i), 10 * i + j, float(i + j)) for i, turn in enumerate(turns) for j, s in enumerate(turn)]
    handle = carry_studies([T.diff("close", "change")], str(tmp_path / "tail"), write_parquet(str(tmp_path / "out")), full_every=3)
    written = []
    for i in range(len(turns)):
        handle(spark.createDataFrame([r for r in rows if r[2] // 10 == i], schema), i)
        written.append(spark.read.parquet(str(tmp_path / "tail" / str(i))).count())
    got = spark.read.parquet(str(tmp_path / "out"))
    want = T.with_studies(spark.createDataFrame(rows, schema), [T.diff("close", "change")])
    key = lambda r: str(r)
    assert sorted(map(tuple, got.select("symbol", "seq", "change").collect()), key=key) == sorted(
        map(tuple, want.select("symbol", "seq", "change").collect()), key=key
    )
    assert written == [2, 1, 2, 3, 2]


def test_tick_stream_of_more_files_with_null_ids(spark, monkeypatch, tmp_path):
    rows = [(k if k % 50 else None, f"a{k % 3}", float(k), '{"k": 1}') for k in range(1, 301)]
    events = spark.createDataFrame(rows, "event_id bigint, event_type string, value double, props string")
    events.selectExpr(
        "event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "1L AS user_id", "event_type", "value", "props"
    ).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(A, "FILE_ROWS", 50)
    seen = []

    def receive(batch, batch_id):
        seen.append(sorted((r["seq"] or 0, r["price"]) for r in batch.collect()))

    stream = A.tick_stream(spark, str(tmp_path)).select("seq", "price")
    start_batches(stream, receive, str(tmp_path / "cp"), trigger={"availableNow": True}).awaitTermination()
    assert len(seen) >= 6 and sorted(p for part in seen for _, p in part) == [float(k) for k in range(1, 301)]
    assert all(a[-1][0] <= b[0][0] for a, b in zip(seen, seen[1:]))


def test_a_micro_batch_takes_as_many_files_as_its_rows_need(spark, monkeypatch, ticks):
    monkeypatch.setattr(A, "PART_ROWS", 100)
    tasks, prices = [], []

    def receive(batch, batch_id):
        tasks.append(batch.rdd.getNumPartitions())
        prices.extend(r["seq"] for r in batch.collect())

    stream = A.file_stream(spark, ticks, "seq")
    start_batches(stream, receive, scratch_dir(spark, "cp"), trigger={"availableNow": True}).awaitTermination()
    assert len(tasks) >= A.STREAM_FILES and min(tasks[: A.STREAM_FILES]) > 1
    assert sorted(prices) == sorted(r["seq"] for r in ticks.select("seq").collect())


def test_lines_are_made_once(spark):
    from tickloom.sinks.points import to_lines

    rows = spark.createDataFrame([("A", 1.5, None), ("A", 1.5, 0), ("A", None, 0), ("A", float("nan"), 0)], "symbol string, price double, at int")
    made = to_lines(rows.withColumn("ts", F.timestamp_seconds("at")), "t", ["price"], time="ts")
    assert [r.line for r in made.collect()] == ["t,stock=A price=1.5 0"]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" not in "".join(part for part in plan.split("\n") if "Filter" in part)


def test_updates_are_aggregated_once(spark, monkeypatch, ticks, tmp_path):
    from pyspark.sql.classic.dataframe import DataFrame as Classic
    from tickloom.streaming.run import latest_of_updates

    src = str(tmp_path / "in")
    feed(ticks, src, 2)
    monkeypatch.setattr(Classic, "isEmpty", lambda batch: pytest.fail("runs the aggregate once more"))
    got = latest_of_updates(spark, ohlcv_bars_stream(source(spark, ticks, src)), ["symbol", "date"], "updates", 2)
    columns = ("symbol", "open", "high", "low", "close", "volume", "trades")
    assert answers(got, *columns) == answers(B.ohlcv_bars(ticks), *columns)


def test_carried_rows_are_written_by_a_task_per_core(spark, tmp_path, ticks):
    from tickloom.streaming.carried import carry_studies

    partitions = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        write = lambda rows, batch_id: partitions.append(rows.rdd.getNumPartitions())
        carry_studies([T.macd()], str(tmp_path / "tail"), write)(ticks.select("symbol", "ts", "seq", "close"), 0)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert partitions[0] <= spark.sparkContext.defaultParallelism


def test_keys_are_moved_once(spark):
    from tickloom.streaming.state import of_keys

    rows, others = (spark.createDataFrame([(k,) for k in ks], "symbol string") for ks in (["A", "B", None], ["A", "A", None]))
    for how, want in (("left_semi", ["A", None]), ("left_anti", ["B"])):
        found = of_keys(rows, others, ["symbol"], how)
        assert sorted((r.symbol for r in found.collect()), key=str) == sorted(want, key=str)
        assert "Aggregate" in found._jdf.queryExecution().optimizedPlan().toString()
