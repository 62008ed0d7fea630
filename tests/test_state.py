"""State that streams carry: constant, exact, replaced on a repeated batch, and without a trace of scratch data."""

import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from tickloom import session
from tickloom.operators import bars as B
from tickloom.operators import studies as T
from tickloom.operators.series import Split
from tickloom.operators.subscriptions import subscription_state
from tickloom.sinks.tables import write_parquet
from tickloom.streaming.carried import carry_studies
from tickloom.streaming.keyed import keyed_sma
from tickloom.streaming.revised import RevisedStudies
from tickloom.streaming.run import collect_stream
from tickloom.streaming.state import StateLog
from tickloom.streaming.subscriptions import SubscriptionFold
from tickloom.streaming.totals import ClosedWindows, carry_totals

T0 = dt.datetime(2024, 1, 2)
TICKS = "symbol string, ts timestamp, seq bigint, close double"


def ticks(spark, n=300, seed=1, odd=True):
    rng = random.Random(seed)
    rows, at = [], 0.0
    for seq in range(n):
        at += rng.choice([0, 1, 30, 700])
        price = rng.choice([None, math.nan, math.inf, -math.inf]) if odd and rng.random() < 0.15 else round(rng.uniform(1, 99), 2)
        rows.append((rng.choice(["A", "A", "A", "B", None]), T0 + dt.timedelta(seconds=at), seq, price))
    return rows


def batches_of(rows, parts):
    return [rows[len(rows) * i // parts : len(rows) * (i + 1) // parts] for i in range(parts)]


def answers(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def feed(spark, handle, parts, schema=TICKS, twice=(2,)):
    """The batches one after the other, some of them `twice`, as after a failure between write and commit."""
    for i, part in enumerate(parts):
        for _ in range(1 + (i in twice)):
            handle(spark.createDataFrame(part, schema), i)


def scratch(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or session._local_root()
    return set(os.listdir(root)) if os.path.isdir(root) else set()


STUDIES = {
    "exponential": [T.macd(), T.ema(n=5, out="quick")],
    "wilder": [T.rsi(n=5, wilder=True)],
    "mixed": [T.sma("close", 4, full=True), T.rsi(n=5, wilder=True), T.bollinger(n=3)],
}
NAMES = {
    "exponential": ["macd", "macd_signal", "macd_hist", "quick"],
    "wilder": ["rsi"],
    "mixed": ["sma", "rsi", "bb_mid", "bb_upper"],
}


@pytest.mark.parametrize("kind, rows_cut", [("exponential", 1_000_000), ("wilder", 40), ("mixed", 60)])
def test_seeded_studies_equal_the_batch_form(spark, tmp_path, kind, rows_cut):
    rows = ticks(spark, odd=kind != "mixed")
    handle = carry_studies(STUDIES[kind], f"{tmp_path}/tail", write_parquet(f"{tmp_path}/out"), split=Split(rows=rows_cut), full_every=2)
    feed(spark, handle, [*batches_of(rows, 3), []])
    columns = ["symbol", "seq", *[F.round(c, 6).alias(c) for c in NAMES[kind]]]
    want = T.with_studies(spark.createDataFrame(rows, TICKS), STUDIES[kind])
    assert answers(spark.read.parquet(f"{tmp_path}/out"), *columns) == answers(want, *columns)


@pytest.mark.parametrize("studies, width", [([T.macd(), T.rsi(wilder=True)], 1), ([T.sma("close", 4), T.ema()], 3)])
def test_state_is_one_row_a_symbol(spark, tmp_path, studies, width):
    handle = carry_studies(studies, f"{tmp_path}/tail", write_parquet(f"{tmp_path}/out"))
    parts = batches_of(ticks(spark, 200), 3)
    feed(spark, handle, parts, twice=())
    for i, part in enumerate(parts):
        rows = spark.read.parquet(f"{tmp_path}/tail/{i}")
        symbols = {r[0] for r in part}
        assert rows.groupBy("symbol").count().where(F.col("count") > width).isEmpty()
        assert {r["symbol"] for r in rows.select("symbol").distinct().collect()} == symbols


def test_late_ticks_come_after_an_exponential_state(spark, tmp_path):
    rows = [("A", T0 + dt.timedelta(minutes=m), m, float(10 + m % 4)) for m in range(12)]
    handle = carry_studies([T.ema(n=3)], f"{tmp_path}/tail", write_parquet(f"{tmp_path}/out"))
    feed(spark, handle, [rows[6:9], [*rows[0:3], *rows[9:10]], rows[3:6]])
    order = [*rows[6:9], *rows[0:3], *rows[9:10], *rows[3:6]]
    mean, want = None, {}
    for _, _, seq, price in order:
        mean = price if mean is None else 0.5 * price + 0.5 * mean
        want[seq] = round(mean, 9)
    assert {r["seq"]: round(r["ema"], 9) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want


def test_streams_leave_no_scratch_data(spark, tmp_path):
    rows = ticks(spark, 300)
    split = Split(rows=30)
    before, held = scratch(spark), len(session._made)

    def broken(df, batch_id):
        df.count()
        if batch_id == 1:
            raise RuntimeError("a sink that fails")

    totals = F.col("close").cast("decimal(18,2)")
    handles = [
        (10, carry_studies([T.sma()], f"{tmp_path}/a", write_parquet(f"{tmp_path}/oa"), split=Split(rows=20))),
        (2, carry_totals(totals, "total", f"{tmp_path}/b", write_parquet(f"{tmp_path}/ob"), split=split)),
        (2, RevisedStudies([T.sma()], f"{tmp_path}/c", split=split).receive),
        (2, carry_studies([T.ema()], f"{tmp_path}/d", broken, split=split)),
    ]
    finite = [r if r[3] is not None and math.isfinite(r[3]) else (*r[:3], 1.0) for r in rows]
    failed = 0
    for count, handle in handles:
        for i, part in enumerate(batches_of(finite, count)):
            try:
                handle(spark.createDataFrame(part, TICKS), i)
            except RuntimeError:
                failed += 1
    assert failed == 1 and scratch(spark) == before and len(session._made) == held


def test_old_state_folders_are_deleted(spark, tmp_path):
    log = StateLog(f"{tmp_path}/log", "symbol", full_every=3)
    for i in range(8):
        for _ in range(1 + (i % 3 == 0)):
            rows = spark.createDataFrame([("A", i)] if i % 2 else [("B", i), (None, i)], "symbol string, n long")
            log.write(rows, i)
    assert answers(log.before(spark, rows.schema, 8), "symbol", "n") == [("A", 7), ("B", 6), (None, 6)]
    assert sorted(map(int, os.listdir(f"{tmp_path}/log"))) == [6, 7]


@pytest.mark.parametrize("rows_cut", [25, 1_000_000])
def test_totals_go_on_from_the_ledger(spark, tmp_path, rows_cut):
    rows = [r if r[3] is None or math.isfinite(r[3]) else (*r[:3], None) for r in ticks(spark)]
    value = F.col("close").cast("decimal(18,2)")
    handle = carry_totals(value, "total", f"{tmp_path}/carry", write_parquet(f"{tmp_path}/out"), split=Split(rows=rows_cut), full_every=2)
    feed(spark, handle, [*batches_of(rows, 3), []])
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch_id")
    want = T.cumulative_sum(spark.createDataFrame(rows, TICKS), value, "total")
    assert got.schema["total"].dataType == want.schema["total"].dataType
    assert answers(got, "symbol", "seq", "total") == answers(want, "symbol", "seq", "total")


@pytest.mark.parametrize("seed, rows_cut", [(1, 20), (2, 1_000_000)])
def test_late_ticks_revise_results(spark, tmp_path, rows_cut, seed):
    rows = [r if r[3] is None or math.isfinite(r[3]) else (*r[:3], None) for r in ticks(spark, 260, seed)]
    shuffled = random.Random(seed).sample(rows, len(rows))
    studies = [T.sma("close", 4), T.trend("sma"), T.rsi(n=3)]
    revised = RevisedStudies(studies, str(tmp_path), step="10 minutes", split=Split(rows=rows_cut), full_every=2)
    feed(spark, revised.receive, [*batches_of(shuffled, 3), []])
    columns = ["symbol", "seq", "close", "sma", "trend", F.round("rsi", 6).alias("rsi")]
    assert answers(revised.latest(spark), *columns) == answers(T.with_studies(spark.createDataFrame(rows, TICKS), studies), *columns)


def test_only_changed_results_are_written_again(spark, tmp_path):
    rows = [("A", T0 + dt.timedelta(minutes=2 * m), m, float(m)) for m in range(500)]
    revised = RevisedStudies([T.sma()], str(tmp_path), step="10 minutes")
    feed(spark, revised.receive, [rows, [("A", T0 + dt.timedelta(minutes=401), 1000, 5.0)]], twice=())
    assert sorted(r["seq"] for r in spark.read.parquet(f"{tmp_path}/results/batch_id=1").collect()) == [201, 202, 1000]
    with pytest.raises(ValueError):
        RevisedStudies([T.macd()], str(tmp_path))


def test_closed_windows_keep_a_sum_and_count_a_symbol(spark, tmp_path):
    rng = random.Random(4)
    schema = "symbol string, window_start timestamp, volume double, trades bigint, percent_change double"
    rows = [(s, T0 + dt.timedelta(hours=h), rng.choice([None, 0.0, float(rng.randrange(50))]), 1, 0.0) for h in range(12) for s in ("A", "B", "C", None) if rng.random() < 0.8]
    closed, ranks = ClosedWindows(str(tmp_path), full_every=2), []
    handle = closed.receive(lambda df, i: ranks.append(df.count()), k=2)
    feed(spark, handle, [*batches_of(rows, 3), []], schema, twice=())
    got = closed.ranked(spark, 4, k=2).withColumn("score", F.round("score", 6))
    want = B.rank_screener(spark.createDataFrame(rows, schema), "AVERAGE_PERCENT_VOLUME", 2).withColumn("score", F.round("score", 6))
    assert answers(got, "window_start", "rank", "symbol", "score") == answers(want, "window_start", "rank", "symbol", "score")
    assert len(ranks) == 4 and closed.log.before(spark, closed.state, 4).count() <= 4


LOG = "seq bigint, service string, command string, keys array<string>, fields array<string>"


def commands(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        command = rng.choices(["ADD", "subs", "UNSUBS", "VIEW", "CLEAR", "LOGIN"], [8, 1, 3, 2, 0.4, 1])[0]
        keys = rng.sample("abcd", rng.randrange(1, 3)) if command != "VIEW" or rng.random() < 0.5 else None
        fields = rng.sample("123456", rng.randrange(0, 4)) if command != "UNSUBS" else None
        rows.append((seq, rng.choice(["S", "t", "T"]), command, keys, fields))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_folded_stream_equals_the_fold_of_the_log(spark, tmp_path, seed):
    rows, changed = commands(seed), {}
    fold = SubscriptionFold(str(tmp_path), full_every=2)

    def take(df, batch_id):
        for r in df.collect():
            changed.setdefault((batch_id, r["service"]), {})[r["key"]] = r["fields"]

    feed(spark, fold.receive(take), batches_of(rows, 4), LOG)
    log = spark.createDataFrame(rows, LOG)
    assert answers(fold.state(spark, 4), "service", "key", "fields") == answers(subscription_state(log), "service", "key", "fields")
    last = {}
    for (_, service), state in sorted(changed.items()):
        last[service] = {k: f for k, f in state.items() if k is not None}
    want = {}
    for r in fold.state(spark, 4).collect():
        want.setdefault(r["service"], {})[r["key"]] = r["fields"]
    assert {s: keys for s, keys in last.items() if keys} == want


def test_keyed_average_refuses_what_does_not_fit(spark, tmp_path, monkeypatch):
    from tickloom.streaming import keyed

    rows = [("A", T0 + dt.timedelta(seconds=(7 * i) % 50), i, float(i)) for i in range(50)]
    spark.createDataFrame(rows, "symbol string, ts timestamp, seq bigint, price double").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("symbol string, ts timestamp, seq bigint, price double").parquet(f"{tmp_path}/in")
    monkeypatch.setattr(keyed, "OUT_ROWS", 7)
    got = collect_stream(spark, keyed_sma(stream), "keyed_test")
    ordered = sorted(rows, key=lambda r: (r[1], r[2]))
    want = {r[2]: sum(x[3] for x in ordered[i - 2 : i + 1]) / 3 for i, r in enumerate(ordered) if i >= 2}
    assert {r["seq"]: r["sma"] for r in got.collect()} == want
    with pytest.raises(Exception, match="limit the trigger"):
        collect_stream(spark, keyed_sma(stream, most_rows=40), "keyed_test")
