"""Sliding bars, sessions, subscriptions in force, compaction, one-parse splits: against direct versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.functions.columns import line_protocol
from tickloom.operators import bars as B
from tickloom.operators import ingest as I
from tickloom.operators import studies as T
from tickloom.operators.select import GROUP_LIMIT, last_rows
from tickloom.operators.series import Split
from tickloom.operators.sessions import tick_sessions
from tickloom.operators.subscriptions import subscribed_as_of, subscription_state
from tickloom.plans import adapters as A
from tickloom.sinks.compaction import CompactedStore
from tickloom.sinks.outcomes import split_feed, split_feed_batches
from tickloom.sinks.points import lines_rejects, to_lines

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(1969, 12, 31, 20)
SCHEMA = "symbol string, ts timestamp, seq bigint, price double, volume double"


def random_ticks(seed, n=250):
    rng = random.Random(seed)
    rows, at = [], 0
    for seq in range(n):
        at += rng.choice([0, 0, 1, 20, 20, 59, 60, 400, 4000])
        time = T0 + dt.timedelta(seconds=at) if rng.random() > 0.02 else None
        rows.append((rng.choice(["A", "A", "B", None]), time, seq, rng.choice([None, float(rng.randrange(9))]), float(rng.randrange(5))))
    return rows


def answers(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def bar(rows):
    priced = sorted((r for r in rows if r[3] is not None), key=lambda r: (r[1], r[2]))
    prices = [r[3] for r in priced]
    ends = (prices[0], max(prices), min(prices), prices[-1]) if prices else (None,) * 4
    return (*ends, sum(r[4] for r in rows), len(rows))


@pytest.mark.parametrize("width, step", [(60, 20), (300, 60), (60, 60), (7, 1)])
def test_sliding_bars_equal_all_windows(spark, width, step):
    rows = random_ticks(width)
    windows = {}
    for r in rows:
        if r[1] is not None:
            second = int((r[1] - dt.datetime(1970, 1, 1)).total_seconds())
            first = second // step * step
            for start in range(first - width + step, first + 1, step):
                windows.setdefault((r[0], dt.datetime(1970, 1, 1) + dt.timedelta(seconds=start)), []).append(r)
    want = sorted(((*key, *bar(held)) for key, held in windows.items()), key=str)
    assert answers(B.ohlcv_bars_sliding(spark.createDataFrame(rows, SCHEMA), f"{width} seconds", f"{step} seconds")) == want


def test_sliding_bars_make_two_rows_a_window_at_most(spark):
    df = spark.createDataFrame([("A", T0 + dt.timedelta(seconds=i), i, 1.0, 1.0) for i in range(2000)], SCHEMA)
    wide = B.ohlcv_bars_sliding(df, "1000 seconds", "1 second")
    assert wide.count() == 2999
    plan = wide._jdf.queryExecution().executedPlan()
    rows = []

    def visit(node):
        if node.nodeName() == "Generate":
            rows.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            visit(node.children().apply(i))

    wide.collect()
    plan = wide._jdf.queryExecution().executedPlan()
    visit(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
    assert sum(rows) <= 2 * 2999
    for width, step in (("90 seconds", "60 seconds"), ("1 month", "1 day"), ("0 seconds", "0 seconds")):
        with pytest.raises(ValueError):
            B.ohlcv_bars_sliding(df, width, step)


def sessions(rows, gap):
    found = {}
    for r in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[2])):
        own = found.setdefault(r[0], [])
        if not own or (r[1] - own[-1][-1][1]).total_seconds() >= gap:
            own.append([])
        own[-1].append(r)
    return sorted(((s, p[0][1], p[-1][1], len(p), bar(p)[0], bar(p)[3], sum(r[4] for r in p)) for s, parts in found.items() for p in parts), key=str)


@pytest.mark.parametrize("split", [Split(), Split(rows=10), Split(rows=3), Split(rows=1)])
@pytest.mark.parametrize("gap", [1, 60, 100_000])
def test_sessions_equal_a_walk(spark, split, gap):
    rows = random_ticks(gap)
    assert answers(tick_sessions(spark.createDataFrame(rows, SCHEMA), f"{gap} seconds", split=split)) == sessions(rows, gap)


def test_sessions_of_nothing(spark):
    assert tick_sessions(spark.createDataFrame([], SCHEMA)).collect() == []
    assert B.ohlcv_bars_sliding(spark.createDataFrame([], SCHEMA)).collect() == []


CONTENT = "service string, timestamp bigint, content struct<key:string, `1`:double, `2`:double, `3`:double, `4`:int, `5`:int, `8`:bigint, `10`:double, `11`:double, `12`:double, `17`:double>"


@pytest.mark.parametrize("seed", range(4))
def test_items_meet_the_subscriptions_of_their_time(spark, seed):
    rng = random.Random(seed)
    log, at = [], 0
    for seq in range(90):
        at += rng.choice([0, 1, 500, 90_000])
        command = rng.choices(["ADD", "SUBS", "UNSUBS", "VIEW", "CLEAR"], [8, 1, 3, 3, 0.6])[0]
        keys = rng.sample("ab", rng.randrange(1, 3))
        fields = rng.sample(["3", "8", "12"], rng.randrange(0, 3)) if command != "UNSUBS" else None
        log.append((seq, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=at), rng.choice("ST"), command, keys, fields))
    schema = "seq bigint, ts timestamp_ntz, service string, command string, keys array<string>, fields array<string>"
    items = [
        (rng.choice("STU"), int((dt.datetime(2024, 1, 1) - dt.datetime(1970, 1, 1)).total_seconds() + t) * 1000, (rng.choice("abc"), None, None, 3.0, None, None, 8, None, None, 12.0, None))
        for t in [rng.randrange(-1000, at + 1000) for _ in range(40)] + [int((r[1] - dt.datetime(2024, 1, 1)).total_seconds()) for r in log[::5]]
    ]
    want = []
    for service, time, content in items:
        until = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=time)
        live = {}
        for _, ts, s, command, keys, fields in log:  # a replay, command by command
            if ts > until:
                break
            if command == "CLEAR":
                live = {}
            elif s != service:
                continue
            elif command == "VIEW":
                live = {k: set(fields) for k in live}
            elif command == "UNSUBS":
                live = {k: f for k, f in live.items() if k not in keys}
            else:
                live = {} if command == "SUBS" else live
                for k in keys:
                    live[k] = live.get(k, set()) | set(fields)
        if content[0] in live:
            has = live[content[0]]
            want.append((service, content[0], until, 3.0 if "3" in has else None, 8 if "8" in has else None, 12.0 if "12" in has else None))
    for days in (1, 30):
        got = subscribed_as_of(spark.createDataFrame(items, CONTENT), spark.createDataFrame(log, schema), days=days)
        assert answers(got, "service", "symbol", F.col("date").cast("timestamp_ntz").alias("date"), "lastPrice", "volume", "close") == sorted(want, key=str)
    assert subscription_state(spark.createDataFrame(log, schema)).count() >= 0


def store_of(spark, tmp_path, batches):
    rows = A.ticks(spark, SF).select("symbol", "ts", "seq", "price")
    store = CompactedStore(str(tmp_path / "store"), rows.schema)
    lo, hi = rows.agg(F.min("seq"), F.max("seq")).first()
    parts = [rows.where(F.col("seq").between(lo + (hi - lo + 1) * i // batches, lo + (hi - lo + 1) * (i + 1) // batches - 1)) for i in range(batches)]
    return store, rows, parts


def test_merged_days_are_read_from_few_files(spark, tmp_path):
    store, rows, parts = store_of(spark, tmp_path, 8)
    rows = rows.cache()
    days = [r[0] for r in rows.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    for i in range(8):  # each batch has ticks of every day
        store.receive(rows.where(F.col("seq") % 8 == i), i)
    before = store.read(spark, days[3], days[3])
    assert len(before.inputFiles()) >= 8
    first = store.compact(spark, days[:6], through=6, file_rows=10)
    assert store.manifest(spark) == (first, {d: (first, 6) for d in days[:6]})
    assert answers(store.read(spark), "seq") == answers(rows, "seq")
    small = max(spark.read.parquet(f).count() for f in store.read(spark, days[3], days[3]).inputFiles())
    assert small <= 40
    second = store.compact(spark, days[:6], through=7)
    recent = store.read(spark, days[3], days[3])
    assert len(recent.inputFiles()) == 1 and second == first + 1
    assert answers(recent, "seq") == answers(rows.where(F.to_date("ts") == days[3]), "seq")
    # A batch that is repeated after its days were merged is not read twice, and late rows are.
    store.receive(rows.where(F.col("seq") % 8 == 7), 7)
    assert answers(store.read(spark), "seq") == answers(rows, "seq")
    late = rows.where(F.to_date("ts") == days[2]).withColumn("seq", F.col("seq") + 10**9)
    store.receive(late, 8)
    assert answers(store.read(spark), "seq") == answers(rows.unionByName(late), "seq")
    assert store.closed_days(spark, days[7], 8) == [days[2], days[6]]
    # A merge that failed before its manifest was whole does not count.
    spark.createDataFrame([(1,)], "x int").write.parquet(f"{store.path}/manifest/9")
    from tickloom.session import delete_folder

    delete_folder(spark, f"{store.path}/manifest/9/_SUCCESS")
    assert store.manifest(spark)[0] == second
    assert store.compact(spark, store.closed_days(spark, days[-1], 8), through=8) == 10
    assert store.vacuum(spark) > 0 and store.vacuum(spark) == 0
    assert answers(store.read(spark), "seq") == answers(rows.unionByName(late), "seq")


def test_an_empty_store(spark, tmp_path):
    store, rows, _ = store_of(spark, tmp_path, 1)
    assert store.read(spark).count() == 0 and store.manifest(spark) == (0, {})
    assert store.compact(spark, [dt.date(2024, 1, 1)], 3) == 1 and store.manifest(spark) == (1, {})


def test_messages_are_parsed_once_for_both_outcomes(spark, tmp_path):
    sent = A.faulty_envelopes(spark, SF).union(A.envelopes(spark, SF)).cache()
    passed = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            passed.add(len(frame))
            yield frame

    written = split_feed(sent.mapInPandas(count, sent.schema), f"{tmp_path}/a")
    good, bad = written.accepted(spark), written.rejected(spark)
    assert (written.accepted_rows, written.rejected_rows) == (good.count(), bad.count())
    assert passed.value == sent.count()
    assert answers(good) == answers(I.flatten_ticks(sent).select(*good.columns))
    assert answers(bad) == answers(I.feed_rejects(sent))
    counts = []
    receive = split_feed_batches(f"{tmp_path}/b", lambda w, i: counts.append((w.accepted_rows, w.rejected_rows)))
    receive(sent, 0)
    receive(sent, 0)
    receive(sent.limit(0), 1)
    assert counts[2] == (0, 0) and counts[0] == counts[1] == (written.accepted_rows, written.rejected_rows)


def test_last_rows_beyond_the_limit(spark):
    rows = [("A", T0 + dt.timedelta(seconds=i // 40 if i < 4000 else 100_000 + i), i, 0.0, 0.0) for i in range(6000)]
    rows += [("B", None, i, 0.0, 0.0) for i in range(1500)] + [(None, T0, i, 0.0, 0.0) for i in range(2500)]
    df = spark.createDataFrame(rows, SCHEMA)
    limit = int(spark.conf.get(GROUP_LIMIT))
    for n in (limit + 1, 2222, 5000):
        got = last_rows(df, n, "symbol").groupBy("symbol").agg(F.count("*").alias("n"), F.min("seq").alias("lo")).collect()
        want = {"A": (min(n, 6000), max(0, 6000 - n)), "B": (min(n, 1500), max(0, 1500 - n)), None: (min(n, 2500), max(0, 2500 - n))}
        assert {r["symbol"]: (r["n"], r["lo"]) for r in got} == want


def test_lines_without_infinity_and_empty_tags(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("A", T0, 1.0, inf), ("", T0, 2.0, -inf), (None, T0, 3.0, nan), ("B", T0, inf, nan), ("C", None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, date timestamp, open double, close double")
    lines = sorted(r["line"] for r in to_lines(df, "m", ["open", "close"]).collect())
    assert [line.rsplit(" ", 1)[0] for line in lines] == ["m open=2.0", "m open=3.0", "m,stock=A open=1.0"]
    bad = lines_rejects(df, ["open", "close"])
    assert sorted((r["symbol"], r["reject_reason"]) for r in bad.collect()) == [("B", "no_value"), ("C", "no_time")]
    assert df.select(line_protocol("m", {"t": F.lit("")}, {"f": F.lit(1.5)}, F.col("date")).alias("x")).first()["x"].startswith("m f=1.5 ")


def exponential(prices, alpha):
    mean, out = None, []
    for x in prices:
        if x is not None and abs(x) < float("inf"):
            mean = x if mean is None else alpha * x + (1 - alpha) * mean
        out.append(mean)
    return out


@pytest.mark.parametrize("rows_cut", [1_000_000, 700])
def test_means_pass_over_what_is_no_number(spark, rows_cut):
    rng = random.Random(8)
    odd = [float("nan"), float("inf"), float("-inf"), None]
    prices = [float("nan"), None] + [rng.choice(odd) if i in (5, 6, 900, 901, 2999) or 1500 <= i < 2300 else rng.uniform(1, 9) for i in range(3000)]
    rows = [("A", T0 + dt.timedelta(seconds=i), i, p, 0.0) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = T.with_studies(df, [T.ema("price", 12), T.ema("price", 1, "same"), T.rsi("price", 3, wilder=True)], split=Split(rows=rows_cut)).orderBy("seq").collect()
    assert [None if r["ema"] is None else round(r["ema"], 9) for r in out] == [None if m is None else round(m, 9) for m in exponential(prices, 2 / 13)]
    assert [r["same"] for r in out] == [p if p is not None and abs(p) < float("inf") else None for p in prices]
    ups = [b - a if a is not None and b is not None and abs(a) + abs(b) < float("inf") else None for a, b in zip([None, *prices], prices)]
    seen, want = 0, []
    gains, losses = (exponential([None if d is None else max(s * d, 0.0) for d in ups], 1 / 3) for s in (1, -1))
    for d, g, l in zip(ups, gains, losses):
        seen += d is not None
        want.append(None if seen < 3 else 100 - 100 / (1 + g / l) if l > 0 else 100.0 if g > 0 else None)
    assert [None if r["rsi"] is None else round(r["rsi"], 7) for r in out] == [None if w is None else round(w, 7) for w in want]
