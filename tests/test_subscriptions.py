"""The set-based fold against a replay, command by command."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators.subscriptions import subscription_state

SCHEMA = "seq bigint, service string, command string, keys array<string>, fields array<string>"


def replay(log):
    state = {}
    for _, service, command, keys, fields in sorted(log):
        if command == "CLEAR":
            state.clear()
            continue
        if keys is None and fields is None:
            continue
        held = state.setdefault(service, {})
        keys, fields = keys or [], fields or []
        if command == "ADD":
            for key in keys:
                held[key] = held.get(key, set()) | set(fields)
        elif command == "SUBS":
            held.clear()
            held.update({key: set(fields) for key in keys})
        elif command == "UNSUBS":
            for key in keys:
                held.pop(key, None)
        elif command == "VIEW":
            held.update({key: set(fields) for key in held})
    return {(s, k, tuple(sorted(f))) for s, keys in state.items() for k, f in keys.items()}


def random_log(seed, n):
    rng = random.Random(seed)
    log = []
    for seq in range(n):
        command = rng.choices(["ADD", "SUBS", "UNSUBS", "VIEW", "CLEAR", "LOGIN"], [8, 1, 4, 2, 0.2, 0.5])[0]
        service = None if command == "CLEAR" else rng.choice("ABC")
        none = command in ("CLEAR", "LOGIN")
        keys = None if none else rng.sample("xyzuvw", rng.randrange(0, 4))
        fields = None if none else rng.sample("0123456", rng.randrange(0, 4))
        log.append((seq, service, command, keys, fields))
    return log


def fold(spark, log, **options):
    state = subscription_state(spark.createDataFrame(log, SCHEMA), **options)
    return {(r.service, r.key, tuple(r.fields)) for r in state.collect()}


@pytest.mark.parametrize("seed, n", [(1, 5), (2, 40), (3, 150), (4, 600), (5, 25), (6, 80)])
def test_equals_replay(spark, seed, n):
    log = random_log(seed, n)
    assert fold(spark, log) == replay(log)


def test_comma_strings_and_lower_case(spark):
    log = [(1, "levelone_equities", "add", "AMD,INTC", "0,1"), (2, "LEVELONE_EQUITIES", "ADD", "AMD", "2,1")]
    df = spark.createDataFrame(log, "seq bigint, service string, command string, keys string, fields string")
    got = {(r.service, r.key, tuple(r.fields)) for r in subscription_state(df).collect()}
    assert got == {
        ("LEVELONE_EQUITIES", "AMD", ("0", "1", "2")),
        ("LEVELONE_EQUITIES", "INTC", ("0", "1")),
    }


def test_subscribed_feed_shuffled_equals_broadcast(spark):
    from tickloom.operators import ingest as I
    from tickloom.operators.subscriptions import subscribed
    from tickloom.plans import adapters as A

    sf_dir = "/root/testdata/sf0.001"
    content = I.explode_content(I.route(I.parse_envelopes(A.envelopes(spark, sf_dir))))
    state = subscription_state(A.feed_command_log(spark, sf_dir))
    broadcast, shuffled = subscribed(content, F.broadcast(state)), subscribed(content, state)
    assert broadcast.count() > 0
    assert sorted(map(repr, broadcast.collect())) == sorted(map(repr, shuffled.collect()))


def test_the_fold_runs_nothing_while_it_is_built(spark):
    from tickloom.plans import adapters as A

    before = spark.sparkContext.statusTracker().getJobIdsForGroup("fold")
    spark.sparkContext.setJobGroup("fold", "building")
    try:
        subscription_state(A.command_log(spark, "/root/testdata/sf0.001"))
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("fold")) == list(before)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_subscribed_never_broadcasts_the_feed(spark):
    """Also where the estimate says that the feed is the smaller side."""
    from tickloom.operators import ingest as I
    from tickloom.operators.subscriptions import subscribed

    text = '{"data":[{"service":"S","timestamp":1,"content":[{"key":"A","3":2.5},{"key":"B","3":1.5}]}]}'
    content = I.explode_content(I.route(I.parse_envelopes(spark.createDataFrame([(text,)] * 3, "value string"))))
    rows = spark.range(50_000).selectExpr("'S' AS service", "if(id = 0, 'A', concat('K', id)) AS key", "array('3') AS fields")
    feed = subscribed(content, rows)
    assert [tuple(r) for r in feed.select("symbol", "lastPrice").collect()] == [("A", 2.5)] * 3
    plan = feed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan
