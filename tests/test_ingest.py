"""Parsing, routing, flattening, rejects and publishing."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tickloom.operators import ingest as I
from tickloom.operators.select import account_activity, subscribe, subscribe_many


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


BARS = {
    "not json": "malformed",
    "insert into bars values (1)": "malformed",
    "[1]": "malformed",
    "5": "malformed",
    "": "empty",
    '{"symbol":"A","open":"x","close":1.5}': "bad_field",
    '{"symbol":"A","open":"2.5"}': "bad_field",
    "{}": "no_symbol",
    '{"open":1.0}': "no_symbol",
    '{"symbol":"A","close":1}': "no_time",
    '{"code":"B","open":1.0,"close":2}': "no_time",
    '{"symbol":"A","date":"2024-01-01T00:00:01Z"}': "no_value",
    '{"symbol":"A","date":"2024-01-01T00:00:01Z","volume":2}': None,
    '{"code":"A","date":"2024-01-01 00:00:02","close":1}': None,
}


def test_bar_rejects_keep_every_message(spark):
    parsed = I.parse_bars(messages(spark, *BARS, None)).cache()
    reasons = {r.value: r.reject_reason for r in parsed.collect()}
    assert reasons == {**BARS, None: "empty"}
    assert I.accepted(parsed).count() + I.rejected(parsed).count() == len(BARS) + 1


def test_bar_fields(spark):
    rows = {r.value: r for r in I.parse_bars(messages(spark, *BARS)).collect()}
    assert rows['{"code":"B","open":1.0,"close":2}'].symbol == "B"
    assert rows['{"symbol":"A","open":"x","close":1.5}'].close == 1.5
    assert rows['{"symbol":"A","date":"2024-01-01T00:00:01Z"}'].date == dt.datetime(2024, 1, 1, 0, 0, 1)
    assert rows['{"code":"A","date":"2024-01-01 00:00:02","close":1}'].date == dt.datetime(2024, 1, 1, 0, 0, 2)


def test_bytes_are_accepted(spark):
    df = messages(spark, '{"symbol":"A","date":"2024-01-01T00:00:01Z","close":1}').select(F.col("value").cast("binary").alias("value"))
    assert I.accepted(I.parse_bars(df)).first().close == 1.0


ENVELOPE = {
    "data": [
        {
            "service": "LEVELONE_EQUITIES",
            "timestamp": 1704067200123,
            "command": "SUBS",
            "content": [
                {"key": "NVDA", "1": 1.0, "2": 2.0, "3": 3.0, "4": 4, "5": 5, "8": 8, "10": 10.0, "11": 11.0, "12": 12.0, "17": 17.0},
                {"key": "AMD", "3": 1.5, "22": 9},
            ],
        },
        {"service": "CHART_EQUITY", "timestamp": 1704067201000, "content": [{"key": "NVDA", "3": 7.0}]},
    ]
}


def test_routes(spark):
    texts = [
        json.dumps(ENVELOPE),
        '{"response": [{"a": 1}], "data": []}',
        '{"notify": [{"heartbeat": "1"}], "data": []}',
        '{"response": null, "notify": null}',
        "nothing",
        "",
    ]
    routed = I.route(I.parse_envelopes(messages(spark, *texts)))
    assert [r.route for r in routed.collect()] == ["data", "response", "notify", "none", "rejected", "rejected"]


def test_flatten_gives_one_tick_per_content_item(spark):
    ticks = I.flatten_ticks(messages(spark, json.dumps(ENVELOPE))).collect()
    assert len(ticks) == 3
    full = next(t for t in ticks if t.open == 17.0)
    assert full.symbol == "NVDA" and full.date == dt.datetime(2024, 1, 1, 0, 0, 0, 123000)
    assert (full.bidPrice, full.askPrice, full.lastPrice, full.bidSize, full.askSize) == (1.0, 2.0, 3.0, 4, 5)
    assert (full.volume, full.high, full.low, full.close) == (8, 10.0, 11.0, 12.0)
    sparse = next(t for t in ticks if t.symbol == "AMD")
    assert sparse.lastPrice == 1.5 and sparse.open is None and sparse.volume is None


def test_one_bad_tick_does_not_drop_the_others(spark):
    text = '{"data":[{"service":"S","timestamp":1000,"content":[{"key":"A","3":"oops"},{"key":"B","3":2.0},{"3":1.0}]}]}'
    ticks = I.ticks_from_content(I.explode_content(I.route(I.parse_envelopes(messages(spark, text)))))
    assert {t.symbol: t.lastPrice for t in I.accepted(ticks).collect()} == {"B": 2.0}
    assert sorted(t.reject_reason for t in I.rejected(ticks).collect()) == ["bad_field", "no_symbol"]


def test_every_item_is_a_tick_or_a_reject(spark):
    text = (
        '{"data":[{"service":"S","timestamp":1000,"content":[{"key":"A","3":"abc"},{"key":"B","8":7.5},'
        '{"key":"C","22":1},{"key":"D","3":1.0},{"3":2.0}]},{"service":"S","content":[{"key":"E","3":1.0}]}]}'
    )
    df = messages(spark, text, "nonsense", "")
    rejects = I.feed_rejects(df).collect()
    reasons = sorted(r.reject_reason for r in rejects)
    assert reasons == ["bad_field", "bad_field", "empty", "malformed", "no_symbol", "no_time", "no_value"]
    assert '{"key":"A","3":"abc"}' in {r.text for r in rejects}
    assert [t.symbol for t in I.flatten_ticks(df).collect()] == ["D"]


def test_published_ticks_and_price_messages_are_read_back(spark):
    tick = '{"symbol":"A","date":"2024-01-01T00:00:01Z","lastPrice":1.5,"bidSize":3,"askPrice":2}'
    row = I.accepted(I.parse_ticks(messages(spark, tick))).first()
    assert (row.lastPrice, row.bidSize, row.askPrice, row.open) == (1.5, 3, 2.0, None)
    texts = ['{"symbol": "AAPL", "price": 150, "volume": 1000}', '{"price": 1}', '{"symbol":"A"}', '{"symbol":"A","price":"x"}']
    read = I.parse_prices(messages(spark, *texts)).collect()
    assert [r.reject_reason for r in read] == [None, "no_symbol", "no_value", "bad_field"]
    assert (read[0].symbol, read[0].price, read[0].volume) == ("AAPL", 150.0, 1000.0)


def test_account_activity_defaults(spark):
    text = '{"data":[{"service":"ACCT_ACTIVITY","timestamp":1000,"content":[{"key":"Account Activity","3":2.0,"8":1}]}]}'
    content = I.explode_content(I.route(I.parse_envelopes(messages(spark, text))))
    row = account_activity(content).first()
    assert row.lastPrice == 2.0 and "volume" not in row.asDict()


def test_published_message_has_every_field(spark):
    df = spark.createDataFrame([("A", dt.datetime(2024, 1, 1, 0, 0, 0, 123456), None)], "symbol string, date timestamp, close double")
    row = I.to_messages(df).first()
    assert row.key == "A"
    assert json.loads(row.value) == {"symbol": "A", "date": "2024-01-01T00:00:00.123456Z", "close": None}


def test_subscribe_by_list_or_comma_string(spark):
    content = I.explode_content(I.route(I.parse_envelopes(messages(spark, json.dumps(ENVELOPE)))))
    got = subscribe(content, "levelone_equities", "NVDA,SMCI", "0,1,3")
    assert got.columns == ["service", "symbol", "date", "bidPrice", "lastPrice"]
    assert [(r.symbol, r.bidPrice, r.lastPrice) for r in got.collect()] == [("NVDA", 1.0, 3.0)]
    same = subscribe(content, "LEVELONE_EQUITIES", ["NVDA", "SMCI"], [0, 1, 3])
    assert same.collect() == got.collect()
    both = subscribe_many(content, {"LEVELONE_EQUITIES": ("AMD", "3"), "CHART_EQUITY": ("NVDA", "8")})
    assert {(r.service, r.lastPrice, r.volume) for r in both.collect()} == {
        ("LEVELONE_EQUITIES", 1.5, None),
        ("CHART_EQUITY", None, None),
    }


def test_text_is_parsed_once(spark):
    plan = I.accepted(I.parse_bars(messages(spark, "{}")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
