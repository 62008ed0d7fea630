"""Declared schemas and the fixed values of the feed."""

from __future__ import annotations

from pyspark.sql import types as T

# Level-one field ids and the tick columns they fill.
FIELD_NAMES = {
    "1": "bidPrice",
    "2": "askPrice",
    "3": "lastPrice",
    "4": "bidSize",
    "5": "askSize",
    "8": "volume",
    "10": "high",
    "11": "low",
    "12": "close",
    "17": "open",
}

# Service tags.
SERVICES = (
    "LEVELONE_EQUITIES",
    "LEVELONE_OPTIONS",
    "LEVELONE_FUTURES",
    "LEVELONE_FUTURES_OPTIONS",
    "LEVELONE_FOREX",
    "NYSE_BOOK",
    "NASDAQ_BOOK",
    "OPTIONS_BOOK",
    "CHART_EQUITY",
    "CHART_FUTURES",
    "SCREENER_EQUITY",
    "SCREENER_OPTION",
    "ACCT_ACTIVITY",
)

# Futures month codes, January to December.
MONTH_CODES = "FGHJKMNQUVXZ"

# Screener sort fields and frequencies in minutes (0 is the whole day).
SORT_FIELDS = ("VOLUME", "TRADES", "PERCENT_CHANGE_UP", "PERCENT_CHANGE_DOWN", "AVERAGE_PERCENT_VOLUME")
FREQUENCIES = (0, 1, 5, 10, 30, 60)

_FIELD_TYPES = {"4": T.IntegerType(), "5": T.IntegerType(), "8": T.LongType()}

CONTENT_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType())]
    + [T.StructField(i, _FIELD_TYPES.get(i, T.DoubleType())) for i in FIELD_NAMES]
)

# `response` and `notify` stay JSON text: their element types are not declared by the feed.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("response", T.StringType()),
        T.StructField("notify", T.StringType()),
        T.StructField(
            "data",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("service", T.StringType()),
                        T.StructField("timestamp", T.LongType()),
                        T.StructField("command", T.StringType()),
                        # As text, so that a wrong-typed field spoils its own item only.
                        T.StructField("content", T.ArrayType(T.StringType())),
                    ]
                )
            ),
        ),
    ]
)

BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)

# Column order of a published tick.
TICK_COLUMNS = (
    "symbol", "date", "open", "high", "low", "close", "volume",
    "lastPrice", "bidPrice", "bidSize", "askPrice", "askSize",
)

_TICK_TYPES = {"symbol": T.StringType(), "date": T.TimestampType(), "bidSize": T.IntegerType(), "askSize": T.IntegerType()}

TICK_SCHEMA = T.StructType([T.StructField(c, _TICK_TYPES.get(c, T.DoubleType())) for c in TICK_COLUMNS])

# The price message.
PRICE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
    ]
)

# What an account subscription asks for when nothing is named.
ACCOUNT_KEYS = "Account Activity"
ACCOUNT_FIELDS = "0,1,2,3"
