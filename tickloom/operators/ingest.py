"""From raw feed messages to typed ticks and bars. All operators also run on streams.

Input is a `value` column (bytes or text), as a Kafka source or a text file gives it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schema import BAR_SCHEMA, CONTENT_SCHEMA, ENVELOPE_SCHEMA, FIELD_NAMES, PRICE_SCHEMA, TICK_COLUMNS, TICK_SCHEMA

BAD = "_corrupt_record"
REASON = "reject_reason"


def _parse(value: Column, schema: T.StructType) -> Column:
    """Parse once per message.

    A filter on a parsed field would otherwise move below the projection and parse the text once
    per field it reads. Filters do not move below `explode`.
    """
    with_bad = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    return F.explode(F.array(F.from_json(value.cast("string"), with_bad, options)))


def _nothing_read(parsed: str, schema: T.StructType) -> Column:
    nothing = F.lit(True)
    for name in schema.names:
        nothing = nothing & F.col(f"{parsed}.{name}").isNull()
    return nothing


def _defect(parsed: str, schema: T.StructType) -> Column:
    """Why a message could not be read in full; null when it could."""
    bad = F.col(f"{parsed}.{BAD}").isNotNull()
    return (
        F.when(F.col(parsed).isNull(), "empty")
        .when(bad & _nothing_read(parsed, schema), "malformed")
        .when(bad, "bad_field")
    )


def parse_envelopes(df: DataFrame) -> DataFrame:
    """Add `envelope` (response, notify, data) and `reject_reason`."""
    parsed = df.withColumn("envelope", _parse(F.col("value"), ENVELOPE_SCHEMA))
    return parsed.withColumn(REASON, _defect("envelope", ENVELOPE_SCHEMA))


def route(parsed: DataFrame) -> DataFrame:
    """Add `route`: the first of response, notify, data that is set, else 'none' or 'rejected'."""
    unread = F.col(REASON).isin("empty", "malformed")
    return parsed.withColumn(
        "route",
        F.when(unread, "rejected")
        .when(F.col("envelope.response").isNotNull(), "response")
        .when(F.col("envelope.notify").isNotNull(), "notify")
        .when(F.col("envelope.data").isNotNull(), "data")
        .otherwise("none"),
    )


def explode_content(routed: DataFrame) -> DataFrame:
    """One row per content item of the data messages: service, timestamp, command, content.

    `reject_reason` says why an item could not be read in full; `item` is its text.
    """
    items = (
        routed.where(F.col("route") == "data")
        .select(F.explode("envelope.data").alias("d"))
        .select("d.service", "d.timestamp", "d.command", F.explode("d.content").alias("item"))
    )
    parsed = items.withColumn("content", _parse(F.col("item"), CONTENT_SCHEMA))
    return parsed.withColumn(REASON, _defect("content", CONTENT_SCHEMA))


def ticks_from_content(content: DataFrame) -> DataFrame:
    """Rename numeric field ids; ids that were not sent are null. `reject_reason` marks unusable ticks."""
    named = {name: F.col(f"content.`{i}`") for i, name in FIELD_NAMES.items()}
    named["symbol"] = F.col("content.key")
    named["date"] = F.timestamp_millis("timestamp")
    ticks = content.select("service", *[named[c].alias(c) for c in TICK_COLUMNS], "item", REASON)
    return ticks.withColumn(REASON, F.coalesce(REASON, _unusable(TICK_COLUMNS)))


def _unusable(columns: Sequence[str]) -> Column:
    """Why a tick or bar that could be read is of no use; the same rule for both."""
    values = F.coalesce(*[F.col(c).cast("double") for c in columns if c not in ("symbol", "date")])
    return (
        F.when(F.col("symbol").isNull(), "no_symbol")
        .when(F.col("date").isNull(), "no_time")
        .when(values.isNull(), "no_value")
    )


def flatten_ticks(df: DataFrame) -> DataFrame:
    """Raw messages to the usable ticks; `feed_rejects` has the rest."""
    return accepted(ticks_from_content(explode_content(route(parse_envelopes(df))))).drop("item")


def feed_rejects(df: DataFrame) -> DataFrame:
    """(reject_reason, text): messages that cannot be read, and unusable content items of the others."""
    routed = route(parse_envelopes(df))
    messages = routed.where(F.col("route") == "rejected").select(REASON, F.col("value").cast("string").alias("text"))
    items = rejected(ticks_from_content(explode_content(routed))).select(REASON, F.col("item").alias("text"))
    return messages.unionByName(items)


def feed_outcomes(df: DataFrame) -> DataFrame:
    """All that `flatten_ticks` and `feed_rejects` give, from one parse: a row per content item, or for a
    message that cannot be read, with `reject_reason` (null for usable ticks) and the `text` of what is
    rejected. Messages without content give nothing."""
    read = route(parse_envelopes(df))
    unread = F.col("route") == "rejected"
    # One row per message stands for those that have no items of their own.
    whole = F.struct(
        F.lit(None).cast("string").alias("service"),
        F.lit(None).cast("bigint").alias("timestamp"),
        F.lit(None).cast("string").alias("item"),
        F.col("value").cast("string").alias("text"),
        F.col(REASON).alias(REASON),
    )
    of_data = F.transform(
        "envelope.data",
        lambda d: F.transform(
            d["content"],
            lambda item: F.struct(
                d["service"].alias("service"),
                d["timestamp"].alias("timestamp"),
                item.alias("item"),
                item.alias("text"),
                F.lit(None).cast("string").alias(REASON),
            ),
        ),
    )
    units = F.when(unread, F.array(whole)).when(F.col("route") == "data", F.flatten(F.filter(of_data, lambda x: x.isNotNull())))
    items = read.select(F.explode(units).alias("u")).select("u.*")
    content = items.withColumn("content", _parse(F.col("item"), CONTENT_SCHEMA))
    content = content.withColumn(REASON, F.coalesce(REASON, _defect("content", CONTENT_SCHEMA)))
    ticks = ticks_from_content(content.withColumn("item", F.col("text"))).withColumnRenamed("item", "text")
    return ticks.withColumn("text", F.when(F.col(REASON).isNotNull(), F.col("text")))


def parse_bars(df: DataFrame) -> DataFrame:
    """Raw bar messages to typed bars plus `value` and `reject_reason`.

    The symbol may come as `symbol` or as `code`. Text that is not a JSON object is only
    ever rejected, never run.
    """
    wire = T.StructType([T.StructField("code", T.StringType()), *BAR_SCHEMA.fields])
    return _typed(df, wire, BAR_SCHEMA, F.coalesce("read.symbol", "read.code"))


def parse_ticks(df: DataFrame) -> DataFrame:
    """Published ticks, with last price, bid and ask, plus `value` and `reject_reason`."""
    return _typed(df, TICK_SCHEMA, TICK_SCHEMA, F.col("read.symbol"))


def _typed(df: DataFrame, wire: T.StructType, schema: T.StructType, symbol: Column) -> DataFrame:
    parsed = df.select(F.col("value").cast("string").alias("value"), _parse(F.col("value"), wire).alias("read"))
    typed = parsed.select(
        "value", symbol.alias("symbol"), *[F.col(f"read.{c}") for c in schema.names[1:]], _defect("read", wire).alias(REASON)
    )
    return typed.withColumn(REASON, F.coalesce(REASON, _unusable(schema.names)))


def parse_prices(df: DataFrame) -> DataFrame:
    """Price messages (symbol, price, volume) plus `value` and `reject_reason`.

    They carry no time; a source's own time or offset columns are kept for that.
    """
    others = [c for c in df.columns if c != "value"]
    parsed = df.select(*others, F.col("value").cast("string").alias("value"), _parse(F.col("value"), PRICE_SCHEMA).alias("read"))
    reason = F.coalesce(
        _defect("read", PRICE_SCHEMA),
        F.when(F.col("read.symbol").isNull(), "no_symbol").when(F.col("read.price").isNull(), "no_value"),
    )
    return parsed.select(*others, "value", "read.symbol", "read.price", "read.volume", reason.alias(REASON))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull())


def to_messages(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Kafka-ready `key` and `value`: JSON of all columns, nulls written out, ISO-8601 times.

    The symbol as key spreads a topic over its partitions and keeps a symbol in order.
    """
    options = {
        "ignoreNullFields": "false",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    }
    body = F.to_json(F.struct(*df.columns), options)
    return df.select(F.col(key).cast("string").alias("key"), body.alias("value"))
