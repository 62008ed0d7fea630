"""Filters, projections, limits and time ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.columns import in_session, price_signal
from tickloom.operators.series import as_keys
from tickloom.schema import ACCOUNT_FIELDS, ACCOUNT_KEYS, FIELD_NAMES


# Spark's bound on ranks that it filters before a shuffle; slices of a key's time beyond it.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
SLICES = 1024


def market_session(
    df: DataFrame,
    ts: str = "ts",
    zone: str = "America/New_York",
    pre_hours: bool = False,
    after_hours: bool = False,
) -> DataFrame:
    """Rows whose event time lies in the market session."""
    return df.where(in_session(F.col(ts), zone, pre_hours, after_hours))


def price_signals(df: DataFrame, price: str = "close", low: float = 100.0, high: float = 200.0) -> DataFrame:
    """Rows below `low` ('buy') or above `high` ('sell'), with a `signal` column."""
    outside = (F.col(price) < low) | (F.col(price) > high)
    return df.where(outside).withColumn("signal", price_signal(F.col(price), low, high))


def as_items(value: str | Sequence[object]) -> list[str]:
    """A list or a comma string."""
    return value.split(",") if isinstance(value, str) else [str(v) for v in value]


def subscribe_many(
    content: DataFrame, wanted: Mapping[str, tuple[str | Sequence[object], str | Sequence[object]]]
) -> DataFrame:
    """Feed items of the wanted {service: (keys, field ids)}, in one scan.

    `content` comes from `ingest.explode_content`. A field is null where the item's
    service did not ask for it; ids without a declared name are left out, as id 0 is the key.
    """
    asked = {service: (as_items(keys), set(as_items(fields))) for service, (keys, fields) in wanted.items()}
    match = F.lit(False)
    for service, (keys, _) in asked.items():
        match = match | ((F.col("service") == service) & F.col("content.key").isin(keys))
    columns: list[Column] = []
    for field_id, name in FIELD_NAMES.items():
        services = [s for s, (_, ids) in asked.items() if field_id in ids]
        if services:
            value = F.col(f"content.`{field_id}`")
            if len(services) < len(asked):
                value = F.when(F.col("service").isin(services), value)
            columns.append(value.alias(name))
    return content.where(match).select(
        "service", F.col("content.key").alias("symbol"), F.timestamp_millis("timestamp").alias("date"), *columns
    )


def subscribe(
    content: DataFrame, service: str, keys: str | Sequence[object], fields: str | Sequence[object]
) -> DataFrame:
    """Feed items of one service and key list, projected to a field-id list."""
    return subscribe_many(content, {service.upper(): (keys, fields)})


def account_activity(
    content: DataFrame, keys: str | Sequence[object] = ACCOUNT_KEYS, fields: str | Sequence[object] = ACCOUNT_FIELDS
) -> DataFrame:
    """Feed items of the account service, by default all of them."""
    return subscribe(content, "ACCT_ACTIVITY", keys, fields)


def time_range(
    df: DataFrame,
    interval: str = "1 minute",
    as_of: datetime | str | None = None,
    ts: str = "ts",
    day: str | None = None,
) -> DataFrame:
    """Rows of the last `interval` before `as_of` (default now): start included, stop not.

    The bounds get the column's own type, so the filter reaches a Parquet or JDBC scan. For a
    store partitioned by the date of `ts`, name that column as `day` to skip whole partitions.
    """
    kind = df.schema[ts].dataType.simpleString()
    stop = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    start = stop - F.expr(f"interval {interval}")
    if day is not None:
        df = df.where(F.col(day).between(start.cast("date"), stop.cast("date")))
    return df.where((F.col(ts) >= start.cast(kind)) & (F.col(ts) < stop.cast(kind)))


def last_rows(
    df: DataFrame,
    n: int = 60,
    keys: str | Sequence[str] | None = None,
    order: Sequence[str] = ("ts", "seq"),
) -> DataFrame:
    """The last n rows in time order, over all rows or per key.

    Per key the rank filter also runs before the shuffle, so each task sends n rows per key; Spark
    does that up to a setting. For larger n, rows are first counted in slices of each key's time: newer
    slices are kept as they are, and only the slice in which the n-th last row lies is ranked.
    """
    newest_first = [F.col(c).desc() for c in order]
    if keys is None:
        return df.orderBy(*newest_first).limit(n).orderBy(*order)
    keys = as_keys(keys)
    if n > int(df.sparkSession.conf.get(GROUP_LIMIT)):
        return _last_of_slices(df, n, keys, order)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def _last_of_slices(df: DataFrame, n: int, keys: list[str], order: Sequence[str]) -> DataFrame:
    """The rows without a time, which sort first, are slice -1."""
    at = F.unix_micros(F.col(order[0]).cast("timestamp"))
    spans = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.min(at).alias("_lo"), F.max(at).alias("_hi"))
    own = " AND ".join(f"`{k}` <=> `_k_{k}`" for k in keys)
    slice_of = F.coalesce(F.floor((at - F.col("_lo")).cast("double") * SLICES / (F.col("_hi") - F.col("_lo") + 1)).cast("int"), F.lit(-1))
    sliced = df.join(spans, F.expr(own), "left").withColumn("_slice", slice_of).drop("_lo", "_hi", *[f"_k_{k}" for k in keys])
    counts = sliced.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_slice").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)
    wanted = counts.withColumn("_rest", n - F.coalesce(F.sum("_n").over(newer), F.lit(0))).where("_rest > 0")
    kept = sliced.join(wanted, F.expr(f"{own} AND _slice = _s")).drop("_slice", "_s", *[f"_k_{k}" for k in keys])
    whole = kept.where("_n <= _rest").drop("_n", "_rest")
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order]))
    cut = kept.where("_n > _rest").withColumn("_rank", rank).where("_rank <= _rest").drop("_n", "_rest", "_rank")
    return whole.unionByName(cut)


def first_rows(df: DataFrame, n: int = 5, order: Sequence[str] = ("ts", "seq")) -> DataFrame:
    """The first n rows in time order."""
    return df.orderBy(*order).limit(n)


def rescale(df: DataFrame, columns: Sequence[str], base: float = 100.0, factor: float = 5.0) -> DataFrame:
    """base + factor * x for the named columns."""
    return df.withColumns({c: base + factor * F.col(c) for c in columns})


def business_days(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Monday to Friday between the first and the last day of a table, one row per `day`."""
    span = df.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day"))
    return days.where(F.weekday("day") < 5)


def business_days_from(spark: SparkSession, start: date | str, periods: int) -> DataFrame:
    """`periods` days from Monday to Friday, the first one on or after `start`."""
    first = F.lit(start).cast("date")
    # Any week has five such days, so this many days from the start hold enough of them.
    days = spark.range(periods // 5 * 7 + 7).select(F.date_add(first, F.col("id").cast("int")).alias("day"))
    return days.where(F.weekday("day") < 5).orderBy("day").limit(periods)
