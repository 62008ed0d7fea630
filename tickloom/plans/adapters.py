"""The operators' input shapes, derived by Spark from the `events` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.operators.bars import ohlcv_bars
from tickloom.operators.profile import to_long
from tickloom.schema import MONTH_CODES, SERVICES, SORT_FIELDS
from tickloom.session import scratch_dir
from tickloom.sinks.points import BAR_FIELDS
from tickloom.sources.files import stream_parquet


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def as_ticks(events: DataFrame) -> DataFrame:
    return with_k(events).select(
        F.col("event_type").alias("symbol"),
        "ts",
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        F.col("value").alias("close"),
        F.col("k").cast("double").alias("volume"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_ticks(events(spark, sf_dir))


def sparse_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as a feed sends them: fields that did not change are left out, also at the edges of hours."""
    k = F.col("volume").cast("bigint")
    left_out = {"price": k % 3 == 0, "close": k % 5 == 0, "volume": k % 4 == 0}
    return ticks(spark, sf_dir).withColumns({c: F.when(~gone, F.col(c)) for c, gone in left_out.items()})


def flat_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks whose price stands still in the second third of each symbol's rows.

    Thirds as by ntile(3). Rows are ranked within minutes, behind the counts of the minutes before, so
    that no task sorts a whole symbol.
    """
    rows = ticks(spark, sf_dir).select("symbol", "ts", "seq", "close").withColumn("minute", F.date_trunc("minute", "ts"))
    earlier = Window.partitionBy("symbol").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("symbol", "minute").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col("symbol").alias("of")).agg(F.sum("n").alias("total"))
    before = (
        counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .join(totals, F.col("symbol").eqNullSafe(F.col("of")))
        .select(F.col("symbol").alias("s"), F.col("minute").alias("m"), "before", "total")
    )
    rank = F.col("before") + F.row_number().over(Window.partitionBy("symbol", "minute").orderBy("ts", "seq"))
    first, second = F.floor((F.col("total") + 2) / 3), F.floor((F.col("total") + 1) / 3)
    met = rows.join(before, F.col("symbol").eqNullSafe(F.col("s")) & F.col("minute").eqNullSafe(F.col("m")))
    flat = (F.col("rank") > first) & (F.col("rank") <= first + second)
    return met.withColumn("rank", rank).select("symbol", "ts", "seq", F.when(flat, 50.0).otherwise(F.col("close")).alias("close"))


def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of which some are infinite or no number."""
    k = F.col("volume").cast("bigint")
    price = F.when(k == 0, float("inf")).when(k == 1, float("-inf")).when(k == 2, float("nan")).otherwise(F.col("price"))
    return ticks(spark, sf_dir).select(price.alias("price"), "volume")


def odd_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks whose price is at times infinite or no number."""
    k = F.col("volume").cast("bigint")
    close = F.when(k % 30 == 0, float("inf")).when(k % 30 == 1, float("-inf")).when(k % 15 == 2, float("nan")).otherwise(F.col("close"))
    return ticks(spark, sf_dir).withColumn("close", close)


# Micro-batches of a stream, at least; the rows of each, about, and of each of its files: more rows give
# more files, then more micro-batches.
STREAM_FILES, FILE_ROWS, PART_ROWS = 4, 4_000_000, 250_000


def file_stream(spark: SparkSession, rows: DataFrame, *order: str, files: int | None = None) -> DataFrame:
    """Rows as a file stream of STREAM_FILES or more micro-batches (or `files`), in this order.

    Each file is one task's work, and a micro-batch takes as many as it needs for its rows, so what a
    micro-batch costs besides its rows is paid once for many of them. The rows are read once to be counted
    and once to be written, by ranges; a stream takes files by age, so they get times in order.
    """
    path = scratch_dir(spark, "stream_files")
    total = rows.count()
    batches = files or max(STREAM_FILES, -(-total // FILE_ROWS))
    each = max(1, -(-total // (batches * PART_ROWS)))
    rows.repartitionByRange(batches * each, *order).sortWithinPartitions(*order).write.parquet(path)
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(context._jsc.hadoopConfiguration())
    parts = sorted(str(f.getPath()) for f in system.listStatus(folder) if f.getPath().getName().startswith("part-"))
    for i, part in enumerate(parts):
        system.setTimes(context._jvm.org.apache.hadoop.fs.Path(part), 1_700_000_000_000 + 1000 * i, -1)
    # Ranges without rows have no file.
    return stream_parquet(spark, path, rows.schema, max(1, len(parts) // batches))


def tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as a file stream, the oldest first; those without an id are in the first micro-batch."""
    return file_stream(spark, ticks(spark, sf_dir), "seq")


def late_tick_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as a file stream in which many come late: files follow a hash of the id, and so in no order of time."""
    shuffled = ticks(spark, sf_dir).withColumn("turn", F.xxhash64("seq"))
    return file_stream(spark, shuffled, "turn").drop("turn")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlcv_bars(ticks(spark, sf_dir), "1 hour").drop("trades")


def long_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_long(bars(spark, sf_dir), BAR_FIELDS)


def _service(user_id: Column) -> Column:
    return F.array(*[F.lit(s) for s in SERVICES])[(user_id % len(SERVICES)).cast("int")]


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed message per event: k = 0 is a notify, k = 1 a response, all others carry data."""
    content = F.struct(
        F.col("event_type").alias("key"), F.col("value").alias("3"), F.col("k").alias("8"), F.col("value").alias("12")
    )
    item = F.struct(
        _service(F.col("user_id")).alias("service"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.lit("SUBS").alias("command"),
        F.array(content).alias("content"),
    )
    note = F.array(F.struct(F.col("event_id").alias("heartbeat")))
    envelope = F.struct(
        F.when(F.col("k") == 1, note).alias("response"),
        F.when(F.col("k") == 0, note).alias("notify"),
        F.when(F.col("k") > 1, F.array(item)).alias("data"),
    )
    return with_k(events(spark, sf_dir)).select(F.to_json(envelope).alias("value"))


def faulty_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of two content items, some of which, or the whole message, cannot be used."""
    k = F.col("k")
    odd = (
        F.when(k % 8 == 0, '{"key":"A","3":"abc","8":7}')
        .when(k % 8 == 1, '{"3":1.5}')
        .when(k % 8 == 2, '{"key":"A","8":7.5}')
        .when(k % 8 == 3, '{"key":"A","22":1}')
        .otherwise('{"key":"A","3":2.5}')
    )
    good = F.concat(F.lit('{"key":"B","3":'), F.col("event_id").cast("string"), F.lit("}"))
    time = F.when(k % 10 == 9, "null").otherwise("1704067200000")
    text = F.concat(
        F.lit('{"data":[{"service":"S","timestamp":'), time, F.lit(',"content":['), good, F.lit(","), odd, F.lit("]}]}")
    )
    return with_k(events(spark, sf_dir)).select(F.when(k == 50, "nonsense").when(k == 51, "").otherwise(text).alias("value"))


def bar_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar message per event; k = 0 to 5 are the odd ones a consumer has to survive."""
    k = F.col("k")
    price = F.col("value")
    message = F.struct(
        F.when(k != 5, F.col("event_type")).alias("symbol"),
        F.when(k == 5, F.col("event_type")).alias("code"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("date"),
        F.when(k != 3, price).alias("open"),
        price.alias("high"),
        price.alias("low"),
        F.when(k != 4, price).alias("close"),
        k.cast("double").alias("volume"),
    )
    good = F.to_json(message)
    wrong_type = F.regexp_replace(good, r'"high":', '"open":"n/a","high":')
    sql_text = F.concat(F.lit("insert into bars values ("), F.col("event_id").cast("string"), F.lit(")"))
    value = (
        F.when(k == 0, "not json").when(k == 1, "").when(k == 2, sql_text).when(k == 3, wrong_type).otherwise(good)
    )
    return with_k(events(spark, sf_dir)).select(value.alias("value"))


def command_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return with_k(events(spark, sf_dir)).select(
        F.col("event_id").alias("seq"),
        "ts",
        (F.col("user_id") % 50).cast("string").alias("service"),
        F.when(kind == "signup", "SUBS").when(kind == "error", "UNSUBS").when(kind == "purchase", "VIEW")
        .otherwise("ADD").alias("command"),
        F.array((F.col("k") % 10).cast("string")).alias("keys"),
        F.array((F.col("k") % 7).cast("string")).alias("fields"),
    )


def feed_command_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commands over the services, keys and field ids of `envelopes`."""
    k = F.col("k")
    return with_k(events(spark, sf_dir)).select(
        F.col("event_id").alias("seq"),
        "ts",
        _service(F.col("user_id")).alias("service"),
        F.when(k < 50, "ADD").when(k < 52, "SUBS").when(k < 90, "UNSUBS").otherwise("VIEW").alias("command"),
        F.col("event_type").alias("keys"),
        F.when(k % 3 == 0, "3").when(k % 3 == 1, "8,12").otherwise("12").alias("fields"),
    )


def instrument_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks whose symbol is a key in one of the documented formats."""
    k, user = F.col("k"), F.concat(F.lit("U"), F.col("user_id").cast("string"))
    code = F.lit(MONTH_CODES).substr((k % 12 + 1).cast("int"), F.lit(1))
    right = F.when(k % 2 == 0, "C").otherwise("P")
    letter = F.char(F.lit(65) + F.col("user_id") % 26)
    field = F.array(*[F.lit(f) for f in SORT_FIELDS])[(k % len(SORT_FIELDS)).cast("int")]
    symbol = (
        F.when(
            F.col("event_type") == "click",
            F.concat(F.rpad(user, 6, " "), F.date_format("ts", "yyMMdd"), right, F.lpad((k * 1000).cast("string"), 8, "0")),
        )
        .when(F.col("event_type") == "view", F.concat(F.lit("/"), user, code, F.date_format("ts", "yy")))
        .when(
            F.col("event_type") == "signup",
            F.concat(F.lit("./"), user, code, F.date_format("ts", "yy"), right, k.cast("string")),
        )
        .when(F.col("event_type") == "purchase", F.concat(letter, letter, letter, F.lit("/USD")))
        .otherwise(F.concat(F.lit("EQUITY_ALL_"), field, F.lit("_30")))
    )
    return with_k(events(spark, sf_dir)).select(symbol.alias("symbol"), "ts", F.col("value").alias("price"))
