"""Current subscriptions from a stream of commands."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.subscriptions import effective, normalized
from tickloom.session import scratch_scope
from tickloom.streaming.state import StateLog

# A row per live (service, key, field): when the field was last added, and last added before the service's
# VIEW; and a row per service, without a key, with that VIEW.
STATE = T.StructType([T.StructField(name, T.StringType()) for name in ("service", "key", "field")])
for _name in ("added", "before_view", "view"):
    STATE.add(_name, T.DecimalType(38, 0))
STATE.add("view_fields", T.ArrayType(T.StringType()))


class SubscriptionFold:
    """`subscription_state` kept up to date batch by batch.

    `receive` is for `foreachBatch`. A batch merges its commands, each a grouped maximum, into the rows of
    the services that it names; what a reset, a removal or CLEAR ends leaves the state, so it grows with
    the live subscriptions and not with the log. A command that comes in a later batch counts as later.
    """

    def __init__(self, path: str, full_every: int = 32):
        self.log = StateLog(path, "service", full_every)

    def _merged(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        at = (F.lit(batch_id).cast("decimal(38,0)") * F.lit(Decimal(2**63)) + F.col("seq")).cast("decimal(38,0)")
        log = normalized(batch).withColumn("at", at)
        cleared = log.where(F.col("command") == "CLEAR").agg(F.max("at")).first()[0]
        real = effective(log)
        before = self.log.before(spark, STATE, batch_id)
        if before is None:
            before = spark.createDataFrame([], STATE)
        view, reset = F.col("command") == "VIEW", F.col("command") == "SUBS"
        named = real.groupBy("service").agg(
            F.max(F.when(reset, F.col("at"))).alias("reset"),
            F.max(F.when(view, F.col("at"))).alias("new_view"),
            F.max_by("fields", F.when(view, F.col("at"))).alias("new_fields"),
        )
        known = before.where("key is null").select("service", "view", "view_fields")
        # CLEAR concerns every service, otherwise only those that the batch names change.
        services = known.join(named, "service", "right" if cleared is None else "full").select(
            "service",
            F.greatest("reset", F.lit(cleared).cast("decimal(38,0)")).alias("reset"),
            F.col("new_view").isNotNull().alias("viewed"),
            F.coalesce("new_view", "view").alias("view"),
            F.when(F.col("new_view").isNotNull(), F.col("new_fields")).otherwise(F.col("view_fields")).alias("view_fields"),
        )
        by_key = real.where(~view).select("service", "at", "command", "fields", F.explode("keys").alias("key"))
        removed = by_key.where("command = 'UNSUBS'").groupBy("service", "key").agg(F.max("at").alias("removed"))
        adds = by_key.where("command <> 'UNSUBS'").select(
            "service", "key", F.explode_outer("fields").alias("field"), F.col("at").alias("added"), F.lit(None).cast("decimal(38,0)").alias("held")
        )
        old = before.where("key is not null").select("service", "key", "field", "added", F.col("before_view").alias("held"))
        entries = old.withColumn("old", F.lit(True)).unionByName(adds.withColumn("old", F.lit(False)))
        entries = entries.join(services.select("service", "reset", "viewed", "view"), "service").join(removed, ["service", "key"], "left")
        before_view = F.when(F.col("old") & ~F.col("viewed"), F.col("held")).when(F.col("added") < F.col("view"), F.col("added"))
        merged = entries.groupBy("service", "key", "field").agg(
            F.max("added").alias("added"),
            F.max(before_view).alias("before_view"),
            F.max("reset").alias("reset"),
            F.max("removed").alias("removed"),
        )
        lives = F.coalesce(F.col("added") >= F.col("reset"), F.lit(True)) & F.coalesce(F.col("added") > F.col("removed"), F.lit(True))
        lived = F.coalesce(F.col("before_view") >= F.col("reset"), F.lit(True)) & F.coalesce(F.col("before_view") > F.col("removed"), F.lit(True))
        live = merged.where(lives).withColumn("before_view", F.when(lived, F.col("before_view")))
        rows = live.select("service", "key", "field", "added", "before_view").unionByName(
            services.select("service", "view", "view_fields"), allowMissingColumns=True
        )
        return rows.select(*STATE.names)

    def receive(self, write: Callable[[DataFrame, int], None] | None = None) -> Callable[[DataFrame, int], None]:
        """`write` gets the subscriptions of the services that a batch changed; a service that has none left
        comes as a row without a key."""

        def handle(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                with scratch_scope():
                    self.log.write(self._merged(batch, batch_id), batch_id)
                    if write is not None:
                        rows = batch.sparkSession.read.schema(STATE).parquet(f"{self.log.path}/{batch_id}")
                        emptied = rows.groupBy("service").agg(F.max("key").alias("any")).where("any is null")
                        none = emptied.select("service", F.lit(None).cast("string").alias("key"), F.lit(None).cast("array<string>").alias("fields"))
                        write(snapshot(rows).unionByName(none), batch_id)
            finally:
                batch.unpersist()

        return handle

    def state(self, spark: SparkSession, batches: int) -> DataFrame:
        """(service, key, fields) after that many batches."""
        return snapshot(self.log.before(spark, STATE, batches))


def snapshot(rows: DataFrame) -> DataFrame:
    """(service, key, fields) from rows of `STATE`; a key that lived through the service's VIEW has its fields,
    and those added later."""
    views = rows.where("key is null").select("service", "view", "view_fields")
    seen = rows.where("key is not null").groupBy("service", "key").agg(
        F.max("before_view").alias("before_view"),
        F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", "added"))).alias("seen"),
    )
    joined = seen.join(views, "service", "left")
    later = F.filter("seen", lambda x: x["added"] > F.col("view"))
    of_view = F.array_union(F.coalesce("view_fields", F.array().cast("array<string>")), F.transform(later, lambda x: x["field"]))
    every = F.transform("seen", lambda x: x["field"])
    fields = F.when(F.col("before_view").isNotNull(), of_view).otherwise(every)
    return joined.select("service", "key", F.sort_array(F.array_distinct(fields)).alias("fields"))
