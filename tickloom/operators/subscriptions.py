"""Current subscriptions from an ordered log of subscription commands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.columns import as_list
from tickloom.schema import FIELD_NAMES


def normalized(log: DataFrame) -> DataFrame:
    """The command log in upper case, with keys and fields as arrays; other columns stay."""
    lists = {c: as_list(F.col(c), isinstance(log.schema[c].dataType, T.ArrayType)) for c in ("keys", "fields")}
    return log.withColumns({"service": F.upper("service"), "command": F.upper("command"), **lists})


def effective(log: DataFrame) -> DataFrame:
    """The commands that change a service's subscriptions."""
    named = F.col("keys").isNotNull() | F.col("fields").isNotNull()
    return log.where(F.col("command").isin("ADD", "SUBS", "UNSUBS", "VIEW") & named)


def subscription_state(log: DataFrame) -> DataFrame:
    """Replay (seq, service, command, keys, fields) into (service, key, fields).

    ADD inserts keys or unions their fields; SUBS clears the service and sets its keys; UNSUBS
    removes keys; VIEW sets the fields of every key the service then has; CLEAR empties all
    services. Commands with neither keys nor fields (login, logout) change nothing. Keys and
    fields are arrays or comma strings; `seq` is a total order. Field lists come out sorted.

    Nothing is replayed row by row. A key lives when its last ADD or SUBS came after its last
    UNSUBS and not before the service's last reset; its fields are those of the last VIEW it
    lived through, plus those added later.
    """
    log = normalized(log)
    cleared = log.where(F.col("command") == "CLEAR").agg(F.max("seq")).scalar()
    real = effective(log)

    is_view = F.col("command") == "VIEW"
    per_service = real.where(F.col("command").isin("SUBS", "VIEW")).groupBy("service").agg(
        F.max(F.when(F.col("command") == "SUBS", F.col("seq"))).alias("_reset"),
        F.max(F.when(is_view, F.col("seq"))).alias("_view"),
        F.max_by("fields", F.when(is_view, F.col("seq"))).alias("_view_fields"),
    )

    by_key = real.where(~is_view).select(
        "service", "seq", "command", "fields", F.explode("keys").alias("key")
    )
    adds = F.col("command") != "UNSUBS"
    per_field = (
        by_key.join(per_service.select("service", "_view"), "service", "left")
        .withColumn("field", F.explode_outer(F.when(adds, F.col("fields"))))
        .groupBy("service", "key", "field")
        .agg(
            F.max(F.when(adds, F.col("seq"))).alias("_added"),
            F.max(F.when(adds & (F.col("seq") < F.col("_view")), F.col("seq"))).alias("_added_before_view"),
            F.max(F.when(~adds, F.col("seq"))).alias("_removed"),
        )
    )
    # One entry per distinct field id of the key.
    per_key = per_field.groupBy("service", "key").agg(
        F.max("_added").alias("_added"),
        F.max("_added_before_view").alias("_added_before_view"),
        F.max("_removed").alias("_removed"),
        F.collect_list(F.when(F.col("field").isNotNull(), F.struct("field", F.col("_added").alias("seq")))).alias("_seen"),
    )
    state = per_key.join(per_service, "service", "left")
    # A reset row is itself live, an UNSUBS row is not: keep seq >= reset and seq > removed.
    since = F.greatest(F.coalesce("_reset", F.lit(-(2**63))), F.coalesce(F.col("_removed") + 1, F.lit(-(2**63))), cleared)
    state = state.withColumn("_since", since).where(F.col("_added") >= F.col("_since"))
    viewed = F.coalesce(F.col("_added_before_view") >= F.col("_since"), F.lit(False))

    def fields_from(bound: Column) -> Column:
        return F.transform(F.filter("_seen", lambda x: x["seq"] >= bound), lambda x: x["field"])

    fields = F.when(
        viewed,
        F.array_union(
            F.coalesce("_view_fields", F.array().cast("array<string>")),
            fields_from(F.greatest(F.col("_since"), F.col("_view"))),
        ),
    ).otherwise(fields_from(F.col("_since")))
    return state.select("service", "key", F.sort_array(F.array_distinct(fields)).alias("fields"))


def subscription_intervals(log: DataFrame, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """When which subscriptions hold, from a command log with times: (keys, views).

    `keys` has a row for each ADD and SUBS and key: from its time until the key's next command, or the
    service's next SUBS or CLEAR, the key has the fields `added` since it was last without any or since
    the last VIEW, in its life since `born`. `views` has a row for each VIEW: its fields, until the next
    VIEW, SUBS or CLEAR of the service. A command holds from its time on; `seq` is a total order that
    does not go against time. An open end is null.

    The fields a key has at a time are thus found in one row of each; no row is made for each pair of a
    VIEW and a key. Commands are windowed per service: they are few beside the items they govern.
    """
    log = normalized(log).withColumn("at", F.col(ts))
    real = effective(log).select("service", "seq", "at", "command", "keys", "fields")
    services = real.select("service").distinct().withColumn("all", F.lit(1))
    clears = log.where(F.col("command") == "CLEAR").select(F.lit(1).alias("all"), "seq", "at", "command")
    clears = clears.join(services, "all").select(
        "service", "seq", "at", "command", F.lit(None).cast("array<string>").alias("keys"), F.lit(None).cast("array<string>").alias("fields")
    )
    one = real.unionByName(clears)
    on_service, so_far = Window.partitionBy("service"), (Window.unboundedPreceding, 0)
    earlier = on_service.orderBy("seq").rowsBetween(*so_far)
    later = on_service.orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, -1)
    reset, view = F.col("command").isin("SUBS", "CLEAR"), F.col("command") == "VIEW"
    placed = one.withColumns(
        {
            "reset": F.max(F.when(reset, F.col("seq"))).over(earlier),
            "view": F.max(F.when(view, F.col("seq"))).over(earlier),
            "reset_at": F.last(F.when(reset, F.col("at")), True).over(later),
            "view_at": F.last(F.when(view, F.col("at")), True).over(later),
        }
    )
    views = placed.where(view).select(
        "service", F.col("seq").alias("view"), F.col("at").alias("start"), F.least("view_at", "reset_at").alias("stop"), "fields"
    )
    by_key = placed.where(F.col("command").isin("ADD", "SUBS", "UNSUBS")).withColumn("key", F.explode(F.array_distinct("keys")))
    own = Window.partitionBy("service", "key").orderBy("seq")
    removed = F.max(F.when(F.col("command") == "UNSUBS", F.col("seq"))).over(own.rowsBetween(*so_far))
    by_key = by_key.withColumns({"dead": F.coalesce(F.greatest("reset", removed), F.lit(-(2**63))), "next_at": F.lead("at").over(own)})
    alive = by_key.where(F.col("command") != "UNSUBS")
    alive = alive.withColumn("since", F.coalesce(F.greatest("dead", "view"), F.col("dead")))
    life = Window.partitionBy("service", "key", "dead")
    added = F.collect_set("fields").over(Window.partitionBy("service", "key", "since").orderBy("seq").rowsBetween(*so_far))
    keys = alive.select(
        "service",
        "key",
        "seq",
        F.min("seq").over(life).alias("born"),
        F.col("at").alias("start"),
        F.least("next_at", "reset_at").alias("stop"),
        F.array_distinct(F.flatten(added)).alias("added"),
    )
    return keys, views


def _in_force(items: DataFrame, spans: DataFrame, on: list[str], at: str, days: int, how: str) -> DataFrame:
    """Items with the one span of their keys that holds at their time.

    Closed spans meet items of the same days, so that a busy key is dealt out along time; open spans,
    of which a key has one, meet all of its items. Joins are on equal columns, so adaptive execution
    broadcasts small sides and splits what is still uneven.
    """
    size = days * 86_400_000_000

    def bucket(column: str) -> Column:
        return F.floor(F.unix_micros(F.col(column).cast("timestamp")) / size)

    here = [*on, "_bucket"]
    closed = spans.where("stop is not null and start < stop").withColumn("_bucket", F.explode(F.sequence(bucket("start"), bucket("stop"))))
    still = spans.where("stop is null").drop("stop")
    kept = [c for c in spans.columns if c not in (*on, "start", "stop")]
    found = items.withColumn("_bucket", bucket(at)).join(closed.withColumnsRenamed({c: f"_s_{c}" for c in here}), F.expr(
        " AND ".join([*[f"{c} = _s_{c}" for c in here], f"{at} >= start", f"{at} < stop"])), "left"
    ).drop("_bucket", "start", "stop", *[f"_s_{c}" for c in here])
    renamed = still.withColumnsRenamed({c: f"_o_{c}" for c in [*on, *kept]})
    found = found.join(renamed, F.expr(" AND ".join([*[f"{c} = _o_{c}" for c in on], f"{at} >= start"])), "left").drop("start")
    found = found.withColumns({c: F.coalesce(c, f"_o_{c}") for c in kept}).drop(*[f"_o_{c}" for c in [*on, *kept]])
    return found if how == "left" else found.where(F.col(kept[0]).isNotNull())


def subscribed_as_of(content: DataFrame, log: DataFrame, ts: str = "ts", days: int = 1) -> DataFrame:
    """Feed items that the subscriptions in force at their own time ask for, with the fields asked for then.

    As `subscribed`, but with the command log instead of its last state; see `subscription_intervals`.
    """
    keys, views = subscription_intervals(log, ts)
    kind = log.schema[ts].dataType
    items = content.withColumns({"key": F.col("content.key"), "date": F.timestamp_millis("timestamp")})
    items = items.withColumn("_time", F.col("date").cast(kind))
    found = _in_force(items, keys.select("service", "key", "seq", "born", "start", "stop", "added"), ["service", "key"], "_time", days, "inner")
    found = _in_force(found, views.select("service", "view", "start", "stop", "fields"), ["service"], "_time", days, "left")
    viewed = F.coalesce("fields", F.array().cast("array<string>"))
    fields = (
        F.when(F.coalesce(F.col("view") < F.col("born"), F.lit(True)), F.col("added"))
        .when(F.col("view") > F.col("seq"), viewed)
        .otherwise(F.array_union(viewed, F.col("added")))
    )
    found = found.withColumn("_fields", fields)
    values = [F.when(F.array_contains("_fields", i), F.col(f"content.`{i}`")).alias(name) for i, name in FIELD_NAMES.items()]
    return found.select("service", F.col("key").alias("symbol"), "date", *values)


def subscribed(content: DataFrame, state: DataFrame) -> DataFrame:
    """Feed items that a subscription state asks for, each with the fields its key asks for.

    `content` comes from `ingest.explode_content`, `state` from `subscription_state`. Items are parsed from
    text, which Spark's estimate takes for smaller than they are, so the join is hinted: items are never
    broadcast, a state only if the caller says so. Adaptive execution splits the items of a busy key. Fields
    that were not asked for are null.
    """
    items = content.withColumn("key", F.col("content.key")).hint("merge")
    kept = items.join(state, ["service", "key"])
    fields = [
        F.when(F.array_contains("fields", i), F.col(f"content.`{i}`")).alias(name) for i, name in FIELD_NAMES.items()
    ]
    return kept.select("service", F.col("key").alias("symbol"), F.timestamp_millis("timestamp").alias("date"), *fields)
