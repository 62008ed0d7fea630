"""Time-series points: line protocol text, written by executors."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.columns import line_protocol

BAR_FIELDS = ("open", "high", "low", "close", "volume")
BAR_TAGS = {"stock": "symbol"}


def to_points(
    bars: DataFrame,
    measurement: str,
    fields: Sequence[str] = BAR_FIELDS,
    tags: Mapping[str, str] = BAR_TAGS,
    time: str = "date",
) -> DataFrame:
    """(measurement, tags, fields, time). `tags` maps tag names to columns; the time is no tag."""
    pairs = [part for f in fields for part in (F.lit(f), F.col(f).cast("double"))]
    return bars.select(
        F.lit(measurement).alias("measurement"),
        F.create_map(*[part for k, c in tags.items() for part in (F.lit(k), F.col(c).cast("string"))]).alias("tags"),
        F.create_map(*pairs).alias("fields"),
        F.col(time).alias("time"),
    )


def to_lines(
    bars: DataFrame,
    measurement: str,
    fields: Sequence[str] = BAR_FIELDS,
    tags: Mapping[str, str] = BAR_TAGS,
    time: str = "date",
) -> DataFrame:
    """One line-protocol text per bar in column `line`; `lines_rejects` has the bars that give none.

    Those are left out before the text is made: a filter on the text would make it twice.
    """
    line = line_protocol(measurement, {k: F.col(c) for k, c in tags.items()}, {f: F.col(f) for f in fields}, F.col(time))
    written = _reason(fields, time).isNull() & F.col(time).cast("timestamp").isNotNull()
    return bars.where(written).select(line.alias("line"))


def _reason(fields: Sequence[str], time: str) -> Column:
    """Why a bar gives no line; null when it does."""
    value = F.coalesce(*[F.when(F.abs(F.col(f).cast("double")) < float("inf"), F.col(f).cast("double")) for f in fields])
    return F.when(F.col(time).isNull(), "no_time").when(value.isNull(), "no_value")


def lines_rejects(bars: DataFrame, fields: Sequence[str] = BAR_FIELDS, time: str = "date") -> DataFrame:
    """The bars that give no line, with `reject_reason`: they have no time, or no field with a finite value."""
    return bars.withColumn("reject_reason", _reason(fields, time)).where(F.col("reject_reason").isNotNull())


def write_lines(path: str, measurement: str, **columns) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: text files per micro-batch. A repeated batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        to_lines(batch, measurement, **columns).write.mode("overwrite").text(f"{path}/batch_id={batch_id}")

    return write


def send_lines(
    send: Callable[[Iterable[str]], None], measurement: str, lines_per_call: int = 5000, **columns
) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: call `send` on executors with lists of lines, e.g. an HTTP bulk write.

    A point with the same series and time replaces itself in a time-series database, so a
    retried task does no harm.
    """

    def send_partition(rows) -> None:
        pending: list[str] = []
        for row in rows:
            pending.append(row.line)
            if len(pending) >= lines_per_call:
                send(pending)
                pending = []
        if pending:
            send(pending)

    def write(batch: DataFrame, batch_id: int) -> None:
        to_lines(batch, measurement, **columns).foreachPartition(send_partition)

    return write
