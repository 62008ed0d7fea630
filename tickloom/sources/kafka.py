"""Kafka topics as batch or streaming DataFrames.

Needs the public `spark-sql-kafka-0-10` connector on the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MAX_OFFSETS_PER_TRIGGER = 1_000_000


def kafka_options(
    servers: str, topic: str, starting: str | None = None, group: str | None = None, max_offsets: int | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting:
        options["startingOffsets"] = starting
    if group:
        options["kafka.group.id"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def stream_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str | None = None,
    group: str | None = None,
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """A topic as a stream; from the latest offsets unless `starting` says otherwise."""
    options = kafka_options(servers, topic, starting, group, max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", group: str | None = None
) -> DataFrame:
    """What a topic holds now, as a batch."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, starting, group)).load()
