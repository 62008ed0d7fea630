"""One write of parsed messages, from which both the usable and the rejected ones are read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ingest import REASON, feed_outcomes
from tickloom.schema import TICK_COLUMNS

OUTCOME = "outcome"


@dataclass(frozen=True)
class Written:
    """A split written to `path`, and how many rows of each outcome it has."""

    path: str
    accepted_rows: int
    rejected_rows: int

    def _read(self, spark: SparkSession, outcome: str) -> DataFrame:
        return spark.read.parquet(self.path).where(F.col(OUTCOME) == outcome)

    def accepted(self, spark: SparkSession) -> DataFrame:
        """The usable rows; the other folder is not read."""
        return self._read(spark, "accepted").drop(OUTCOME, REASON, "text")

    def rejected(self, spark: SparkSession) -> DataFrame:
        """(reject_reason, text) of the others."""
        return self._read(spark, "rejected").select(REASON, "text")


def write_split(parsed: DataFrame, path: str) -> Written:
    """Writes rows with a `reject_reason` into one folder per outcome, in one pass over the source.

    The counts are observed while the rows pass, so they cost no other pass. An earlier split in the
    same place is replaced.
    """
    seen = Observation()
    outcome = F.when(F.col(REASON).isNull(), "accepted").otherwise("rejected")
    counted = parsed.withColumn(OUTCOME, outcome).observe(
        seen, F.count_if(F.col(REASON).isNull()).alias("accepted"), F.count_if(F.col(REASON).isNotNull()).alias("rejected")
    )
    counted.write.mode("overwrite").partitionBy(OUTCOME).parquet(path)
    return Written(path, seen.get["accepted"], seen.get["rejected"])


def split_feed(messages: DataFrame, path: str) -> Written:
    """Raw feed messages, parsed once, into usable ticks and rejects."""
    return write_split(feed_outcomes(messages).select("service", *TICK_COLUMNS, REASON, "text"), path)


def split_feed_batches(path: str, done: Callable[[Written, int], None] | None = None) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch`: a folder per batch, which a repeated batch replaces; `done` gets the counts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        written = split_feed(batch, f"{path}/batch_id={batch_id}")
        if done is not None:
            done(written, batch_id)

    return write
