"""State that a stream carries from batch to batch as tables in a shared folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.scan import OLD
from tickloom.operators.series import as_keys
from tickloom.session import delete_folder

BATCH = "_batch"
# Columns that order a batch so that late rows come after the carried ones.
TURN, NEW = "_turn", "_new"


def matches(names: Sequence[str], prefix: str) -> str:
    return " AND ".join(f"`{k}` <=> `{prefix}{k}`" for k in names)


def of_keys(rows: DataFrame, others: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """The rows whose keys `others` has ('left_semi') or lacks ('left_anti'); nulls are values.

    Each key is moved once, however many rows of `others` have it.
    """
    known = others.select(*[F.col(k).alias(f"_k_{k}") for k in names]).distinct()
    return rows.join(known, F.expr(matches(names, "_k_")), how)


def in_turn(rows: DataFrame, names: Sequence[str], time: str, few: bool) -> DataFrame:
    """Rows with their place: those no later than the newest carried one of their symbol come right after it.

    `few` rows are compared within their symbol, which costs no shuffle of its own; more by a join.
    """
    at = F.col(time)
    if few:
        rows = rows.withColumn("_newest", F.max(F.when(F.col(OLD), at)).over(Window.partitionBy(*names)))
    else:
        known = rows.where(OLD).groupBy(*[F.col(k).alias(f"_k_{k}") for k in names]).agg(F.max(at).alias("_newest"))
        rows = rows.join(known, F.expr(matches(names, "_k_")), "left").drop(*[f"_k_{k}" for k in names])
    return rows.withColumns({TURN: F.greatest("_newest", at), NEW: (~F.col(OLD)).cast("int")}).drop("_newest")


class StateLog:
    """The newest rows of every key, as of any batch.

    A batch writes a folder of its own with the rows of the keys that it changed, which replace all that
    those keys had. Every `full_every` batches all keys are written, so that a reader needs no older
    folder, and folders that no batch can need any more are deleted. A repeated batch reads the same
    folders as the first time and replaces its own.
    """

    def __init__(self, path: str, keys: str | Sequence[str], full_every: int = 32):
        self.path, self.keys, self.full_every = path, as_keys(keys), full_every

    def _first(self, batch_id: int) -> int:
        return (batch_id - 1) // self.full_every * self.full_every

    def before(self, spark: SparkSession, schema: T.StructType, batch_id: int) -> DataFrame | None:
        """The rows of all keys before this batch; none before the first."""
        if batch_id <= 0:
            return None
        folders = [f"{self.path}/{i}" for i in range(self._first(batch_id), batch_id)]
        whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        known = spark.read.schema(whole).parquet(*folders)
        if len(folders) == 1:
            return known.drop(BATCH)
        newest = F.max(BATCH).over(Window.partitionBy(*self.keys))
        return known.withColumn("_newest", newest).where(f"{BATCH} = _newest").drop(BATCH, "_newest")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of the keys that this batch changed, whole."""
        if batch_id > 0 and batch_id % self.full_every == 0:
            rest = of_keys(self.before(rows.sparkSession, rows.schema, batch_id), rows, self.keys, "left_anti")
            rows = rows.unionByName(rest)
        rows.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{self.path}/{batch_id}")
        if batch_id > 0 and self._first(batch_id) == batch_id - 1:
            # The batch before wrote all keys and is not repeated any more.
            for i in range(max(0, batch_id - 1 - self.full_every), batch_id - 1):
                delete_folder(rows.sparkSession, f"{self.path}/{i}")
