"""Studies on a stream whose results are revised when ticks come late."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.bars import _micros
from tickloom.operators.series import DEFAULT_SPLIT, Frame, Split, as_keys
from tickloom.operators.studies import Study, with_studies
from tickloom.session import scratch_dir, scratch_scope
from tickloom.sinks.store import DAY, write_store
from tickloom.streaming.run import require_batches, start_batches
from tickloom.streaming.state import StateLog, of_keys

BUCKET, NEW, CHANGED = "_bucket", "_new", "_changed"


class RevisedStudies:
    """Windowed studies over all ticks so far, whatever their order of arrival.

    Every batch adds to three folders below `path`: `history`, the ticks by day; `index`, how many each
    symbol has in each stretch of `step` (see `StateLog`); and `results`, an upsert log in which a row's
    newest version, the batch, counts. A new tick changes its own result and those of as many rows after
    it as the studies look back. The index tells which stretches hold these rows and the ones before them
    that they need; only those are read again, studied, and of the results only the changed ones written.
    A batch without late ticks so reads the last stretches of its symbols. A repeated batch reads what
    the batches before it wrote and replaces its own. (keys, order) must be unique; exponential studies,
    where a late tick changes all later results, are refused.
    """

    def __init__(
        self,
        studies: Sequence[Study],
        path: str,
        keys: str | Sequence[str] = "symbol",
        order: Sequence[str] = ("ts", "seq"),
        step: str = "1 hour",
        split: Split = DEFAULT_SPLIT,
        full_every: int = 32,
    ):
        if any(study.seeds for study in studies):
            raise ValueError("exponential studies reach all rows: use carry_studies")
        self.studies, self.path, self.keys, self.order, self.split = list(studies), path, as_keys(keys), list(order), split
        self.size, self.reach = _micros(step), sum(study.look_back for study in studies)
        self.index = StateLog(f"{path}/index", [*self.keys, BUCKET], full_every)

    def _bucket(self):
        return F.floor(F.unix_micros(F.col(self.order[0]).cast("timestamp")) / self.size)

    def _stretches(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The index rows of the batch's symbols that it adds to (`added`) or that must be read again."""
        added = batch.groupBy(*self.keys, BUCKET).agg(F.count(F.lit(1)).alias("n")).withColumn("added", F.lit(True))
        before = self.index.before(batch.sparkSession, self._index_schema(batch), batch_id)
        both = added
        if before is not None:
            both = added.unionByName(of_keys(before, batch, self.keys, "left_semi").withColumn("added", F.lit(False)))
        index = both.groupBy(*self.keys, BUCKET).agg(F.sum("n").alias("n"), F.max("added").alias("added"))
        in_time = Window.partitionBy(*self.keys).orderBy(BUCKET)
        back = Window.partitionBy(*self.keys).orderBy(F.desc_nulls_last(BUCKET))
        end = F.sum("n").over(in_time.rowsBetween(Window.unboundedPreceding, 0))
        placed = index.withColumn("end", end).withColumn("begin", F.col("end") - F.col("n"))
        last = F.max(F.when(F.col("added"), F.col("end"))).over(in_time.rowsBetween(Window.unboundedPreceding, -1))
        following = F.min(F.when(F.col("added"), F.col("begin"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
        near = F.coalesce(F.col("begin") - last < self.reach, F.lit(False)) | (following - F.col("end") < self.reach)
        needed = placed.withColumn("near", F.coalesce(near, F.lit(False))).where("added OR near")
        return needed.select(*self.keys, BUCKET, "n", "added")

    def _index_schema(self, batch: DataFrame) -> T.StructType:
        return T.StructType([*[batch.schema[k] for k in self.keys], T.StructField(BUCKET, T.LongType()), T.StructField("n", T.LongType())])

    def _history(self, batch: DataFrame, needed: DataFrame, days: list, batch_id: int) -> DataFrame:
        own = [f for f in batch.schema.fields if f.name not in (BUCKET, NEW)]
        schema = T.StructType([*own, T.StructField(DAY, T.DateType()), T.StructField("batch_id", T.LongType())])
        known = batch.sparkSession.read.schema(schema).parquet(f"{self.path}/history")
        known = known.where((F.col("batch_id") < batch_id) & (F.col(DAY).isin(days) | F.col(DAY).isNull()))
        known = known.drop("batch_id", DAY).withColumns({BUCKET: self._bucket(), NEW: F.lit(False)})
        return of_keys(known, needed, [*self.keys, BUCKET], "left_semi")

    def receive(self, batch: DataFrame, batch_id: int) -> None:
        """For `foreachBatch`, with `skip_empty=False`."""
        plain = batch.columns
        rows = batch.withColumns({BUCKET: self._bucket(), NEW: F.lit(True)}).persist()
        needed = self._stretches(rows, batch_id).persist()
        try:
            with scratch_scope():
                # The days of the stretches, and so many rows at most.
                first, last = (F.to_date(F.timestamp_micros((F.col(BUCKET) + k) * self.size)) for k in (0, 1))
                found = needed.agg(F.sum("n").alias("n"), F.flatten(F.collect_set(F.sequence(first, last))).alias("days")).first()
                again = rows
                if batch_id > 0:
                    again = rows.unionByName(self._history(rows, needed, list(set(found["days"])), batch_id))
                studies = [*self.studies, self._changed()]
                studied = with_studies(again, studies, self.keys, self.order, self.split, found["n"] or 0)
                added = [c for c in studied.columns if c not in (*rows.columns, CHANGED)]
                results = studied.where(CHANGED).select(*plain, *added)
                results.write.mode("overwrite").parquet(f"{self.path}/results/batch_id={batch_id}")
                write_store(rows.select(*plain), f"{self.path}/history/batch_id={batch_id}", self.order[0], self.keys[0], mode="overwrite")
                self.index.write(needed.where("added").select(*self._index_schema(rows).names), batch_id)
        finally:
            needed.unpersist()
            rows.unpersist()

    def _changed(self) -> Study:
        def add(df: DataFrame, frame: Frame) -> DataFrame:
            return df.selectExpr("*", f"max({NEW}) OVER ({frame} ROWS BETWEEN {self.reach} PRECEDING AND CURRENT ROW) AS {CHANGED}")

        return Study(self.reach, add)

    def latest(self, spark: SparkSession) -> DataFrame:
        """The newest version of every result."""
        log = spark.read.parquet(f"{self.path}/results")
        names = [*self.keys, *self.order]
        rest = [c for c in log.columns if c not in (*names, "batch_id")]
        newest = log.groupBy(*names).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
        return newest.select(*[F.col(c) if c in names else F.col(f"_row.`{c}`").alias(c) for c in log.columns if c != "batch_id"])


def revised_over_available(
    spark: SparkSession, ticks: DataFrame, studies: Sequence[Study], label: str, least_batches: int = 1, **options
) -> DataFrame:
    """Run studies over what a stream holds now, in whatever order, and return the newest results."""
    path = scratch_dir(spark, label)
    revised = RevisedStudies(studies, path, **options)
    query = start_batches(ticks, revised.receive, path + "/checkpoint", trigger={"availableNow": True}, skip_empty=False)
    query.awaitTermination()
    require_batches(query, least_batches)
    return revised.latest(spark)
