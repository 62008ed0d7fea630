"""Any study on a stream, by carrying each symbol's last rows from batch to batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.scan import OLD, SEED
from tickloom.operators.select import last_rows
from tickloom.operators.series import DEFAULT_SPLIT, Split, as_keys
from tickloom.operators.studies import Study, with_studies
from tickloom.session import scratch_dir, scratch_scope
from tickloom.sinks.tables import write_parquet
from tickloom.streaming.run import require_batches, start_batches
from tickloom.streaming.state import NEW, TURN, StateLog, in_turn, of_keys

SEED_TYPES = {"double": T.DoubleType(), "bigint": T.LongType()}


def carry_studies(
    studies: Sequence[Study],
    tail_path: str,
    write: Callable[[DataFrame, int], None],
    keys: str | Sequence[str] = "symbol",
    order: Sequence[str] = ("ts", "seq"),
    split: Split = DEFAULT_SPLIT,
    full_every: int = 32,
) -> Callable[[DataFrame, int], None]:
    """For `foreachBatch` (with `skip_empty=False`): studies over a batch and the rows before it.

    What a symbol carries lies in the shared folder `tail_path` (see `StateLog`): the last rows that the
    windows of the studies reach, and of exponential studies one row with the means after it, however many
    rows they have seen. Symbols are cut as in the batch form, so a busy symbol is not one task's work; a
    batch with too few rows to cut is not counted again. Scratch data of a batch is deleted with it.

    Rows that come late are studied among the carried rows by their time, or after them if a study is
    exponential; results that were written before are not revised (see `streaming.revised` for that).
    """
    names, order = as_keys(keys), list(order)
    seeds = {f"{SEED}{name}": kind for study in studies for name, kind in study.seeds.items()}
    carried = max(sum(study.look_back for study in studies), 1 if seeds else 0)
    log = StateLog(tail_path, names, full_every)

    def handle(batch: DataFrame, batch_id: int) -> None:
        plain = [f"`{c}`" for c in batch.columns]
        kept = T.StructType([*batch.schema.fields, *[T.StructField(c, SEED_TYPES[kind]) for c, kind in seeds.items()]])
        rows = batch.withColumns({OLD: F.lit(False), **{c: F.lit(None).cast(kind) for c, kind in seeds.items()}})
        before = log.before(batch.sparkSession, kept, batch_id)
        if before is not None:
            rows = rows.unionByName(of_keys(before, batch, names, "left_semi").withColumn(OLD, F.lit(True)))
        # Counted and studied, then written and cut to the tail: each is computed once.
        rows.persist()
        studied = None
        try:
            with scratch_scope():
                most = rows.count()
                turn = order
                if seeds:
                    rows_in_turn, turn = in_turn(rows, names, order[0], most <= split.rows), [TURN, NEW, *order]
                else:
                    rows_in_turn = rows
                studied = with_studies(rows_in_turn, studies, keys, turn, split, most).persist()
                # Most of its partitions are empty where symbols are few; the kept rows are read by a task per core.
                dealt = studied.coalesce(batch.sparkSession.sparkContext.defaultParallelism)
                write(dealt.where(~F.col(OLD)).drop(OLD, NEW, TURN, *seeds), batch_id)
                if not carried:
                    return
                tail = last_rows(dealt, carried, keys, turn)
                if seeds and carried > 1:
                    place = F.row_number().over(Window.partitionBy(*names).orderBy(*[F.col(c).desc() for c in turn]))
                    tail = tail.withColumn("_place", place).withColumns({c: F.when(F.col("_place") == 1, F.col(c)) for c in seeds})
                log.write(tail.selectExpr(*plain, *[f"`{c}`" for c in seeds]), batch_id)
        finally:
            for held in (studied, rows):
                if held is not None:
                    held.unpersist()

    return handle


def studies_over_available(
    spark: SparkSession, ticks: DataFrame, studies: Sequence[Study], label: str, least_batches: int = 1, **options
) -> DataFrame:
    """Run studies over what a stream holds now and return the results as a table."""
    path = scratch_dir(spark, label)
    receiver = carry_studies(studies, path + "/tail", write_parquet(path + "/out"), **options)
    query = start_batches(
        ticks, receiver, path + "/checkpoint", trigger={"availableNow": True}, skip_empty=False
    )
    query.awaitTermination()
    require_batches(query, least_batches)
    return spark.read.parquet(path + "/out").drop("batch_id")
