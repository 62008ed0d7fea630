"""Merging the many small files of a batch-written store, day by day, behind a manifest."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import delete_folder
from tickloom.sinks.store import DAY, write_store

# Rows of a compacted file, about.
FILE_ROWS = 4_000_000
MANIFEST = T.StructType().add("day", "date").add("version", "long").add("through", "long")


class CompactedStore:
    """A store written by `receive`, one folder per micro-batch, that `compact` merges by day.

    Below `path` lie `batches/batch_id=N/day=D`, `merged/version=V/day=D` and `manifest/V`. A manifest
    says for every merged day which version holds it and through which batch; it counts once its folder
    is whole, and the newest one holds. A reader takes a merged day from its version and only batches
    after that, so a batch that is repeated after it was merged is not read twice, and rows that come
    late to a merged day are read until the next merge. Nothing that a reader of an older manifest needs
    is changed; `vacuum` deletes it later.
    """

    def __init__(self, path: str, schema: T.StructType, ts: str = "ts", symbol: str = "symbol"):
        self.path, self.schema, self.ts, self.symbol = path, schema, ts, symbol

    def receive(self, batch: DataFrame, batch_id: int) -> None:
        """For `foreachBatch`: a repeated batch replaces its own folder."""
        write_store(batch, f"{self.path}/batches/batch_id={batch_id}", self.ts, self.symbol, mode="overwrite")

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        """The names in a folder; none where it does not exist."""
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        system = path.getFileSystem(context._jsc.hadoopConfiguration())
        return sorted(f.getPath().getName() for f in system.listStatus(path)) if system.exists(path) else []

    def manifest(self, spark: SparkSession) -> tuple[int, dict[date, tuple[int, int]]]:
        """(version, {day: (version that holds it, through batch)}); version 0 is the empty one."""
        for name in sorted((n for n in self._names(spark, "manifest") if n.isdigit()), key=int, reverse=True):
            if "_SUCCESS" in self._names(spark, f"manifest/{name}"):
                rows = spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/{name}").collect()
                return int(name), {r["day"]: (r["version"], r["through"]) for r in rows}
        return 0, {}

    def _batches(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.split("=")[1]) for n in self._names(spark, "batches") if n.startswith("batch_id="))

    def read(self, spark: SparkSession, first: date | None = None, last: date | None = None) -> DataFrame:
        """The rows of the days from `first` to `last`, with `day`.

        Only the folders of these days are listed: merged ones where the manifest has them, and those of
        batches after it.
        """
        _, merged = self.manifest(spark)
        wanted = {d: v for d, v in merged.items() if (first is None or d >= first) and (last is None or d <= last)}
        folders = [f"{self.path}/merged/version={v}/{DAY}={d}" for d, (v, _) in wanted.items()]
        for batch_id in self._batches(spark):
            for name in self._names(spark, f"batches/batch_id={batch_id}"):
                if not name.startswith(f"{DAY}="):
                    continue
                day = date.fromisoformat(name.split("=")[1]) if name != f"{DAY}=__HIVE_DEFAULT_PARTITION__" else None
                if day is None and (first or last) or day and (first and day < first or last and day > last):
                    continue
                if batch_id > merged.get(day, (0, -1))[1]:
                    folders.append(f"{self.path}/batches/batch_id={batch_id}/{name}")
        if not folders:
            return spark.createDataFrame([], self.schema).withColumn(DAY, F.to_date(self.ts))
        # The day is that of the rows' own time, so each folder can be read as it is.
        return spark.read.schema(self.schema).parquet(*folders).withColumn(DAY, F.to_date(self.ts))

    def compact(self, spark: SparkSession, days: Sequence[date], through: int, file_rows: int = FILE_ROWS) -> int:
        """Merges all that the store has of these days into files of about `file_rows` rows, and gives the
        version. `through` is the last batch that is complete: later ones stay as they are."""
        version, merged = self.manifest(spark)
        version = max([version, *[int(n) for n in self._names(spark, "manifest") if n.isdigit()]]) + 1
        folders = []
        for day in days:
            held, seen = merged.get(day, (0, -1))
            if held:
                folders.append(f"{self.path}/merged/version={held}/{DAY}={day}")
            for batch_id in self._batches(spark):
                if seen < batch_id <= through and f"{DAY}={day}" in self._names(spark, f"batches/batch_id={batch_id}"):
                    folders.append(f"{self.path}/batches/batch_id={batch_id}/{DAY}={day}")
            merged[day] = (version, through)
        if folders:
            rows = spark.read.schema(self.schema).parquet(*folders)
            files = max(1, -(-rows.count() // file_rows))
            order = [DAY, self.symbol, self.ts]
            placed = rows.withColumn(DAY, F.to_date(self.ts)).repartitionByRange(files, *order).sortWithinPartitions(*order)
            placed.write.mode("overwrite").partitionBy(DAY).parquet(f"{self.path}/merged/version={version}")
        for day in days:  # a day without any row has no folder to read
            if f"{DAY}={day}" not in self._names(spark, f"merged/version={version}"):
                del merged[day]
        rows = [(day, v, t) for day, (v, t) in sorted(merged.items())]
        spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/manifest/{version}")
        return version

    def closed_days(self, spark: SparkSession, before: date, through: int) -> list[date]:
        """The days before this one that have rows of complete batches which are not merged yet."""
        _, merged = self.manifest(spark)
        days = set()
        for batch_id in self._batches(spark):
            if batch_id <= through:
                names = [n for n in self._names(spark, f"batches/batch_id={batch_id}") if n.startswith(f"{DAY}=") and "HIVE" not in n]
                found = {date.fromisoformat(n.split("=")[1]) for n in names}
                days |= {d for d in found if d < before and batch_id > merged.get(d, (0, -1))[1]}
        return sorted(days)

    def vacuum(self, spark: SparkSession) -> int:
        """Deletes what the newest manifest does not need: merged days in an older version, and merged
        batches but the newest, which may be repeated. Gives the number of folders deleted."""
        version, merged = self.manifest(spark)
        gone = []
        for name in self._names(spark, "merged"):
            for day in self._names(spark, f"merged/{name}"):
                if day.startswith(f"{DAY}=") and merged[date.fromisoformat(day.split("=")[1])][0] != int(name.split("=")[1]):
                    gone.append(f"merged/{name}/{day}")
        for batch_id in self._batches(spark)[:-1]:
            days = [n for n in self._names(spark, f"batches/batch_id={batch_id}") if n.startswith(f"{DAY}=")]
            done = [n for n in days if "HIVE" not in n and batch_id <= merged.get(date.fromisoformat(n.split("=")[1]), (0, -1))[1]]
            # A batch of which nothing is left is not even listed any more.
            gone += [f"batches/batch_id={batch_id}"] if done == days else [f"batches/batch_id={batch_id}/{n}" for n in done]
        gone += [f"manifest/{n}" for n in self._names(spark, "manifest") if n.isdigit() and int(n) < version]
        for folder in gone:
            delete_folder(spark, f"{self.path}/{folder}")
        return len(gone)
