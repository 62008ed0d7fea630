"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(master: str | None = None, app_name: str = "tickloom", **conf: str) -> SparkSession:
    """A session with the settings below; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Feed time is UTC, so time-of-day arithmetic and casts run in UTC.

    On a cluster, shuffles start with several partitions per core unless the session says
    otherwise; adaptive execution then merges the small ones.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    context = spark.sparkContext
    if not context.master.startswith("local") and spark.conf.get(INITIAL_PARTITIONS, None) is None:
        initial = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * context.defaultParallelism)
        spark.conf.set(INITIAL_PARTITIONS, str(initial))
    return spark


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tickloom-")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name for checkpoints and tables that a job writes and reads back.

    It lies in the shared folder named by `spark.checkpoint.dir`. Only a local
    session may go without that setting; a cluster must name one, because
    executors cannot see each other's temporary folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root()
    path = os.path.join(root, f"{label}-{uuid.uuid4().hex}")
    (_scopes.open[-1] if getattr(_scopes, "open", None) else _made).append((spark, path))
    return path


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Deletes the scratch folders that this thread makes inside when it ends, also after a failure.

    For work that is repeated without end, such as the micro-batches of a stream. What reads such a
    folder has to be done by then. Scopes nest.
    """
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    made: list[tuple[SparkSession, str]] = []
    _scopes.open.append(made)
    try:
        yield
    finally:
        _scopes.open.pop()
        for spark, path in made:
            delete_folder(spark, path)


def store(df: DataFrame, label: str) -> DataFrame:
    """`df` written to a scratch folder and read back, so that it is computed once."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder with what is in it, on whatever file system it lies; a missing one is no error."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


_made: list[tuple[SparkSession, str]] = []
_scopes = threading.local()


@atexit.register
def _remove_scratch() -> None:
    """Delete the scratch folders of sessions that still run when the program ends."""
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
                delete_folder(spark, path)
        except Exception:  # the driver's Java process may be gone already
            return
