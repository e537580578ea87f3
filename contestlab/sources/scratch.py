"""Tables written to the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Least number of partitions of the rows that models are fitted on, and the rows
#: beyond which there are more. Neither depends on the machine, so no fit does.
FIT_PARTITIONS = 8
FIT_ROWS = 1_000_000
#: The most rows of one partition of a classifier's fit, which keeps them in memory
#: and reads them whole in every pass: a task's share does not grow with the input.
TASK_ROWS = 200_000

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_temporary: dict[str, str] = {}
_lock = threading.RLock()


class Scope:
    """A folder of scratch tables that are deleted together. Checkpoints made
    inside are deleted too."""

    def __init__(self, spark: SparkSession, folder: str, around: Scope | None):
        self.spark, self.folder, self.around = spark, folder, around
        self.checkpoints: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` outside of the scope, so that it outlasts it."""
        folder = self.around.folder if self.around else scratch_dir(self.spark)
        return _stored(df, f"{folder}/{name}-{uuid.uuid4().hex}")

    def delete(self) -> None:
        for path in (self.folder, *self.checkpoints):
            _delete(self.spark, path)


_scopes: list[Scope] = []


def _delete(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever the session's file systems have it."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode.
    Asking changes nothing in the session."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        with _lock:
            app = spark.sparkContext.applicationId
            if app not in _temporary:
                _temporary[app] = tempfile.mkdtemp(prefix="contestlab-")
            base = _temporary[app]
    return base.rstrip("/")


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[Scope]:
    """Delete at the end what was written inside: results that read scratch tables
    must have been used by then, or be kept with ``Scope.keep``. Scopes nest; the
    jobs inside may run in several threads, but scopes of one session follow one
    another."""
    with _lock:
        around = _scopes[-1] if _scopes else None
        folder = around.folder if around else scratch_dir(spark)
        scope = Scope(spark, f"{folder}/scope-{uuid.uuid4().hex}", around)
        _scopes.append(scope)
    try:
        yield scope
    finally:
        with _lock:
            _scopes.remove(scope)
        scope.delete()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, inside the scope if there is one."""
    with _lock:
        folder = _scopes[-1].folder if _scopes else scratch_dir(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def _stored(df: DataFrame, path: str, by: str | None = None) -> DataFrame:
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: later passes and lost executors
    start from the files, not from the lineage. Filters on ``by`` then read
    their own files only. Without a ``scratch_scope`` the files stay until the
    cluster cleans its folder."""
    return _stored(df, scratch_path(df.sparkSession, name), by)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files are deleted when it has ended, not when the driver
    happens to collect its garbage. For jobs that follow one another, each of which reads
    what was written before; a query started inside that runs again shuffles again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def fit_partitions(rows: int, most: int = FIT_ROWS) -> int:
    return max(FIT_PARTITIONS, -(-rows // most))


def laid_out(df: DataFrame, key: str, partitions: int = FIT_PARTITIONS) -> DataFrame:
    """Rows dealt by ``key`` to a fixed number of partitions, sorted by it, and
    stored as that: a checkpoint has a file per partition and is read back
    partition for partition. A fit that samples or stacks rows per partition then
    depends on neither the machine nor the files, and its passes shuffle nothing."""
    spark = df.sparkSession
    context = spark.sparkContext
    with _lock:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(scratch_dir(spark))
        scope = _scopes[-1] if _scopes else None
    stored = df.repartition(partitions, key).sortWithinPartitions(key).checkpoint()
    if scope is not None:
        rows = stored._jdf.queryExecution().logical().rdd()
        scope.checkpoints.append(rows.getCheckpointFile().get())
    return stored
