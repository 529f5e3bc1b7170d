"""Session settings and the shared workspace folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the library is tuned for. All are ordinary Spark settings; a cluster that sets
# its own values keeps them, because every transformation also works with the defaults.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even when that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Added away from a local master, where the number of shuffle partitions has to follow the
# data: many small ones to begin with, merged by adaptive execution to the advisory size.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(app: str = "flowtables", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the recommended settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    local = master is not None and master.startswith("local")
    for key, value in {**RECOMMENDED_CONF, **({} if local else CLUSTER_CONF)}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_LOCAL_FOLDERS: dict[str, str] = {}
_SCOPE: ContextVar[str | None] = ContextVar("scratch_scope", default=None)


def workspace(spark: SparkSession) -> str:
    """Shared folder for staged data: the one the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only by a local master, where it is visible to every task.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="flowtables-")
    return _LOCAL_FOLDERS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the workspace; nothing is ever written to it twice."""
    return f"{_SCOPE.get() or f'{workspace(spark)}/flowtables'}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch paths that are taken within go at the end, whoever takes them."""
    root = scratch_path(spark, "scope")
    token = _SCOPE.set(root)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        remove_path(spark, root)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Files of a shuffle go when the query that wrote them ends, not when the driver next collects garbage.

    For work whose steps are written: no later step reads a shuffle of an earlier one.
    """
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def short_methods(spark: SparkSession) -> AbstractContextManager[None]:
    """Rows of many columns are worked on by methods short enough for the JVM to compile.

    Spark makes one method of a whole stage, and the JVM interprets a method beyond 8,000 bytes, row
    by row; within this limit Spark cuts the columns into methods of their own instead.
    """
    return _setting(spark, "spark.sql.codegen.hugeMethodLimit", "8000")


def staged(df: DataFrame, label: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` to the workspace once and return a frame reading it back.

    The copy is on shared storage, so it outlives lost executors and every later action
    sees the same rows even when the tables behind ``df`` change in between.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever storage it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Stage frames for the length of a job: ``stage(df, label)``; all copies go at its end, and shuffles as they are done with."""
    root = scratch_path(spark, "job")
    made = []

    def stage(df: DataFrame, label: str) -> DataFrame:
        made.append(f"{root}/{len(made)}-{label}")
        return staged(df, path=made[-1])

    try:
        with shuffles_removed(spark), short_methods(spark):
            yield stage
    finally:
        remove_path(spark, root)
