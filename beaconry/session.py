"""Session settings, the shared scratch folder, and pinned intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_FALLBACK: dict[str, tempfile.TemporaryDirectory] = {}


def get_session(app: str = "beaconry", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution and skew handling on.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the
    submitter's settings win and AQE coalesces small shuffle partitions.
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")
         .config("spark.ui.enabled", "false"))
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only in local mode, where that may be unset, a temporary folder is made,
    once per application and until the process ends; on a cluster a missing
    setting is an error.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        if sc.applicationId not in _FALLBACK:
            _FALLBACK[sc.applicationId] = tempfile.TemporaryDirectory(prefix="beaconry-", ignore_cleanup_errors=True)
        base = _FALLBACK[sc.applicationId].name
    return base.rstrip("/")


_SCOPE: ContextVar[str] = ContextVar("scope", default="")


@contextmanager
def scratch(spark: SparkSession):
    """What is pinned inside lies in a folder of its own, which is deleted at the end."""
    name = f"scope-{uuid.uuid4().hex}"
    before = _SCOPE.set(f"{_SCOPE.get()}{name}/")
    try:
        yield
    finally:
        _SCOPE.reset(before)
        delete_folder(spark, f"{scratch_dir(spark)}/beaconry/{_SCOPE.get()}{name}")


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Shuffle files go when the query that wrote them ends, for jobs that store every step and never read one twice.

    Without it they stay until the driver collects its garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def streamed_writes(spark: SparkSession):
    """Rows go to their partition folders as they come, without a sort that holds a task's rows in memory.

    A task keeps a file open for each folder it meets, a hundred at most; only the rows of further folders are sorted.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, "100")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def small_batches(spark: SparkSession, megabytes: int = 4):
    """Rows go to Python in batches of so many bytes, however wide they are; a wider row goes alone.

    Spark's own bounds, 10,000 rows and 64 MB, are held several times for each task: while a batch is written, by the process that
    reads it, and once more as Python's own values. What is stored inside is made so; a lazy frame that leaves is not.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(megabytes << 20))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a fresh sub-folder of the scratch folder (not created)."""
    return f"{scratch_dir(spark)}/beaconry/{_SCOPE.get()}{os.path.basename(label)}-{uuid.uuid4().hex}"


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the scratch folder and read it back.

    Used for dimensions: it cuts the lineage in a way that survives the loss of
    executors, and the file sizes tell Catalyst how big the table really is, so
    the choice between a broadcast and a shuffled join needs no hint.
    """
    return pin_at(df, new_folder(df.sparkSession, label))


def pin_at(df: DataFrame, path: str) -> DataFrame:
    """:func:`pin` to a given new folder, for a table that has to outlive the scope it is made in."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of pinned rows that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
