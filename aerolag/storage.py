"""Shared storage for tables written between the steps of a job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, also set for RDD checkpoints.

    Where it is unset, a local session gets a folder of its own; a cluster session
    fails, because a folder of one machine would be lost with that machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="aerolag-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


#: Folder of the job that runs, if one does.
_job: ContextVar[str | None] = ContextVar("job", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the folder of the running job, or the shared folder, that nothing else uses."""
    root = shared_root(spark)
    return f"{(_job.get() or root).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, on whatever file system it lies."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def job_folder(spark: SparkSession, name: str) -> Iterator[None]:
    """Collect all that is staged meanwhile in one folder and remove it at the end, also after an error.

    What a job returns must not read staged tables; ``held`` turns a small result into local rows.
    """
    if _job.get() is not None:
        yield
        return
    path = scratch_path(spark, name)
    token = _job.set(path)
    try:
        yield
    finally:
        _job.reset(token)
        remove(spark, path)


def held(df: DataFrame) -> DataFrame:
    """A report of a fixed, small number of rows, computed now and kept by the driver."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


#: Spark deletes the shuffle files of a query when it ends, not when the driver's memory is next collected.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete what a query shuffled as soon as it has ended; nothing reads it again once its rows are written."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a scan of it.

    This cuts the lineage: a lost executor re-reads files instead of recomputing,
    and every later pass is a column-pruned scan.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, name)
    with _shuffles_dropped(spark):
        df.write.mode("overwrite").option("maxRecordsPerFile", 0).parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def spread(rows: DataFrame) -> DataFrame:
    """Give a scan of fewer partitions than cores one partition per core.

    Small files come as one partition and would keep one core busy with all that follows.
    A table of at least as many partitions is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)
