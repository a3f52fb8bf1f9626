"""The files of a Parquet directory as they were at one moment, and a check that they still are.

A job passes over its source more than once, and another job may replace files in between. The list of
files is taken before the first pass; whatever changes until the check, in name, size or time, is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.storage import stage

#: Files named in the error.
SHOWN = 3


class SourceChanged(RuntimeError):
    """A file was added, replaced or removed since the list of files was taken."""


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """The data files below ``path`` as they are now: file, size, modified. No content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


@dataclass(frozen=True)
class Snapshot:
    """A written list of the files below ``path``."""

    path: str
    files: DataFrame

    def check(self) -> None:
        """Raise ``SourceChanged`` unless the files are those of the list."""
        spark = self.files.sparkSession
        now = list_files(spark, self.path)
        # One side lacks each of these: counted with a sign, an unchanged file cancels out.
        signed = self.files.withColumn("side", F.lit(1)).unionByName(now.withColumn("side", F.lit(-1)))
        off = signed.groupBy("file", "size", "modified").agg(F.sum("side").alias("side")).filter("side <> 0")
        wrong = off.select("file").distinct().orderBy("file").limit(SHOWN).collect()
        if wrong:
            raise SourceChanged(f"changed since the job began: {', '.join(row['file'] for row in wrong)}")

    def identity(self) -> dict:
        """Number of files, their bytes and a digest that changes with any of them."""
        own = F.xxhash64("file", "size", "modified").cast("decimal(38,0)")
        row = self.files.agg(
            F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"), F.coalesce(F.sum(own), F.lit(0)).alias("sum")
        ).first()
        return {"files": row["files"], "bytes": row["bytes"], "digest": str(row["sum"])}


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """The list of files below ``path``. Take it before the directory is read for the first time."""
    return Snapshot(path, stage(list_files(spark, path), "source-files"))
