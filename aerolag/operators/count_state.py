"""Value counts of a growing Parquet directory, kept between runs.

The state has a row per file and value. A run counts only files it has not seen with their size and time;
files that are gone or were replaced leave the state with all their rows. The state is an export, replaced whole
by a commit, so a run that dies leaves the old one in force, and of two runs at once one is refused.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.commits import latest
from aerolag.operators.tables import export_parquet, read_export
from aerolag.sources.snapshot import snapshot
from aerolag.storage import stage

#: New files that are read by name; beyond, the directory is scanned for the one column and others are left out.
NAMED_FILES = 1000


@dataclass(frozen=True)
class KeptCounts:
    """``counts`` (the column, ``out``) of all files, and what this run did: files counted, files let go."""

    counts: DataFrame
    counted: int
    dropped: int


def _plain_names(spark: SparkSession, files: DataFrame) -> list[str] | None:
    """Paths of ``files`` as the reader takes them; None if there are too many, or one reads as a pattern."""
    rows = files.select("file").limit(NAMED_FILES + 1).collect()
    jvm = spark.sparkContext._jvm
    names = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row["file"])).toString() for row in rows]
    return None if len(names) > NAMED_FILES or any(set(name) & set("*?[]{}") for name in names) else names


def _of_files(spark: SparkSession, path: str, column: str, new: DataFrame, all_new: bool) -> DataFrame:
    """Rows per file and value of the files ``new``."""
    names = None if all_new else _plain_names(spark, new)
    rows = spark.read.parquet(*names) if names else spark.read.option("recursiveFileLookup", "true").parquet(path)
    values = rows.select(F.col("_metadata.file_path").alias("file"), F.col(column).alias("value"))
    if not names and not all_new:
        values = values.join(new.select("file"), "file", "left_semi")
    return values.groupBy("file", "value").agg(F.count("*").alias("n"))


def update_counts(spark: SparkSession, path: str, column: str, state_path: str, out: str) -> KeptCounts:
    """Bring the state at ``state_path`` up to date with the files below ``path`` and return all counts.

    NULL is a value of its own. The counts equal those of the whole directory; what is read are the new files. A
    file that changes while it is counted is a ``SourceChanged`` error, and the state stays as it was.
    """
    now = snapshot(spark, path)
    base = latest(spark, state_path)
    names = ["file", "size", "modified"]
    if base is None:
        kept, new, dropped = None, now.files, 0
    else:
        old = read_export(spark, state_path)
        known = stage(old.select(*names).distinct(), "files-counted")
        new = stage(now.files.join(known, names, "left_anti"), "files-new")
        gone = stage(known.join(now.files, names, "left_anti"), "files-gone")
        dropped = gone.count()
        kept = old.join(gone, names, "left_anti") if dropped else old
    count = new.count()
    if not count and not dropped and kept is not None:
        state = kept
    else:
        if count:
            counted = _of_files(spark, path, column, new, base is None)
            # A file without rows stays in the state too, or it would be new in every run.
            fresh = new.join(counted, "file", "left").select(*names, "value", F.coalesce("n", F.lit(0)).alias("n"))
            written = fresh if kept is None else kept.select(*names, "value", "n").unionByName(fresh)
        else:
            written = kept
        written = stage(written, "count-state")
        now.check()
        export_parquet(written, state_path, -1 if base is None else base.version)
        state = written
    counts = state.groupBy("value").agg(F.sum("n").alias(out)).filter(F.col(out) > 0)
    return KeptCounts(counts.withColumnRenamed("value", column), count, dropped)
