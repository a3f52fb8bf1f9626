"""A log of all runs beside the model: what was trained on, which version came of it, and every metric."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag.operators.split import SEED, TEST_PERCENT

LOG = (
    "job string, version long, finished timestamp, folder string, split_seed int, test_percent int,"
    " source_files long, source_bytes long, source_digest string, position int, label string, metric string, value double"
)
#: Columns of a report that name its lines.
_NAMES = ("position", "label")


def metric_lines(report: DataFrame) -> DataFrame:
    """A report in long form: position, label, metric, value. A report of one row has no labels."""
    numbers = [name for name in report.columns if name not in _NAMES]
    position = F.col("position") if "position" in report.columns else F.lit(0)
    label = F.col("label") if "label" in report.columns else F.lit(None).cast("string")
    lines = [F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value")) for name in numbers]
    return report.select(position.cast("int").alias("position"), label.alias("label"), F.inline(F.array(*lines)))


def log_run(
    report: DataFrame, path: str, job: str, version: int, folder: str, source: dict | None = None
) -> None:
    """Add the lines of ``report`` to the log at ``path``, as files of their own.

    A version is logged once: writing it again after a failure replaces what was there. ``source`` is the identity of
    the input's snapshot.
    """
    about = source or {}
    lines = metric_lines(report).select(
        F.lit(job).alias("job"),
        F.lit(version).cast("long").alias("version"),
        F.lit(datetime.now(timezone.utc)).cast("timestamp").alias("finished"),
        F.lit(folder).alias("folder"),
        F.lit(SEED).alias("split_seed"),
        F.lit(TEST_PERCENT).alias("test_percent"),
        F.lit(about.get("files")).cast("long").alias("source_files"),
        F.lit(about.get("bytes")).cast("long").alias("source_bytes"),
        F.lit(about.get("digest")).cast("string").alias("source_digest"),
        "position",
        "label",
        "metric",
        "value",
    )
    lines.coalesce(1).write.mode("overwrite").parquet(f"{path}/run_log/{job}-{version:010d}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All lines of all runs at ``path``."""
    return spark.read.schema(LOG).option("recursiveFileLookup", "true").parquet(f"{path}/run_log")


def compare_runs(log: DataFrame, before: int, after: int) -> DataFrame:
    """Per metric line of two versions: value before, value after, change, and whether the input was the same."""
    keys = ["job", "position", "label", "metric"]
    sides = [
        log.filter(F.col("version") == version).select(
            *keys, F.col("value").alias(name), F.col("source_digest").alias(f"{name}_digest")
        )
        for version, name in ((before, "before"), (after, "after"))
    ]
    one, other = sides[0].alias("one"), sides[1].alias("other")
    same_line = [F.col(f"one.{key}").eqNullSafe(F.col(f"other.{key}")) for key in keys]
    joined = one.join(other, same_line, "full")
    return joined.select(
        *[F.coalesce(F.col(f"one.{key}"), F.col(f"other.{key}")).alias(key) for key in keys],
        "before",
        "after",
        (F.col("after") - F.col("before")).alias("change"),
        F.col("before_digest").eqNullSafe(F.col("after_digest")).alias("same_source"),
    )

