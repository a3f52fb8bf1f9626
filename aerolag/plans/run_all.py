"""Both jobs on one feature frame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from aerolag.models.assembly import ROUNDS
from aerolag.models.types import PARALLEL_FITS
from aerolag.operators.rows import number_rows
from aerolag.plans.delay_minutes import MinutesResult, minutes_from_frame
from aerolag.plans.delay_type import TypeResult, type_from_numbered
from aerolag.plans.features import feature_frame
from aerolag.sources.snapshot import Snapshot
from aerolag.storage import job_folder, scratch_path, stage


@dataclass(frozen=True)
class JobPaths:
    """Table, export directory and model directory of one job."""

    table: str
    export_path: str
    model_path: str


def run_all(
    flights: DataFrame,
    minutes: JobPaths,
    types: JobPaths,
    rounds: int = ROUNDS,
    max_generations: int | None = None,
    parallel_fits: int = PARALLEL_FITS,
    partitions: int | None = None,
    staging_path: str | None = None,
    source: Snapshot | None = None,
    counts: DataFrame | None = None,
) -> tuple[MinutesResult, TypeResult]:
    """Build the features once, in the job's folder or at ``staging_path``, then run both jobs.

    A daily run that passes the same ``staging_path`` replaces the previous frame. ``source`` and ``counts`` are
    those of ``run_minutes``.
    """
    spark = flights.sparkSession
    with job_folder(spark, "delay-jobs"):
        path = staging_path or scratch_path(spark, "feature-frame")
        frame = stage(feature_frame(flights, counts), "feature-frame", path)
        by_minutes = minutes_from_frame(
            frame, minutes.table, minutes.export_path, minutes.model_path, rounds, max_generations, partitions, source
        )
        numbered = number_rows(spark, path, frame.schema)
        by_type = type_from_numbered(
            numbered, types.table, types.export_path, types.model_path, rounds, parallel_fits, partitions, source
        )
        return by_minutes, by_type
