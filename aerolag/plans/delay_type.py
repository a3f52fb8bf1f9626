"""Job: predict which of the seven kinds of delay occur."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from aerolag.models.assembly import ROUNDS
from aerolag.models.types import PARALLEL_FITS, fit_types, predicted, save_types, score_types
from aerolag.operators.metrics import multilabel_report
from aerolag.operators.rows import drop_incomplete, number_rows, observe_incomplete
from aerolag.operators.split import hash_split
from aerolag.operators.tables import read_export, replace_table
from aerolag.plans.features import feature_frame, type_table
from aerolag.plans.run_log import log_run
from aerolag.schema import KEY, LABELS, TYPE_COLUMNS
from aerolag.sources.snapshot import Snapshot
from aerolag.storage import held, job_folder, scratch_path, stage


@dataclass(frozen=True)
class TypeResult:
    """The model, its report on the test rows, the rows of the table left out for missing values, and its version."""

    model: PipelineModel
    report: DataFrame
    incomplete: DataFrame
    version: int


def run_type(
    flights: DataFrame,
    table: str,
    export_path: str,
    model_path: str,
    rounds: int = ROUNDS,
    parallel_fits: int = PARALLEL_FITS,
    partitions: int | None = None,
    staging_path: str | None = None,
    source: Snapshot | None = None,
    counts: DataFrame | None = None,
) -> TypeResult:
    """Rebuild the table, train, evaluate, store the model.

    The rows to number are written to the job's folder, or to ``staging_path`` to be kept. ``source`` and ``counts``
    are those of ``run_minutes``.
    """
    spark = flights.sparkSession
    with job_folder(spark, "type-job"):
        path = staging_path or scratch_path(spark, "type-rows")
        staged = stage(type_table(feature_frame(flights, counts)), "type-rows", path)
        numbered = number_rows(spark, path, staged.schema)
        return type_from_numbered(
            numbered, table, export_path, model_path, rounds, parallel_fits, partitions, source
        )


def type_from_numbered(
    numbered: DataFrame,
    table: str,
    export_path: str,
    model_path: str,
    rounds: int = ROUNDS,
    parallel_fits: int = PARALLEL_FITS,
    partitions: int | None = None,
    source: Snapshot | None = None,
) -> TypeResult:
    """The job from numbered feature rows on.

    The table's files are the export, and training reads them back. The model is stored
    only after the evaluation has run.
    """
    spark = numbered.sparkSession
    columns, incomplete = observe_incomplete(numbered.select("id", KEY, *TYPE_COLUMNS))
    replace_table(columns, table, export_path, source and source.check)
    exported = read_export(spark, export_path, columns.schema)
    train, test = hash_split(drop_incomplete(exported))

    model = fit_types(train, rounds=rounds, parallel_fits=parallel_fits, partitions=partitions)
    scored = score_types(model, test)
    report = held(multilabel_report(scored, LABELS, [predicted(label) for label in LABELS]))
    folder, version = save_types(spark, model, model_path)
    log_run(report, model_path, "type", version, folder, source and source.identity())
    return TypeResult(model, report, incomplete.report(spark), version)
