"""Job: predict total delay in minutes, going on from the stored model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from aerolag.models.assembly import ROUNDS
from aerolag.models.minutes import MinutesModel, fit_minutes, load_minutes, save_minutes, score_minutes
from aerolag.operators.metrics import regression_metrics
from aerolag.operators.rows import drop_incomplete, observe_incomplete
from aerolag.operators.split import hash_split
from aerolag.operators.tables import read_export, replace_table
from aerolag.plans.features import feature_frame, minutes_table, minutes_target
from aerolag.plans.run_log import log_run
from aerolag.sources.snapshot import Snapshot
from aerolag.storage import held, job_folder


@dataclass(frozen=True)
class MinutesResult:
    """The stored model, its metrics on the test rows, and the rows of the table left out for missing values."""

    model: MinutesModel
    metrics: DataFrame
    incomplete: DataFrame


def run_minutes(
    flights: DataFrame,
    table: str,
    export_path: str,
    model_path: str,
    rounds: int = ROUNDS,
    max_generations: int | None = None,
    partitions: int | None = None,
    source: Snapshot | None = None,
    counts: DataFrame | None = None,
) -> MinutesResult:
    """Rebuild the table, train, evaluate, store the model.

    With ``source``, the files of the flights, a file that changes before the table is written is an error that
    leaves the old table. ``counts`` (uniquecarrier, _n), if they are kept elsewhere, spare a pass.
    """
    with job_folder(flights.sparkSession, "minutes-job"):
        frame = feature_frame(flights, counts)
        return minutes_from_frame(
            frame, table, export_path, model_path, rounds, max_generations, partitions, source
        )


def minutes_from_frame(
    frame: DataFrame,
    table: str,
    export_path: str,
    model_path: str,
    rounds: int = ROUNDS,
    max_generations: int | None = None,
    partitions: int | None = None,
    source: Snapshot | None = None,
) -> MinutesResult:
    """The job from a feature frame on.

    The table's files are the export, and training reads them back. The model is stored
    only after the evaluation has run. A model of ``max_generations`` runs already is not
    continued; training starts anew.
    """
    spark = frame.sparkSession
    columns, incomplete = observe_incomplete(minutes_table(frame))
    replace_table(columns, table, export_path, source and source.check)
    exported = read_export(spark, export_path, columns.schema)
    train, test = hash_split(minutes_target(drop_incomplete(exported)))

    prior = load_minutes(spark, model_path)
    if prior is not None and max_generations is not None and prior.runs >= max_generations:
        prior = None
    model = fit_minutes(train, prior, rounds=rounds, partitions=partitions)
    scored = score_minutes(model, test)
    metrics = held(regression_metrics(scored, "total_delay", "prediction"))
    stored = save_minutes(spark, model, model_path)
    log_run(metrics, model_path, "minutes", stored.version, stored.folder, source and source.identity())
    return MinutesResult(stored, metrics, incomplete.report(spark))
