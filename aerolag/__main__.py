"""Command line: ``spark-submit run_jobs.py minutes|type|all ...``."""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from aerolag.models.assembly import ROUNDS
from aerolag.models.types import PARALLEL_FITS
from aerolag.operators.count_state import update_counts
from aerolag.plans.delay_minutes import run_minutes
from aerolag.plans.delay_type import run_type
from aerolag.plans.run_all import JobPaths, run_all
from aerolag.sources.flights import flights_from_jdbc, flights_from_parquet, flights_from_table
from aerolag.sources.snapshot import Snapshot, snapshot
from aerolag.storage import job_folder

PASSWORD_VARIABLE = "FLIGHTS_JDBC_PASSWORD"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="aerolag", description=__doc__)
    top.add_argument("job", choices=["minutes", "type", "all"])
    source = top.add_mutually_exclusive_group(required=True)
    source.add_argument("--flights-table", help="catalog table")
    source.add_argument("--flights-parquet", help="Parquet directory")
    top.add_argument("--counts-state", help="keep the carrier counts here; only new files are counted (Parquet source)")
    source.add_argument("--jdbc-url", help=f"warehouse; the password is read from ${PASSWORD_VARIABLE}")
    top.add_argument("--jdbc-table")
    top.add_argument("--jdbc-user")
    top.add_argument("--jdbc-partition-column")
    top.add_argument("--jdbc-lower", type=int)
    top.add_argument("--jdbc-upper", type=int)
    top.add_argument("--jdbc-partitions", type=int)
    top.add_argument("--key", nargs="+", help="columns of the row key, if there is no flight_key")
    for job in ("minutes", "type"):
        top.add_argument(f"--{job}-table", default=f"flight_delay_{job}")
        top.add_argument(f"--{job}-export", help="directory of the table's Parquet files")
        top.add_argument(f"--{job}-model", help="directory of the model")
    top.add_argument("--rounds", type=int, default=ROUNDS)
    top.add_argument("--max-generations", type=int)
    top.add_argument("--parallel-fits", type=int, default=PARALLEL_FITS)
    top.add_argument("--training-partitions", type=int, help="buckets to train on (default: by the number of rows)")
    top.add_argument("--staging-path", help="keep the staged features here (jobs type and all)")
    return top


@dataclass(frozen=True)
class Input:
    """The flights, and for a Parquet directory the list of its files and, if they are kept, its carrier counts."""

    flights: DataFrame
    source: Snapshot | None = None
    counts: DataFrame | None = None


def read_input(spark: SparkSession, args: argparse.Namespace) -> Input:
    if args.flights_parquet:
        source, counts = snapshot(spark, args.flights_parquet), None
        if args.counts_state:
            kept = update_counts(spark, args.flights_parquet, "uniquecarrier", args.counts_state, "_n")
            print(f"carrier counts: {kept.counted} files counted, {kept.dropped} let go")
            counts = kept.counts
        return Input(flights_from_parquet(spark, args.flights_parquet, args.key), source, counts)
    if args.counts_state:
        raise SystemExit("--counts-state needs --flights-parquet")
    if args.flights_table:
        return Input(flights_from_table(spark, args.flights_table, args.key))
    strides = (args.jdbc_partition_column, args.jdbc_lower, args.jdbc_upper, args.jdbc_partitions)
    if None in (args.jdbc_table, args.jdbc_user, *strides):
        raise SystemExit("--jdbc-url needs all other --jdbc options")
    password = os.environ.get(PASSWORD_VARIABLE, "")
    return Input(
        flights_from_jdbc(spark, args.jdbc_url, args.jdbc_table, args.jdbc_user, password, *strides, key=args.key)
    )


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"flight-delay-{args.job}").getOrCreate()
    minutes = JobPaths(args.minutes_table, args.minutes_export, args.minutes_model)
    types = JobPaths(args.type_table, args.type_export, args.type_model)
    for job, paths in (("minutes", minutes), ("type", types)):
        if args.job in (job, "all") and not (paths.export_path and paths.model_path):
            raise SystemExit(f"--{job}-export and --{job}-model are needed")
    with job_folder(spark, f"flight-delay-{args.job}"):
        run(args, read_input(spark, args), minutes, types)


def show(report: DataFrame, incomplete: DataFrame) -> None:
    report.show(truncate=False)
    incomplete.filter("incomplete > 0").orderBy("position").show(100, truncate=False)


def run(args: argparse.Namespace, given: Input, minutes: JobPaths, types: JobPaths) -> None:
    partitions, about = args.training_partitions, {"source": given.source, "counts": given.counts}
    if args.job == "minutes":
        result = run_minutes(
            given.flights, minutes.table, minutes.export_path, minutes.model_path,
            args.rounds, args.max_generations, partitions, **about,
        )
        show(result.metrics, result.incomplete)
    elif args.job == "type":
        result = run_type(
            given.flights, types.table, types.export_path, types.model_path,
            args.rounds, args.parallel_fits, partitions, args.staging_path, **about,
        )
        show(result.report.orderBy("position"), result.incomplete)
    else:
        first, second = run_all(
            given.flights, minutes, types,
            args.rounds, args.max_generations, args.parallel_fits, partitions, args.staging_path, **about,
        )
        show(first.metrics, first.incomplete)
        show(second.report.orderBy("position"), second.incomplete)


if __name__ == "__main__":
    main()
