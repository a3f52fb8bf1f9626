from __future__ import annotations

from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from aerolag import schema as S
from aerolag.__main__ import main
from aerolag.models.minutes import load_minutes
from aerolag.models.types import load_types
from aerolag.operators.encoding import frequency_encode
from aerolag.operators.tables import drop_table, export_parquet, read_export, replace_table
from aerolag.plans.delay_minutes import run_minutes
from aerolag.plans.delay_type import run_type
from aerolag.plans.run_all import JobPaths, run_all
from aerolag.sources.flights import flights_from_table
from aerolag.sources.order_flights import order_flights
from aerolag.storage import scratch_path, shared_root


@pytest.fixture(scope="module")
def flights(spark):
    path = scratch_path(spark, "flights")
    order_flights(spark, SMALL).write.parquet(path)
    return path


def job_paths(spark, name):
    return JobPaths(f"{name}_table", scratch_path(spark, "export"), scratch_path(spark, "model"))


def test_run_all_twice(spark, flights):
    minutes, types = job_paths(spark, "all_minutes"), job_paths(spark, "all_type")
    staging = scratch_path(spark, "staging")
    source = spark.read.parquet(flights)
    for run in (1, 2):
        first, second = run_all(source, minutes, types, rounds=1, staging_path=staging)
        assert first.model.runs == run
        assert first.metrics.first()["n"] > 0
        assert second.report.count() == 11
    kept = source.filter("uniquecarrier IS NOT NULL").count()

    table = spark.read.table(minutes.table)
    assert table.columns == [S.KEY, *S.MINUTES_COLUMNS] and table.count() == kept
    assert sorted(table.inputFiles()) == sorted(read_export(spark, minutes.export_path).inputFiles())

    table = spark.read.table(types.table)
    assert table.columns == ["id", S.KEY, *S.TYPE_COLUMNS]
    assert sorted(row["id"] for row in table.select("id").collect()) == list(range(1, kept + 1))
    assert load_minutes(spark, minutes.model_path).runs == 2
    assert len(load_types(spark, types.model_path).stages) == 7


def test_single_jobs_and_max_generations(spark, flights):
    minutes, types = job_paths(spark, "one_minutes"), job_paths(spark, "one_type")
    source = spark.read.parquet(flights)
    sizes = []
    for _ in range(3):
        result = run_minutes(
            source, minutes.table, minutes.export_path, minutes.model_path, rounds=1, max_generations=2
        )
        sizes.append(result.model.runs)
    assert sizes == [1, 2, 1]
    result = run_type(source, types.table, types.export_path, types.model_path, rounds=1)
    assert [row["label"] for row in result.report.orderBy("position").collect()][:7] == S.LABELS


def test_a_failed_evaluation_stores_nothing(spark, flights, monkeypatch):
    from aerolag.plans import delay_minutes

    def fail(*_):
        raise RuntimeError("no metrics")

    monkeypatch.setattr(delay_minutes, "regression_metrics", fail)
    minutes = job_paths(spark, "failing")
    with pytest.raises(RuntimeError):
        run_minutes(spark.read.parquet(flights), minutes.table, minutes.export_path, minutes.model_path, rounds=1)
    assert load_minutes(spark, minutes.model_path) is None


def test_command_line(spark, flights, capsys):
    export, model = scratch_path(spark, "export"), scratch_path(spark, "model")
    main(["minutes", "--flights-parquet", flights, "--minutes-table", "cli_minutes",
          "--minutes-export", export, "--minutes-model", model, "--rounds", "1"])
    assert "rmse" in capsys.readouterr().out
    assert load_minutes(spark, model).runs == 1
    with pytest.raises(SystemExit):
        main(["type", "--flights-parquet", flights])
    with pytest.raises(SystemExit, match="jdbc"):
        main(["type", "--jdbc-url", "jdbc:warehouse", "--type-export", export, "--type-model", model])


def test_tables(spark):
    path = scratch_path(spark, "table")
    one, two = spark.range(3).toDF("v"), spark.range(5).toDF("w")
    drop_table(spark, "refreshed")
    assert replace_table(one, "refreshed").count() == 3
    assert replace_table(two, "refreshed").columns == ["w"]
    assert replace_table(one, "refreshed", path).count() == 3
    assert replace_table(two, "refreshed", path).count() == 5
    assert read_export(spark, path).count() == 5
    drop_table(spark, "refreshed")
    assert not spark.catalog.tableExists("refreshed")


def test_a_table_made_from_its_old_rows(spark):
    path = scratch_path(spark, "table")
    replace_table(spark.range(6).toDF("v"), "own_input", path)
    replace_table(spark.read.table("own_input").filter("v > 0"), "own_input", path)
    replace_table(read_export(spark, path).filter("v > 1"), "own_input", path)
    assert sorted(row.v for row in spark.read.table("own_input").collect()) == [2, 3, 4, 5]
    drop_table(spark, "own_input")


def test_counts_and_rows_come_from_one_state_of_a_table(spark, flights):
    replace_table(spark.read.parquet(flights), "growing_source")
    before = flights_from_table(spark, "growing_source")
    rows = before.count()
    spark.read.parquet(flights).withColumn("uniquecarrier", F.lit("NEW")).write.insertInto("growing_source")
    encoded = frequency_encode(before, "uniquecarrier", "share")
    shares = {row["uniquecarrier"]: row["share"] for row in encoded.select("uniquecarrier", "share").distinct().collect()}
    counts = {row["uniquecarrier"]: row["count"] for row in before.groupBy("uniquecarrier").count().collect()}
    assert shares == {carrier: n / rows for carrier, n in counts.items() if carrier is not None}
    assert "NEW" not in shares and spark.read.table("growing_source").count() == 2 * rows
    drop_table(spark, "growing_source")


def staged(spark):
    """What lies in the shared folder, but for Spark's own checkpoint folders."""
    return {path.name for path in Path(shared_root(spark)).iterdir() if "-" in path.name and not path.name[:8].isalnum()}


def test_jobs_leave_nothing_staged(spark, flights):
    source = spark.read.parquet(flights)
    minutes, types = job_paths(spark, "clean_minutes"), job_paths(spark, "clean_type")
    before = staged(spark)
    run_minutes(source, minutes.table, minutes.export_path, minutes.model_path, rounds=1)
    run_type(source, types.table, types.export_path, types.model_path, rounds=1)
    own = {Path(path).name for job in (minutes, types) for path in (job.export_path, job.model_path)}
    assert staged(spark) - before - own == set()


def test_export_leaves_no_old_files(spark):
    path = scratch_path(spark, "export")
    export_parquet(spark.range(0, 100, 1, 8), path)
    export_parquet(spark.range(0, 10, 1, 2), path)
    assert read_export(spark, path, spark.range(1).schema).count() == 10


def test_shared_folder(spark, monkeypatch):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


class _Session:
    """A session with no checkpoint folder, as far as ``shared_root`` looks."""

    def __init__(self, master):
        self.conf, self.sparkContext, self.master, self.folder = {}, self, master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_no_shared_folder():
    local = _Session("local[2]")
    root = shared_root(local)
    assert local.folder == root == shared_root(local)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(_Session("yarn"))
