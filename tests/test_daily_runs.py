"""What daily runs keep and check: counts by file, lists of files, dropped rows, ids and the run log."""

from __future__ import annotations

import random
import time
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from aerolag import schema as S
from aerolag.__main__ import main
from aerolag.commits import Conflict, history
from aerolag.models.manifest import current
from aerolag.operators import count_state
from aerolag.operators.count_state import update_counts
from aerolag.operators.encoding import value_counts
from aerolag.operators.rows import drop_incomplete, number_rows, observe_incomplete
from aerolag.operators.tables import export_parquet, read_export, replace_table
from aerolag.plans.delay_minutes import run_minutes
from aerolag.plans.run_log import compare_runs, read_log
from aerolag.sources.flights import flights_from_parquet
from aerolag.sources.order_flights import order_flights
from aerolag.sources.snapshot import SourceChanged, snapshot
from aerolag.storage import scratch_path


def put(spark, path, name, values):
    """One file of ``values``, under a name of its own or in place of an older one."""
    target = Path(path)
    target.mkdir(parents=True, exist_ok=True)
    temporary = scratch_path(spark, "one-file")
    spark.createDataFrame([(v, i) for i, v in enumerate(values)], "c string, i int").coalesce(1).write.parquet(temporary)
    (file,) = Path(temporary).glob("part-*.parquet")
    (target / f".{name}.crc").unlink(missing_ok=True)
    (target / name).write_bytes(file.read_bytes())
    time.sleep(0.02)


def counts(df):
    return {row["c"]: row["n"] for row in df.collect()}


@pytest.mark.parametrize("named", [1000, 0])
def test_kept_counts_equal_a_full_count(spark, monkeypatch, named):
    monkeypatch.setattr(count_state, "NAMED_FILES", named)
    path, state = scratch_path(spark, "source"), scratch_path(spark, "state")
    rng = random.Random(named)
    values = ["a", "b", None, "c c", "é"]
    names = [f"f {i}.parquet" for i in range(9)]
    for name in names[:5]:
        put(spark, path, name, [rng.choice(values) for _ in range(30)])
    put(spark, path, "empty.parquet", [])
    done = []
    for step in range(5):
        kept = update_counts(spark, path, "c", state, "n")
        assert counts(kept.counts) == counts(value_counts(spark.read.parquet(path), "c", "n")), step
        done.append((kept.counted, kept.dropped))
        if step == 0:
            put(spark, path, names[5], ["new"] * 7)
        elif step == 1:
            put(spark, path, names[0], ["b"] * 3)
            (Path(path) / names[1]).unlink()
        elif step == 2:
            (Path(path) / names[5]).unlink()
    assert done == [(6, 0), (1, 0), (1, 2), (0, 1), (0, 0)]
    # Nothing changed in the last run, so nothing was written.
    assert len(history(spark, state)) == 4


def test_a_file_replaced_while_it_is_counted(spark, monkeypatch):
    path, state = scratch_path(spark, "source"), scratch_path(spark, "state")
    put(spark, path, "a.parquet", ["x"] * 5)
    update_counts(spark, path, "c", state, "n")
    put(spark, path, "b.parquet", ["y"] * 5)
    real = count_state._of_files

    def replaced(*given):
        counted = spark.createDataFrame(real(*given).collect(), "file string, value string, n long")
        put(spark, path, "b.parquet", ["z"] * 9)
        return counted

    monkeypatch.setattr(count_state, "_of_files", replaced)
    with pytest.raises(SourceChanged, match="b.parquet"):
        update_counts(spark, path, "c", state, "n")
    monkeypatch.undo()
    assert counts(update_counts(spark, path, "c", state, "n").counts) == {"x": 5, "z": 9}


def test_of_two_updates_at_once_one_is_refused(spark, monkeypatch):
    path, state = scratch_path(spark, "source"), scratch_path(spark, "state")
    put(spark, path, "a.parquet", ["x"] * 5)
    real = count_state.export_parquet

    def late(df, target, base):
        monkeypatch.setattr(count_state, "export_parquet", real)
        update_counts(spark, path, "c", state, "n")
        real(df, target, base)

    monkeypatch.setattr(count_state, "export_parquet", late)
    with pytest.raises(Conflict):
        update_counts(spark, path, "c", state, "n")
    assert counts(update_counts(spark, path, "c", state, "n").counts) == {"x": 5}


def test_snapshot_sees_every_change(spark):
    path = scratch_path(spark, "source")
    for name in ("a.parquet", "b.parquet"):
        put(spark, path, name, ["x"] * 5)
    taken = snapshot(spark, path)
    taken.check()
    identity = taken.identity()
    assert identity["files"] == 2 and identity == snapshot(spark, path).identity()
    put(spark, path, "b.parquet", ["y"] * 5)
    with pytest.raises(SourceChanged, match="b.parquet"):
        taken.check()
    later = snapshot(spark, path)
    assert later.identity()["digest"] != identity["digest"]
    (Path(path) / "a.parquet").unlink()
    with pytest.raises(SourceChanged, match="a.parquet"):
        later.check()
    latest = snapshot(spark, path)
    put(spark, path, "c.parquet", ["z"])
    with pytest.raises(SourceChanged, match="c.parquet"):
        latest.check()


@pytest.fixture(scope="module")
def flights(spark):
    path = scratch_path(spark, "flights")
    order_flights(spark, SMALL).repartition(3).write.parquet(path)
    return path


def test_a_source_replaced_between_the_passes_leaves_the_old_table(spark, flights, tmp_path):
    path = str(tmp_path / "flights")
    spark.read.parquet(flights).write.parquet(path)
    export, table, model = scratch_path(spark, "export"), "source_replaced", scratch_path(spark, "model")
    run_minutes(flights_from_parquet(spark, path), table, export, model, rounds=1, source=snapshot(spark, path))
    rows = spark.read.table(table).count()

    taken = snapshot(spark, path)
    rows_now = flights_from_parquet(spark, path)
    spark.read.parquet(flights).limit(50).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(SourceChanged):
        run_minutes(rows_now, table, export, model, rounds=1, source=taken)
    assert spark.read.table(table).count() == read_export(spark, export).count() == rows
    assert current(spark, model).version == 0


def test_observed_drops_equal_sql(spark, edge_flights):
    rows = edge_flights.withColumn("origin_precipitation", F.when(F.col(S.KEY) == "r5", float("nan")).otherwise(1.0))
    columns = ["month", "depdelay", "origin_snow_depth", "origin_precipitation", "dest_temperature_2m"]
    seen, incomplete = observe_incomplete(rows, columns)
    path = scratch_path(spark, "export")
    export_parquet(seen, path)
    report = {row.column: (row.rows, row.incomplete, row.alone) for row in incomplete.report(spark).collect()}
    assert report.pop(None) == (6, 6 - drop_incomplete(rows, columns).count(), None)
    missing = {c: set() for c in columns}
    for row in rows.collect():
        for c in columns:
            if row[c] is None or row[c] != row[c]:
                missing[c].add(row[S.KEY])
    for c in columns:
        others = set().union(*(missing[d] for d in columns if d != c))
        assert report[c] == (6, len(missing[c]), len(missing[c] - others))
    assert read_export(spark, path).count() == 6


def test_observed_while_a_table_is_replaced(spark):
    rows = spark.range(0, 100, 1, 5).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"), F.lit(1.0).alias("w"))
    seen, incomplete = observe_incomplete(rows)
    replace_table(seen, "observed_table")
    found = {row.column: (row.incomplete, row.alone) for row in incomplete.report(spark).collect()}
    assert found == {None: (10, None), "v": (10, 10), "w": (0, 0)}


def test_numbering_a_replaced_file_is_an_error(spark, monkeypatch):
    path = scratch_path(spark, "rows")
    spark.range(0, 90, 1, 3).write.parquet(path)
    schema = spark.range(1).schema
    assert sorted(row.id for row in number_rows(spark, path, schema, "n").select(F.col("n").alias("id")).collect()) == list(range(1, 91))

    from aerolag.operators import rows as rows_module
    real = rows_module.stage

    def replace_after_counting(df, name, *more):
        written = real(df, name, *more)
        victim = sorted(Path(path).glob("part-*.parquet"))[0]
        other = scratch_path(spark, "other")
        spark.range(500, 540, 1, 1).write.parquet(other)
        (Path(path) / f".{victim.name}.crc").unlink()
        time.sleep(0.02)
        victim.write_bytes(next(Path(other).glob("part-*.parquet")).read_bytes())
        return written

    monkeypatch.setattr(rows_module, "stage", replace_after_counting)
    numbered = number_rows(spark, path, schema, "n")
    with pytest.raises(Exception, match="changed since it was counted"):
        numbered.collect()


def test_two_daily_runs_compared(spark, flights, capsys):
    export, model, state = (scratch_path(spark, name) for name in ("export", "model", "counts"))
    path = scratch_path(spark, "daily")
    spark.read.parquet(flights).write.parquet(path)
    options = ["minutes", "--flights-parquet", path, "--minutes-table", "daily", "--minutes-export", export,
               "--minutes-model", model, "--rounds", "2", "--counts-state", state]
    main(options)
    assert "3 files counted, 0 let go" in capsys.readouterr().out
    spark.read.parquet(flights).limit(400).coalesce(1).write.mode("append").parquet(path)
    main(options)
    out = capsys.readouterr().out
    assert "1 files counted, 0 let go" in out and "incomplete" in out

    log = read_log(spark, model)
    assert sorted({row.version for row in log.collect()}) == [0, 1]
    newest = current(spark, model)
    lines = {row.metric: row for row in log.filter(F.col("version") == newest.version).collect()}
    assert set(lines) == {"n", "mae", "mse", "rmse", "r2"}
    assert {row.folder for row in lines.values()} == {newest.entry["folders"][0]}
    assert lines["n"].source_files == 4 and lines["n"].split_seed == 42
    changes = {row.metric: row for row in compare_runs(log, 0, 1).collect()}
    assert set(changes) == set(lines) and not changes["rmse"].same_source
    assert changes["n"].after >= changes["n"].before > 0
    assert changes["rmse"].change == pytest.approx(changes["rmse"].after - changes["rmse"].before)


def test_counts_state_needs_files(spark):
    with pytest.raises(SystemExit, match="counts-state"):
        main(["minutes", "--flights-table", "x", "--minutes-export", "a", "--minutes-model", "b", "--counts-state", "c"])
