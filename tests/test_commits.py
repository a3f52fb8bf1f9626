"""Replacing tables, exports and models: whole, by one writer at a time, and never lost."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aerolag import schema as S
from aerolag.commits import Conflict, commit, history, latest
from aerolag.models.minutes import fit_minutes, load_minutes, save_minutes
from aerolag.operators import tables
from aerolag.operators.tables import drop_table, export_folder, export_parquet, read_export, replace_table
from aerolag.storage import scratch_path


def ids(df):
    return sorted(row[0] for row in df.collect())


def failing(spark, rows=2000):
    """Rows of which the last fail, after files with the others have been begun."""
    late = F.when(F.col("v") >= rows - 5, F.raise_error(F.lit("died midway"))).otherwise(F.col("v"))
    return spark.range(0, rows, 1, 8).toDF("v").select(late.cast("long").alias("v"))


def test_a_write_that_dies_leaves_table_and_export(spark):
    path = scratch_path(spark, "export")
    replace_table(spark.range(4).toDF("v"), "kept_table", path)
    before = spark.read.table("kept_table")
    with pytest.raises(Exception, match="died midway"):
        replace_table(failing(spark), "kept_table", path)
    assert ids(spark.read.table("kept_table")) == ids(read_export(spark, path)) == ids(before) == [0, 1, 2, 3]
    assert len(history(spark, path)) == 1
    assert [p.name for p in Path(path).iterdir() if p.name.startswith("rows-")] == [Path(export_folder(spark, path)).name]
    drop_table(spark, "kept_table")


@pytest.mark.parametrize("step", ["commit", "prune"])
def test_a_driver_lost_around_the_switch(spark, monkeypatch, step):
    """Before the commit all is old; after it the export is new, and a table's rows are never a mixture."""
    path, name = scratch_path(spark, "export"), f"switched_{step}"
    replace_table(spark.range(4).toDF("v"), name, path)

    def die(*_):
        raise SystemExit("driver lost")

    monkeypatch.setattr(tables, step, die)
    with pytest.raises(SystemExit):
        replace_table(spark.range(9).toDF("v"), name, path)
    monkeypatch.undo()
    rows = 4 if step == "commit" else 9
    assert spark.read.table(name).count() == read_export(spark, path).count() == rows
    assert replace_table(spark.range(2).toDF("v"), name, path).count() == 2
    drop_table(spark, name)


def test_readers_that_have_begun_finish(spark):
    path = scratch_path(spark, "export")
    replace_table(spark.range(4).toDF("v"), "read_on", path)
    reader = read_export(spark, path)
    replace_table(spark.range(9).toDF("v"), "read_on", path)
    assert reader.count() == 4
    replace_table(spark.range(3).toDF("v"), "read_on", path)
    assert spark.read.table("read_on").count() == 3
    kept = [p for p in Path(path).iterdir() if p.name.startswith("rows-")]
    assert len(kept) == tables.KEPT
    drop_table(spark, "read_on")


def test_switch_keeps_the_catalog_entry(spark):
    """Same columns: the table exists throughout. Other columns: a new entry, of complete files."""
    replace_table(spark.range(4).toDF("v"), "entry_kept")
    created = spark.sql("DESCRIBE TABLE EXTENDED entry_kept").filter("col_name = 'Created Time'").first()
    calls = []
    real = tables.drop_table
    tables.drop_table = lambda *a: calls.append(a) or real(*a)
    try:
        replace_table(spark.range(5).toDF("v"), "entry_kept")
        assert calls == []
        assert spark.sql("DESCRIBE TABLE EXTENDED entry_kept").filter("col_name = 'Created Time'").first() == created
        replace_table(spark.range(5).selectExpr("id AS v", "'x' AS w"), "entry_kept")
        assert len(calls) == 1
    finally:
        tables.drop_table = real
    assert spark.read.table("entry_kept").columns == ["v", "w"]
    drop_table(spark, "entry_kept")


def test_a_table_others_made_is_replaced(spark):
    spark.range(7).toDF("v").write.saveAsTable("by_others")
    assert replace_table(spark.read.table("by_others").filter("v < 3"), "by_others").count() == 3
    drop_table(spark, "by_others")


def test_an_export_of_other_tools_is_read(spark):
    path = scratch_path(spark, "plain")
    spark.range(5).write.parquet(path)
    assert read_export(spark, path).count() == 5


def test_writers_at_once_are_all_kept(spark):
    path = scratch_path(spark, "log")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: commit(spark, path, {"folder": f"f{i}"}), range(24)))
    assert sorted(c.version for c in made) == list(range(24))
    known = history(spark, path)
    assert [c.version for c in known] == list(range(24))
    assert sorted(c.entry["folder"] for c in known) == sorted(f"f{i}" for i in range(24))
    assert latest(spark, path) == known[-1]
    names = {p.name for p in (Path(path) / "_commits").iterdir()}
    assert names == {f"v{i:010d}" for i in range(24)}
    assert all([p.name for p in (Path(path) / "_commits" / n).iterdir() if not p.name.startswith(".")] == ["entry.json"] for n in names)


def test_of_writers_from_one_base_one_is_kept(spark):
    path = scratch_path(spark, "log")
    base = commit(spark, path, {"folder": "first"}).version

    def try_commit(i):
        try:
            return commit(spark, path, {"folder": f"f{i}"}, base)
        except Conflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        made = [c for c in pool.map(try_commit, range(6)) if c]
    assert len(made) == 1 and len(history(spark, path)) == 2
    assert latest(spark, path).entry["folder"] == made[0].entry["folder"]


@pytest.fixture(scope="module")
def train(spark):
    rows = [(str(i), *[float((i * 7 + j) % 11) for j in range(len(S.FEATURES))], float(i % 5)) for i in range(60)]
    return spark.createDataFrame(rows, [S.KEY, *S.FEATURES, "total_delay"])


def test_two_savers_from_one_model(spark, train):
    path = scratch_path(spark, "model")
    save_minutes(spark, fit_minutes(train, rounds=1), path)
    one, other = load_minutes(spark, path), load_minutes(spark, path)
    kept = save_minutes(spark, fit_minutes(train, one, rounds=1), path)
    late = fit_minutes(train, other, rounds=1)
    with pytest.raises(Conflict):
        save_minutes(spark, late, path)
    assert load_minutes(spark, path).folder == kept.folder
    # From the new state on it is taken.
    assert save_minutes(spark, fit_minutes(train, load_minutes(spark, path), rounds=1), path).runs == 3


def test_two_fresh_savers_are_both_in_the_history(spark, train):
    path = scratch_path(spark, "model")
    fresh = fit_minutes(train, rounds=1)
    with ThreadPoolExecutor(2) as pool:
        saved = list(pool.map(lambda _: save_minutes(spark, fresh, path), range(2)))
    assert sorted(s.version for s in saved) == [0, 1]
    assert {c.entry["folders"][0] for c in history(spark, path)} == {s.folder for s in saved}
