"""Physical plans: no shuffle of flights, no Python, pruned and filtered scans."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from conftest import SMALL

from aerolag import schema as S
from aerolag.operators import encoding
from aerolag.operators.encoding import frequency_encode, value_counts
from aerolag.operators.metrics import multilabel_report, regression_metrics
from aerolag.operators.rows import dense_id, drop_incomplete
from aerolag.operators.split import hash_split
from aerolag.plans.features import feature_frame, minutes_table, minutes_target, type_table
from aerolag.sources.order_flights import order_flights
from aerolag.storage import stage


@pytest.fixture(scope="module")
def flights(spark):
    return stage(order_flights(spark, SMALL), "flights")


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def tree(df):
    """The plan's operator tree, without the details."""
    return plan(df).split("\n\n\n")[0]


def test_feature_frame_does_not_move_flights(flights):
    shape = tree(feature_frame(flights))
    assert shape.count("BroadcastHashJoin") == 1
    for node in ("SortMergeJoin", "Python", "NestedLoop", "Cartesian", "Window"):
        assert node not in shape
    assert shape.count("Exchange") == shape.count("BroadcastExchange") == 1


def test_counts_read_one_column(flights):
    text = plan(value_counts(flights, "uniquecarrier", "n"))
    assert re.findall(r"ReadSchema: (.*)", text) == ["struct<uniquecarrier:string>"]
    assert "partial_count" in text


def test_both_tables_read_what_they_need(flights):
    frame = feature_frame(flights)
    assert "weatherdelay" not in plan(minutes_table(frame))
    assert "weatherdelay" in plan(type_table(frame))


def test_null_filter_reaches_the_scan(flights):
    exported = stage(minutes_table(feature_frame(flights)), "export")
    text = plan(drop_incomplete(exported))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "IsNotNull(" in pushed
    assert "Exchange" not in text


def test_split_and_target_are_narrow(flights):
    exported = stage(minutes_table(feature_frame(flights)), "export")
    for part in hash_split(minutes_target(drop_incomplete(exported))):
        assert "Exchange" not in tree(part)


def test_metrics_are_one_pass(flights):
    rows = drop_incomplete(stage(type_table(feature_frame(flights)), "export"))
    shape = tree(multilabel_report(rows, S.LABELS, S.LABELS))
    assert shape.count("Scan parquet") == 1 and shape.count("HashAggregate") == 2
    shape = tree(regression_metrics(rows, "distance", "departure_hour"))
    assert shape.count("Scan parquet") == 1 and shape.count("HashAggregate") == 2


def test_ids_do_not_move_rows(flights):
    text = plan(dense_id(flights))
    shape = text.split("\n\n\n")[0]
    assert "SortMergeJoin" not in shape and "BroadcastHashJoin" in shape
    # Only the staged counts of the files are below windows and shuffles.
    assert shape.count("Window") == 2
    assert len(re.findall(r"ReadSchema: struct<_file:string,_size:bigint,_time:timestamp,_n:bigint", text)) >= 1


def test_only_rare_values_are_shuffled(flights, monkeypatch):
    monkeypatch.setattr(encoding, "HOT_KEYS", 5)
    shape = tree(frequency_encode(flights, "uniquecarrier", "f", broadcast_bytes=0))
    assert shape.count("BroadcastHashJoin") == 2 and shape.count("SortMergeJoin") == 1
    assert "LeftAnti" in shape


def test_every_method_is_small_enough_to_compile(spark, flights):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        exported = stage(minutes_table(feature_frame(flights)), "export")
        for df in (feature_frame(flights), minutes_target(drop_incomplete(exported)), order_flights(spark, SMALL)):
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", plan(df, "codegen"))]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
