from __future__ import annotations

import pytest
from conftest import flight, make_flights
from pyspark.sql import functions as F

from aerolag import schema as S
from aerolag.functions.columns import hash_percent, hhmm_hour, positive_flag, ratio
from aerolag.operators.rows import drop_incomplete
from aerolag.plans.features import feature_frame, minutes_table, minutes_target, type_table
from aerolag.sources.flights import flights_from_parquet, flights_from_table, with_row_key


@pytest.fixture(scope="module")
def frame(edge_flights):
    return feature_frame(edge_flights).cache()


def by_key(df):
    return {row[S.KEY]: row for row in df.collect()}


def test_edge_rows(frame):
    rows = by_key(frame)
    columns = ["departure_hour", "arrival_hour", "is_peak_season", "is_weekend", "uniquecarrier_freq",
               "depdelay_occurred", "arrdelay_occurred"]
    assert {key: tuple(row[c] for c in columns) for key, row in rows.items()} == {
        "r1": (14, 16, 1, 1, 0.5, 1, 0),
        "r2": (0, 24, 1, 0, 0.5, 0, 0),
        "r3": (23, 0, 0, 0, 2 / 6, 0, 0),
        "r5": (9, 10, 0, 0, 2 / 6, 1, 1),
        "r6": (9, 10, 0, 0, 0.5, 1, 1),
    }
    assert rows["r1"]["temp_diff"] == 5.0
    assert rows["r6"]["temp_diff"] != rows["r6"]["temp_diff"]


def test_cause_labels(spark):
    delays = dict(weatherdelay=1, nasdelay=0, securitydelay=None, lateaircraftdelay=7, carrierdelay=-2)
    row = feature_frame(make_flights(spark, [flight("k", "AA", depdelay=-1, arrdelay=3, **delays)])).first()
    assert [row[label] for label in S.LABELS] == [0, 1, 1, 0, 0, 1, 0]


def test_complete_rows_of_each_table(frame):
    minutes = drop_incomplete(minutes_table(frame))
    assert {row[S.KEY]: row["total_delay"] for row in minutes_target(minutes).collect()} == {"r1": 7.0, "r2": 0.0}
    assert set(by_key(drop_incomplete(type_table(frame)))) == {"r1", "r2", "r3"}


def test_table_columns(frame):
    assert len(S.FEATURES) == 31 and len(S.LABELS) == 7
    assert minutes_table(frame).columns == [S.KEY, *S.MINUTES_COLUMNS] and len(S.MINUTES_COLUMNS) == 33
    assert type_table(frame).columns == [S.KEY, *S.TYPE_COLUMNS] and len(S.TYPE_COLUMNS) == 38
    target = minutes_target(minutes_table(frame))
    assert set(target.columns) == {S.KEY, "total_delay", *S.FEATURES}


def test_drop_incomplete_equals_na_drop(spark, edge_flights):
    kept = drop_incomplete(edge_flights.drop(*S.CAUSE_DELAYS))
    expected = edge_flights.drop(*S.CAUSE_DELAYS).na.drop("any")
    assert sorted(by_key(kept)) == sorted(by_key(expected)) == ["r1", "r2"]
    some = drop_incomplete(edge_flights, ["uniquecarrier", "dest_temperature_2m"])
    assert sorted(by_key(some)) == ["r1", "r2", "r3", "r5"]


def test_scalar_edges(spark):
    df = spark.createDataFrame([(None,), (-5,), (0,), (59,), (100,), (2400,)], "v int")
    rows = df.select(hhmm_hour(F.col("v")), positive_flag(F.col("v"))).collect()
    assert [tuple(row) for row in rows] == [(None, 0), (-1, 0), (0, 0), (0, 1), (1, 1), (24, 1)]
    pair = spark.createDataFrame([(3, 0), (3, 4), (0, 4)], "a int, b int")
    assert [row[0] for row in pair.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.0, 0.75, 0.0]
    null_key = spark.createDataFrame([(None,)], "k string")
    assert 0 <= null_key.select(hash_percent(42, F.col("k"))).first()[0] < 100


def test_readers(spark, edge_flights, tmp_path):
    plain = edge_flights.drop(S.KEY)
    path = str(tmp_path / "flights")
    plain.write.parquet(path)
    whole = flights_from_parquet(spark, path)
    assert whole.columns == S.FLIGHTS.names
    assert whole.select(S.KEY).distinct().count() == 6
    chosen = flights_from_parquet(spark, path, key=["month", "crsdeptime"])
    assert chosen.select(S.KEY).distinct().count() == 6
    assert with_row_key(edge_flights) is edge_flights
    edge_flights.write.mode("overwrite").saveAsTable("edge_flights")
    assert by_key(flights_from_table(spark, "edge_flights")).keys() == by_key(edge_flights).keys()


def test_wrong_tables_are_named(spark, edge_flights):
    with pytest.raises(ValueError, match="month: missing.*distance: string"):
        S.check_flights(edge_flights.drop("month").withColumn("distance", F.lit("far")))


def test_floating_delays_are_refused(edge_flights):
    with pytest.raises(ValueError, match="depdelay: double"):
        S.check_flights(edge_flights.withColumn("depdelay", F.lit(float("nan"))))
    S.check_flights(edge_flights.withColumn("depdelay", F.col("depdelay").cast("decimal(38,0)")))
