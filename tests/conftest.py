from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from aerolag import schema as S  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def flight(key: str, carrier: str | None, **values) -> dict:
    """A flight at 09:00-10:00 on day 1 of month 1, weather 15.0, no delays."""
    row = dict.fromkeys(S.FLIGHTS.names)
    row.update({name: 15.0 for name in S.ORIGIN_WEATHER + S.DEST_WEATHER})
    row.update(month=1, dayofweek=1, crsdeptime=900, crsarrtime=1000, distance=500, depdelay=0, arrdelay=0)
    row.update({S.KEY: key, "uniquecarrier": carrier}, **values)
    return row


def make_flights(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(row[name] for name in S.FLIGHTS.names) for row in rows], S.FLIGHTS)


@pytest.fixture(scope="session")
def edge_flights(spark) -> DataFrame:
    """The six hand-made rows of FIXTURES.md."""
    return make_flights(
        spark,
        [
            flight("r1", "AA", month=7, dayofweek=6, crsdeptime=1430, crsarrtime=1605, depdelay=10, arrdelay=-3,
                   origin_temperature_2m=20.0),
            flight("r2", "AA", month=12, dayofweek=5, crsdeptime=5, crsarrtime=2400),
            flight("r3", "BB", month=None, dayofweek=None, crsdeptime=2359, crsarrtime=59, depdelay=None,
                   arrdelay=None),
            flight("r4", None, depdelay=5, arrdelay=5),
            flight("r5", "BB", month=2, dayofweek=2, depdelay=5, arrdelay=5, origin_snow_depth=None),
            flight("r6", "AA", month=3, dayofweek=3, depdelay=5, arrdelay=5, dest_temperature_2m=float("nan")),
        ],
    )
