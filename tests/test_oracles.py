"""Every query with SQL gives the same rows and types in DuckDB."""

from __future__ import annotations

import os

import compare
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from aerolag.registry import oracles
from aerolag.registry import queries as registered

SF_DIR = os.environ.get("TEST_SF_DIR", SMALL)
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR"}
#: Trained with full rounds, so compared on one set of tables only.
FITTED = {
    "delay_minutes_predict",
    "delay_minutes_eval",
    "warm_start_predict",
    "delay_type_predict",
    "delay_type_eval",
}


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(registered.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracles.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    actual = registered.queries()[name](spark, SF_DIR)
    expected = duck.sql(oracles.oracle_sql()[name])
    assert {column: SQL_TYPES[kind] for column, kind in actual.dtypes} == dict(
        zip(expected.columns, map(str, expected.types))
    )
    compare.assert_same(actual.toPandas(), expected.df())


@pytest.fixture(scope="module")
def uneven(tmp_path_factory):
    """The small tables with a third of all line items copies of one, and NULLs in most columns."""
    folder = str(tmp_path_factory.mktemp("uneven"))
    tables = compare.connect(SMALL)
    for name in compare.TABLES:
        tables.execute(f"CREATE TABLE own_{name} AS SELECT * FROM {name}")
    lines = tables.sql("SELECT count(*) FROM own_lineitem").fetchall()[0][0]
    tables.execute(
        f"INSERT INTO own_lineitem SELECT l.* FROM (SELECT * FROM lineitem LIMIT 1) l, range({lines // 2})"
    )
    for column in ("l_shipdate", "l_quantity", "l_linenumber", "l_orderkey", "l_suppkey"):
        tables.execute(
            f"INSERT INTO own_lineitem SELECT * REPLACE (CAST(NULL AS {compare.type_of(tables, column)}) AS {column})"
            " FROM lineitem LIMIT 200"
        )
    tables.execute("UPDATE own_customer SET c_nationkey = NULL WHERE c_custkey % 17 = 0")
    tables.execute("UPDATE own_nation SET n_name = NULL WHERE n_nationkey = 5")
    for name in compare.TABLES:
        tables.execute(f"COPY own_{name} TO '{folder}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)")
    return folder


@pytest.mark.parametrize("name", sorted(set(oracles.oracle_sql()) - FITTED))
def test_same_as_sql_on_uneven_tables(spark, uneven, name):
    actual = registered.queries()[name](spark, uneven)
    expected = compare.connect(uneven).sql(oracles.oracle_sql()[name])
    compare.assert_same(actual.toPandas(), expected.df())


def test_flight_key_is_unique(spark):
    flights = entry_points.queries()["flights_scan"](spark, SF_DIR)
    assert flights.select("flight_key").distinct().count() == flights.count()


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns[0] == "flight_key" and len(result.columns) == 34
    assert result.count() > 0
