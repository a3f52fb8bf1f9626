"""Readers that return a checked flights table with a row key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag import schema as S
from aerolag.storage import stage


def with_row_key(flights: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Add ``flight_key`` from ``columns`` (default: all flight columns) where it is absent.

    The key drives the train/test split only, so copies of a row may share it.
    """
    if S.KEY in flights.columns:
        return flights
    chosen = columns or [field.name for field in S.FLIGHTS.fields if field.name != S.KEY]
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in chosen]
    return flights.withColumn(S.KEY, F.md5(F.concat_ws("|", *parts)))


def _ready(flights: DataFrame, key: list[str] | None) -> DataFrame:
    checked = S.check_flights(with_row_key(flights, key))
    return checked.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in S.FLIGHTS.fields])


def flights_from_table(spark: SparkSession, name: str, key: list[str] | None = None) -> DataFrame:
    """Flights from a catalog table, as it is now.

    The columns needed are read once and staged: a table that changes between two reads
    would give counts that do not fit its rows.
    """
    return stage(_ready(spark.read.table(name), key), "flights")


def flights_from_parquet(spark: SparkSession, path: str, key: list[str] | None = None) -> DataFrame:
    """Flights from a Parquet directory."""
    return _ready(spark.read.parquet(path), key)


def flights_from_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str,
    password: str,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    key: list[str] | None = None,
) -> DataFrame:
    """Flights from a warehouse, read by ``partitions`` range queries on a numeric column.

    The bounds only set the strides; rows outside them and NULLs are read as well. The
    rows are staged, so that every later step sees the same ones.
    """
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        user=user,
        password=password,
        partitionColumn=partition_column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(partitions),
        fetchsize="10000",
    )
    return stage(_ready(reader.load(), key), "flights")
