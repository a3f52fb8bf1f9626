"""The feature frame both jobs share, and each job's table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag import schema as S
from aerolag.functions.columns import hhmm_hour, member_flag, pair_diff, positive_flag, total_delay
from aerolag.operators.encoding import frequency_encode


def hour_columns() -> list:
    return [
        hhmm_hour(F.col("crsdeptime")).alias("departure_hour"),
        hhmm_hour(F.col("crsarrtime")).alias("arrival_hour"),
    ]


def calendar_columns() -> list:
    return [
        member_flag(F.col("month"), S.PEAK_MONTHS).alias("is_peak_season"),
        member_flag(F.col("dayofweek"), S.WEEKEND_DAYS).alias("is_weekend"),
    ]


def weather_diff_columns() -> list:
    pairs = {
        "temp_diff": "temperature_2m",
        "humidity_diff": "relative_humidity_2m",
        "precip_diff": "precipitation",
    }
    return [
        pair_diff(F.col(f"origin_{name}"), F.col(f"dest_{name}")).alias(out) for out, name in pairs.items()
    ]


def label_columns() -> list:
    return [
        positive_flag(F.col(source)).alias(label) for source, label in zip(S.LABEL_SOURCES, S.LABELS)
    ]


def feature_frame(flights: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Key, the 31 features, the two delays and the seven labels.

    Narrow but for the carrier counts (uniquecarrier, _n), which are made here unless they are given; both
    jobs project from it.
    """
    return frequency_encode(flights, "uniquecarrier", "uniquecarrier_freq", counts=counts).select(
        S.KEY,
        *hour_columns(),
        *calendar_columns(),
        *weather_diff_columns(),
        F.col("distance").cast("double").alias("distance"),
        "uniquecarrier_freq",
        *S.ORIGIN_WEATHER,
        *S.DEST_WEATHER,
        *S.DELAYS,
        *label_columns(),
    )


def minutes_table(frame: DataFrame) -> DataFrame:
    """Key and the 33 columns of the delay-minutes table."""
    return frame.select(S.KEY, *S.MINUTES_COLUMNS)


def type_table(frame: DataFrame) -> DataFrame:
    """Key and the 38 columns of the delay-type table, before its ids."""
    return frame.select(S.KEY, *S.TYPE_COLUMNS)


def minutes_target(table: DataFrame) -> DataFrame:
    """Replace the two delays by their sum, the regression target."""
    target = total_delay(F.col("depdelay"), F.col("arrdelay"))
    return table.withColumn("total_delay", target).drop(*S.DELAYS)
