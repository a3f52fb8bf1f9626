"""A flights table derived from the order tables, one flight per line item.

The values carry no meaning beyond exercising every operator: NULLs in the carrier,
the delays and the snow depth, negative delays, hours of the whole day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolag import schema as S
from aerolag.storage import spread

# Per weather variable the multiplier of the place, the modulus, the
# divisor and the offset.
WEATHER_RULES = {
    "temperature_2m": (17, 400, 10.0, -5.0),
    "relative_humidity_2m": (13, 100, 1.0, 0.0),
    "dew_point_2m": (19, 300, 10.0, -10.0),
    "precipitation": (23, 60, 10.0, 0.0),
    "snow_depth": (29, 20, 100.0, 0.0),
    "pressure_msl": (31, 500, 10.0, 990.0),
    "surface_pressure": (37, 500, 10.0, 940.0),
    "cloud_cover": (41, 101, 1.0, 0.0),
    "wind_speed_10m": (43, 400, 10.0, 0.0),
    "wind_direction_10m": (47, 360, 1.0, 0.0),
    "wind_gusts_10m": (53, 700, 10.0, 0.0),
}


def _unless(condition: Column, value: Column) -> Column:
    """NULL where the condition holds, else the value, also where the condition is NULL."""
    return F.when(condition, F.lit(None)).otherwise(value)


def _weather(place: Column, name: str) -> Column:
    multiplier, modulus, divisor, offset = WEATHER_RULES[name]
    day_part = (F.col("month") * 11 + F.col("_day") * 7).cast("double")
    value = ((place.cast("double") + 3) * multiplier + day_part) % modulus
    if divisor != 1.0:
        value = value / divisor
    if offset != 0.0:
        value = value + offset
    if name == "snow_depth":
        return _unless((place + F.col("_day")) % 50 == 0, value)
    return value


def order_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights table over the tables in ``sf_dir``."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    shipped = F.col("l_shipdate").cast("date")
    lines = spread(table("lineitem")).select(
        "l_orderkey",
        "l_suppkey",
        F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", shipped).alias(S.KEY),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_h"),
        shipped.alias("_shipped"),
        (F.weekday(shipped) + 1).alias("dayofweek"),
        (F.col("l_quantity").cast("int") * 40 + 100).alias("distance"),
    )
    # Orders and places are joined among themselves first, so the many and wide line items are shuffled once.
    ordered = table("orders").join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    supplied = table("supplier").join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    joined = lines.join(
        ordered.select("o_orderkey", "c_nationkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(supplied.select("s_suppkey", "s_nationkey", "n_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    # Made behind the joins, so that fewer columns are shuffled.
    h, shipped = F.col("_h"), F.col("_shipped")
    base = joined.select(
        "s_nationkey",
        "c_nationkey",
        "n_name",
        S.KEY,
        "_h",
        ((h % 24) * 2 + (h * 13) % 41 - 25).cast("int").alias("_dry_delay"),
        ((h % 24) * 100 + h % 60).cast("int").alias("crsdeptime"),
        (((h * 3) % 24) * 100 + (h * 11) % 60).cast("int").alias("crsarrtime"),
        F.month(shipped).alias("month"),
        F.dayofmonth(shipped).alias("_day"),
        "dayofweek",
        "distance",
    )
    rain = F.floor("origin_precipitation").cast("int")
    unknown, late = h % 53 == 0, F.col("_late")
    at_origin = base.select(
        "*", *[_weather(F.col("s_nationkey"), name).alias(f"origin_{name}") for name in S.WEATHER]
    )
    delayed = at_origin.withColumn("_late", F.col("_dry_delay") + rain)
    on_time = unknown | (late <= 15)
    return delayed.select(
        S.KEY,
        _unless(h % 97 == 0, F.col("n_name").cast("string")).alias("uniquecarrier"),
        "month",
        "dayofweek",
        "crsdeptime",
        "crsarrtime",
        "distance",
        _unless(unknown, late).alias("depdelay"),
        _unless(unknown | (h % 59 == 0), late + ((h * 7) % 21 - 10).cast("int")).alias("arrdelay"),
        _unless(on_time, rain).alias("weatherdelay"),
        _unless(on_time, (h % 5).cast("int")).alias("nasdelay"),
        _unless(on_time, F.when(h % 211 == 1, 12).otherwise(0)).alias("securitydelay"),
        _unless(on_time, (h % 4).cast("int") * 9).alias("lateaircraftdelay"),
        _unless(on_time, (h % 3).cast("int") * late).alias("carrierdelay"),
        *S.ORIGIN_WEATHER,
        *[_weather(F.col("c_nationkey"), name).alias(f"dest_{name}") for name in S.WEATHER],
    )
