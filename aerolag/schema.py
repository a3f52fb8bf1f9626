"""Column names and types shared by the readers, the feature frame and both jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = "flight_key"

# The column names and their order define the tables both jobs
# read and write.
WEATHER = [
    "temperature_2m",
    "relative_humidity_2m",
    "dew_point_2m",
    "precipitation",
    "snow_depth",
    "pressure_msl",
    "surface_pressure",
    "cloud_cover",
    "wind_speed_10m",
    "wind_direction_10m",
    "wind_gusts_10m",
]
ORIGIN_WEATHER = [f"origin_{name}" for name in WEATHER]
DEST_WEATHER = [f"dest_{name}" for name in WEATHER]
CALENDAR_AND_DIFFS = [
    "departure_hour",
    "arrival_hour",
    "is_peak_season",
    "is_weekend",
    "temp_diff",
    "humidity_diff",
    "precip_diff",
]
DISTANCE_AND_CARRIER = ["distance", "uniquecarrier_freq"]
DELAYS = ["depdelay", "arrdelay"]
CAUSE_DELAYS = [
    "weatherdelay",
    "nasdelay",
    "securitydelay",
    "lateaircraftdelay",
    "carrierdelay",
]
PEAK_MONTHS = [6, 7, 8, 12]
WEEKEND_DAYS = [6, 7]

LABEL_SOURCES = DELAYS + CAUSE_DELAYS
LABELS = [f"{name}_occurred" for name in LABEL_SOURCES]
FEATURES = CALENDAR_AND_DIFFS + DISTANCE_AND_CARRIER + ORIGIN_WEATHER + DEST_WEATHER
MINUTES_COLUMNS = CALENDAR_AND_DIFFS + DISTANCE_AND_CARRIER + DELAYS + ORIGIN_WEATHER + DEST_WEATHER
TYPE_COLUMNS = CALENDAR_AND_DIFFS + ORIGIN_WEATHER + DEST_WEATHER + DISTANCE_AND_CARRIER + LABELS

INTEGER_COLUMNS = ["month", "dayofweek", "crsdeptime", "crsarrtime", "distance", *LABEL_SOURCES]
FLIGHTS = T.StructType(
    [T.StructField(KEY, T.StringType()), T.StructField("uniquecarrier", T.StringType())]
    + [T.StructField(name, T.IntegerType()) for name in INTEGER_COLUMNS]
    + [T.StructField(name, T.DoubleType()) for name in ORIGIN_WEATHER + DEST_WEATHER]
)


def _fits(kind: T.DataType, declared: T.DataType) -> bool:
    # A floating NaN is greater than every number, so a delay of that type would count as late.
    if isinstance(declared, T.StringType):
        return isinstance(kind, T.StringType)
    if isinstance(declared, T.IntegerType):
        return isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0
    return isinstance(kind, T.NumericType)


def check_flights(flights: DataFrame) -> DataFrame:
    """Return ``flights`` unchanged, or raise naming every missing or mistyped column."""
    found = {field.name.lower(): field.dataType for field in flights.schema.fields}
    wrong = []
    for field in FLIGHTS.fields:
        kind = found.get(field.name)
        if kind is None:
            wrong.append(f"{field.name}: missing")
        elif not _fits(kind, field.dataType):
            wrong.append(f"{field.name}: {kind.simpleString()}")
    if wrong:
        raise ValueError("not a flights table: " + ", ".join(wrong))
    return flights
