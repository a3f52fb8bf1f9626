"""The same results in SQL, for the check against another engine."""

from __future__ import annotations

from aerolag import schema as S

FLIGHTS_SQL = """
 SELECT flight_key,
  CASE WHEN h % 97 = 0 THEN NULL ELSE nm END AS uniquecarrier, mo AS month, dow AS dayofweek,
  CAST((h % 24) * 100 + h % 60 AS INT) AS crsdeptime,
  CAST(((h * 3) % 24) * 100 + (h * 11) % 60 AS INT) AS crsarrtime,
  100 + CAST(q AS INT) * 40 AS distance,
  CASE WHEN h % 53 = 0 THEN NULL ELSE dep0 END AS depdelay,
  CASE WHEN h % 53 = 0 OR h % 59 = 0 THEN NULL ELSE dep0 + CAST((h * 7) % 21 - 10 AS INT) END AS arrdelay,
  CASE WHEN h % 53 = 0 OR dep0 <= 15 THEN NULL ELSE CAST(h % 3 AS INT) * dep0 END AS carrierdelay,
  CASE WHEN h % 53 = 0 OR dep0 <= 15 THEN NULL ELSE CAST(floor(origin_precipitation) AS INT) END AS weatherdelay,
  CASE WHEN h % 53 = 0 OR dep0 <= 15 THEN NULL ELSE CAST(h % 5 AS INT) END AS nasdelay,
  CASE WHEN h % 53 = 0 OR dep0 <= 15 THEN NULL WHEN h % 211 = 1 THEN 12 ELSE 0 END AS securitydelay,
  CASE WHEN h % 53 = 0 OR dep0 <= 15 THEN NULL ELSE CAST(h % 4 AS INT) * 9 END AS lateaircraftdelay,
  {weather_columns}
 FROM (
  SELECT *, CAST((h % 24) * 2 + (h * 13) % 41 - 25 + floor(origin_precipitation) AS INT) AS dep0
  FROM (
   SELECT *,
    CAST(((s_nationkey + 3) * 17 + mo * 11 + dd * 7) % 400 AS DOUBLE) / 10e0 - 5e0 AS origin_temperature_2m,
    CAST(((s_nationkey + 3) * 13 + mo * 11 + dd * 7) % 100 AS DOUBLE) AS origin_relative_humidity_2m,
    CAST(((s_nationkey + 3) * 19 + mo * 11 + dd * 7) % 300 AS DOUBLE) / 10e0 - 10e0 AS origin_dew_point_2m,
    CAST(((s_nationkey + 3) * 23 + mo * 11 + dd * 7) % 60 AS DOUBLE) / 10e0 AS origin_precipitation,
    CASE WHEN (s_nationkey + dd) % 50 = 0 THEN NULL ELSE CAST(((s_nationkey + 3) * 29 + mo * 11 + dd * 7) % 20 AS DOUBLE) / 100e0 END AS origin_snow_depth,
    CAST(((s_nationkey + 3) * 31 + mo * 11 + dd * 7) % 500 AS DOUBLE) / 10e0 + 990e0 AS origin_pressure_msl,
    CAST(((s_nationkey + 3) * 37 + mo * 11 + dd * 7) % 500 AS DOUBLE) / 10e0 + 940e0 AS origin_surface_pressure,
    CAST(((s_nationkey + 3) * 41 + mo * 11 + dd * 7) % 101 AS DOUBLE) AS origin_cloud_cover,
    CAST(((s_nationkey + 3) * 43 + mo * 11 + dd * 7) % 400 AS DOUBLE) / 10e0 AS origin_wind_speed_10m,
    CAST(((s_nationkey + 3) * 47 + mo * 11 + dd * 7) % 360 AS DOUBLE) AS origin_wind_direction_10m,
    CAST(((s_nationkey + 3) * 53 + mo * 11 + dd * 7) % 700 AS DOUBLE) / 10e0 AS origin_wind_gusts_10m,
    CAST(((c_nationkey + 3) * 17 + mo * 11 + dd * 7) % 400 AS DOUBLE) / 10e0 - 5e0 AS dest_temperature_2m,
    CAST(((c_nationkey + 3) * 13 + mo * 11 + dd * 7) % 100 AS DOUBLE) AS dest_relative_humidity_2m,
    CAST(((c_nationkey + 3) * 19 + mo * 11 + dd * 7) % 300 AS DOUBLE) / 10e0 - 10e0 AS dest_dew_point_2m,
    CAST(((c_nationkey + 3) * 23 + mo * 11 + dd * 7) % 60 AS DOUBLE) / 10e0 AS dest_precipitation,
    CASE WHEN (c_nationkey + dd) % 50 = 0 THEN NULL ELSE CAST(((c_nationkey + 3) * 29 + mo * 11 + dd * 7) % 20 AS DOUBLE) / 100e0 END AS dest_snow_depth,
    CAST(((c_nationkey + 3) * 31 + mo * 11 + dd * 7) % 500 AS DOUBLE) / 10e0 + 990e0 AS dest_pressure_msl,
    CAST(((c_nationkey + 3) * 37 + mo * 11 + dd * 7) % 500 AS DOUBLE) / 10e0 + 940e0 AS dest_surface_pressure,
    CAST(((c_nationkey + 3) * 41 + mo * 11 + dd * 7) % 101 AS DOUBLE) AS dest_cloud_cover,
    CAST(((c_nationkey + 3) * 43 + mo * 11 + dd * 7) % 400 AS DOUBLE) / 10e0 AS dest_wind_speed_10m,
    CAST(((c_nationkey + 3) * 47 + mo * 11 + dd * 7) % 360 AS DOUBLE) AS dest_wind_direction_10m,
    CAST(((c_nationkey + 3) * 53 + mo * 11 + dd * 7) % 700 AS DOUBLE) / 10e0 AS dest_wind_gusts_10m
   FROM (
    SELECT concat_ws('|', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, CAST(l.l_shipdate AS DATE)) AS flight_key,
     l.l_orderkey * 8 + l.l_linenumber AS h, CAST(n.n_name AS STRING) AS nm, s.s_nationkey, c.c_nationkey,
     CAST(month(l.l_shipdate) AS INT) AS mo, CAST(day(l.l_shipdate) AS INT) AS dd,
     CAST(isodow(l.l_shipdate) AS INT) AS dow, l.l_quantity AS q
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey
   )
  )
 )
""".format(weather_columns=", ".join(S.ORIGIN_WEATHER + S.DEST_WEATHER))


def _listed(values: list) -> str:
    return ", ".join(str(value) for value in values)


HOURS = (
    "CAST(floor(crsdeptime / 100e0) AS INT) AS departure_hour,"
    " CAST(floor(crsarrtime / 100e0) AS INT) AS arrival_hour"
)
FLAGS = (
    f"coalesce(CAST(month IN ({_listed(S.PEAK_MONTHS)}) AS INT), 0) AS is_peak_season,"
    f" coalesce(CAST(dayofweek IN ({_listed(S.WEEKEND_DAYS)}) AS INT), 0) AS is_weekend"
)
DIFFS = ", ".join(
    f"origin_{name} - dest_{name} AS {out}"
    for out, name in [
        ("temp_diff", "temperature_2m"),
        ("humidity_diff", "relative_humidity_2m"),
        ("precip_diff", "precipitation"),
    ]
)
OCCURRED = ", ".join(
    f"coalesce(CAST({source} > 0 AS INT), 0) AS {label}" for source, label in zip(S.LABEL_SOURCES, S.LABELS)
)
FEATURES_SQL = f"""
 SELECT flight_key, {HOURS}, {FLAGS}, {DIFFS}, CAST(distance AS DOUBLE) AS distance,
  CAST(count(*) OVER (PARTITION BY uniquecarrier) AS DOUBLE) / count(*) OVER () AS uniquecarrier_freq,
  depdelay, arrdelay, {_listed(S.ORIGIN_WEATHER + S.DEST_WEATHER)}, {OCCURRED}
 FROM flights QUALIFY uniquecarrier IS NOT NULL
"""

INTEGERS = {"departure_hour", "arrival_hour", "is_peak_season", "is_weekend", *S.DELAYS, *S.LABELS}


def _complete(columns: list[str]) -> str:
    terms = [f"{name} IS NOT NULL" for name in columns]
    terms += [f"NOT isnan({name})" for name in columns if name not in INTEGERS]
    return " AND ".join(terms)


def _flights(select: str) -> str:
    return f"WITH flights AS ({FLIGHTS_SQL}) {select}"


def _features(select: str) -> str:
    return f"WITH flights AS ({FLIGHTS_SQL}), features AS ({FEATURES_SQL}) {select}"


IS_TEST = "CAST('0x' || substr(md5(concat('42|', flight_key)), 1, 8) AS BIGINT) % 100 < 20"
MINUTES = ", ".join([S.KEY, *S.MINUTES_COLUMNS])
TYPES = ", ".join([S.KEY, *S.TYPE_COLUMNS])
VECTOR = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in S.FEATURES)

# The stand-in predictions the metrics are checked with.
RULE_MINUTES = "4e0 * departure_hour - 20e0"
RULES = [f"CASE WHEN departure_hour >= {8 + i} THEN 1 ELSE 0 END" for i in range(len(S.LABELS))]

LABEL_COUNTS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{label}' AS label, CAST(sum({label} * {rule}) AS BIGINT) AS tp,"
    f" CAST(sum({rule}) AS BIGINT) AS pred, CAST(sum({label}) AS BIGINT) AS support FROM rows_used"
    for i, (label, rule) in enumerate(zip(S.LABELS, RULES))
)
HITS = " + ".join(f"{label} * {rule}" for label, rule in zip(S.LABELS, RULES))
SAID = " + ".join(RULES)
TRUE = " + ".join(S.LABELS)

REPORT = f"""
 , rows_used AS (SELECT * FROM features WHERE {_complete(S.FEATURES)} AND {IS_TEST}),
 counts AS ({LABEL_COUNTS}),
 scores AS (
  SELECT position, label,
   CASE WHEN pred = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / pred END AS precision,
   CASE WHEN support = 0 THEN 0e0 ELSE CAST(tp AS DOUBLE) / support END AS recall,
   CASE WHEN pred + support = 0 THEN 0e0 ELSE 2e0 * tp / (pred + support) END AS f1, support FROM counts),
 per_row AS (SELECT {HITS} AS hits, {SAID} AS said, {TRUE} AS truth FROM rows_used),
 report AS (
  SELECT * FROM scores
  UNION ALL SELECT 7, 'micro avg', CAST(sum(tp) AS DOUBLE) / sum(pred), CAST(sum(tp) AS DOUBLE) / sum(support),
   2e0 * sum(tp) / (sum(pred) + sum(support)), sum(support) FROM counts
  UNION ALL SELECT 8, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
  UNION ALL SELECT 9, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
   sum(f1 * support) / sum(support), sum(support) FROM scores
  UNION ALL SELECT 10, 'samples avg',
   avg(CASE WHEN said = 0 THEN 0e0 ELSE CAST(hits AS DOUBLE) / said END),
   avg(CASE WHEN truth = 0 THEN 0e0 ELSE CAST(hits AS DOUBLE) / truth END),
   avg(CASE WHEN said + truth = 0 THEN 0e0 ELSE 2e0 * hits / (said + truth) END),
   (SELECT sum(support) FROM counts) FROM per_row)
 SELECT CAST(position AS INT) AS position, label, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM report
"""


def _incomplete(name: str) -> str:
    return f"({name} IS NULL)" if name in INTEGERS | {S.KEY} else f"({name} IS NULL OR coalesce(isnan({name}), FALSE))"


_ANY = " + ".join(f"CAST({_incomplete(name)} AS INT)" for name in [S.KEY, *S.MINUTES_COLUMNS])
DROPPED = (
    f", m AS (SELECT *, {_ANY} AS missing FROM features)"
    ' SELECT CAST(NULL AS VARCHAR) AS "column", count(*) AS rows, count(*) FILTER (missing > 0) AS incomplete,'
    " CAST(NULL AS BIGINT) AS alone FROM m"
) + "".join(
    f" UNION ALL SELECT '{name}', count(*), count(*) FILTER {_incomplete(name)},"
    f" count(*) FILTER ({_incomplete(name)} AND missing = 1) FROM m"
    for name in [S.KEY, *S.MINUTES_COLUMNS]
)


def oracle_sql() -> dict[str, str]:
    minutes = _features(f"SELECT {MINUTES} FROM features")
    types = _features(f"SELECT {TYPES} FROM features")
    return {
        "flights_scan": _flights("SELECT * FROM flights"),
        "hour_buckets": _flights(f"SELECT flight_key, {HOURS} FROM flights"),
        "calendar_flags": _flights(f"SELECT flight_key, {FLAGS} FROM flights"),
        "weather_diffs": _flights(f"SELECT flight_key, {DIFFS} FROM flights"),
        "delay_labels": _flights(f"SELECT flight_key, {OCCURRED} FROM flights"),
        "carrier_counts": _flights(
            "SELECT uniquecarrier, count(*) AS carrier_count FROM flights GROUP BY uniquecarrier"
        ),
        "carrier_counts_kept": _flights(
            "SELECT uniquecarrier, count(*) AS carrier_count FROM flights GROUP BY uniquecarrier"
        ),
        "total_count": _flights("SELECT count(*) AS total_count FROM flights"),
        "frequency_encode": _features("SELECT flight_key, uniquecarrier_freq FROM features"),
        "snapshot_frequency": _features("SELECT flight_key, uniquecarrier_freq FROM features"),
        "features_minutes": minutes,
        "features_type": types,
        "feature_sql_text": _flights(
            "SELECT flight_key, uniquecarrier, count(*) OVER (PARTITION BY uniquecarrier) AS carrier_count,"
            " CAST(count(*) OVER (PARTITION BY uniquecarrier) AS DOUBLE) / count(*) OVER () AS uniquecarrier_freq"
            " FROM flights QUALIFY uniquecarrier IS NOT NULL"
        ),
        "table_refresh": types,
        "refresh_after_failure": types,
        "unload_roundtrip": minutes,
        "dropna_minutes": _features(f"SELECT {MINUTES} FROM features WHERE {_complete(S.MINUTES_COLUMNS)}"),
        "dropna_type": _features(f"SELECT {TYPES} FROM features WHERE {_complete(S.TYPE_COLUMNS)}"),
        "dropped_rows": _features(DROPPED),
        "total_delay_target": _features(
            f"SELECT flight_key, CAST(depdelay AS DOUBLE) + arrdelay AS total_delay FROM features"
            f" WHERE {_complete(S.MINUTES_COLUMNS)}"
        ),
        "dense_row_id": _features("SELECT flight_key, 1 AS in_range, 1 AS occurs_once FROM features"),
        "train_test_split": _features(
            f"SELECT flight_key, CASE WHEN {IS_TEST} THEN 1 ELSE 0 END AS is_test FROM features"
            f" WHERE {_complete(S.MINUTES_COLUMNS)}"
        ),
        "assembled_features": _features(
            f"SELECT flight_key, {VECTOR} FROM features WHERE {_complete(S.MINUTES_COLUMNS)}"
        ),
        "regression_metrics": _features(
            f", rows_used AS (SELECT CAST(depdelay AS DOUBLE) + arrdelay AS y, {RULE_MINUTES} AS p FROM features"
            f" WHERE {_complete(S.MINUTES_COLUMNS)} AND {IS_TEST}), spread AS (SELECT avg(y) AS mean FROM rows_used)"
            " SELECT count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 6) AS mse,"
            " round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,"
            " round(1 - sum((y - p) * (y - p)) / sum((y - mean) * (y - mean)), 6) AS r2 FROM rows_used, spread"
        ),
        "label_counts": _features(
            f", rows_used AS (SELECT * FROM features WHERE {_complete(S.FEATURES)} AND {IS_TEST})"
            f" SELECT label, tp, pred, support FROM ({LABEL_COUNTS})"
        ),
        "multilabel_report": _features(REPORT),
        "delay_minutes_predict": _features(
            f"SELECT flight_key, CAST(depdelay AS DOUBLE) + arrdelay AS total_delay, 1 AS prediction_is_finite,"
            f" CAST(0 AS DOUBLE) AS off_the_walk, CAST(100 AS BIGINT) AS trees FROM features WHERE {_complete(S.MINUTES_COLUMNS)} AND {IS_TEST}"
        ),
        "delay_minutes_eval": _features(
            f", rows_used AS (SELECT CAST(depdelay AS DOUBLE) + arrdelay AS y, {IS_TEST} AS is_test FROM features"
            f" WHERE {_complete(S.MINUTES_COLUMNS)}),"
            " known AS (SELECT avg(y) AS mean FROM rows_used WHERE NOT is_test)"
            " SELECT count(*) AS n, round(sqrt(avg((y - mean) * (y - mean))), 6) AS mean_rmse, 1 AS beats_mean"
            " FROM rows_used, known WHERE is_test"
        ),
        "warm_start_predict": _features(
            f"SELECT flight_key, CAST(depdelay AS DOUBLE) + arrdelay AS total_delay, 2 AS generations,"
            " CAST(200 AS BIGINT) AS trees, CAST(1 AS BIGINT) AS start_values, CAST(0 AS DOUBLE) AS off_the_walk,"
            f" 1 AS is_sum_of_parts FROM features WHERE {_complete(S.MINUTES_COLUMNS)} AND {IS_TEST}"
        ),
        "delay_type_predict": _features(
            f"SELECT flight_key, {_listed(S.LABELS)}, 1 AS predictions_are_flags,"
            " CAST(0 AS DOUBLE) AS off_the_walk, CAST(700 AS BIGINT) AS trees FROM features"
            f" WHERE {_complete(S.TYPE_COLUMNS)} AND {IS_TEST}"
        ),
        "delay_type_eval": _features(
            REPORT.rsplit("SELECT CAST(position", 1)[0]
            + "SELECT label, CAST(support AS BIGINT) AS support, round(f1, 6) AS rule_f1,"
            " 1 AS within_bounds, CASE WHEN label <> 'samples avg' THEN 1 END AS follows_from_counts,"
            " CASE WHEN label = 'micro avg' THEN 1 END AS models_beat_rules FROM report"
        ),
    }
