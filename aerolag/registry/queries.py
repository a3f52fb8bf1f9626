"""Queries over the driver's tables, one per operator of the jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.errors import PySparkException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolag import schema as S
from aerolag.models.assembly import VECTOR, assemble
from aerolag.models.minutes import MinutesModel, fit_minutes, load_minutes, save_minutes, score_minutes
from aerolag.models.types import (
    fit_types,
    load_types,
    predicted,
    save_types,
    score_margins,
    score_types,
    stored_classifiers,
)
from aerolag.models.walk import TREES, node_table, walk
from aerolag.operators.count_state import update_counts
from aerolag.operators.encoding import frequency_encode, row_count, value_counts
from aerolag.operators.metrics import label_counts as count_labels
from aerolag.operators.metrics import multilabel_report as report_labels
from aerolag.operators.metrics import regression_metrics as measure
from aerolag.operators.rows import dense_id, drop_incomplete, observe_incomplete
from aerolag.operators.split import hash_split, mark_test
from aerolag.operators.tables import drop_table, export_parquet, read_export, replace_table, run_sql
from aerolag.plans import features as P
from aerolag.sources.flights import flights_from_parquet
from aerolag.sources.order_flights import order_flights
from aerolag.sources.snapshot import snapshot
from aerolag.storage import scratch_path, stage

#: Folders of the models trained so far, by application, input and kind.
_stored: dict[tuple[str, str, str], str] = {}


def flights_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_flights(spark, sf_dir)


def hour_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_flights(spark, sf_dir).select(S.KEY, *P.hour_columns())


def calendar_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_flights(spark, sf_dir).select(S.KEY, *P.calendar_columns())


def weather_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_flights(spark, sf_dir).select(S.KEY, *P.weather_diff_columns())


def delay_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_flights(spark, sf_dir).select(S.KEY, *P.label_columns())


def carrier_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(order_flights(spark, sf_dir), "uniquecarrier", "carrier_count")


def carrier_counts_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier counts brought up to date three times: after some files, a replaced one, a removed and added ones."""
    path, state = scratch_path(spark, "growing-flights"), scratch_path(spark, "counts")
    flights = order_flights(spark, sf_dir).select(S.KEY, "uniquecarrier")
    part = F.pmod(F.crc32(F.col(S.KEY).cast("binary")), F.lit(4))
    rows = stage(flights.withColumn("part", part), "flights-in-parts")

    def put(name: str, condition: str) -> None:
        rows.filter(condition).drop("part").write.mode("overwrite").parquet(f"{path}/{name}")

    put("a", "part = 0")
    put("b", "part IN (1, 2, 3)")
    update_counts(spark, path, "uniquecarrier", state, "carrier_count")
    put("b", "part = 1")
    put("c", "part IN (0, 2)")
    update_counts(spark, path, "uniquecarrier", state, "carrier_count")
    put("c", "part = 2")
    put("d", "part = 3")
    return update_counts(spark, path, "uniquecarrier", state, "carrier_count").counts


def total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(order_flights(spark, sf_dir), "total_count")


def carrier_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = frequency_encode(order_flights(spark, sf_dir), "uniquecarrier", "uniquecarrier_freq")
    return encoded.select(S.KEY, "uniquecarrier_freq")


def snapshot_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier shares of a Parquet directory whose files are listed before the first pass and checked after the second."""
    path = scratch_path(spark, "flights")
    order_flights(spark, sf_dir).write.parquet(path)
    source = snapshot(spark, path)
    encoded = frequency_encode(flights_from_parquet(spark, path), "uniquecarrier", "uniquecarrier_freq")
    found = stage(encoded.select(S.KEY, "uniquecarrier_freq"), "shares")
    source.check()
    return found


def features_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.minutes_table(P.feature_frame(order_flights(spark, sf_dir)))


def features_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.type_table(P.feature_frame(order_flights(spark, sf_dir)))


def feature_sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, total and join of the carrier shares as one SQL statement."""
    text = """
        WITH seen AS (SELECT uniquecarrier, count(*) AS carried FROM {flights} GROUP BY uniquecarrier),
        shares AS (
            SELECT uniquecarrier, carried, carried / double((SELECT sum(carried) FROM seen)) AS share
            FROM seen WHERE uniquecarrier IS NOT NULL)
        SELECT f.flight_key, uniquecarrier, carried AS carrier_count, share AS uniquecarrier_freq
        FROM {flights} f JOIN shares USING (uniquecarrier)
    """
    return run_sql(spark, text, flights=order_flights(spark, sf_dir))


def table_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delay-type table built, built again in its place, and read back through the catalog."""
    path = scratch_path(spark, "delay-type")
    table = f"aerolag_{uuid.uuid4().hex}"
    rows = features_type(spark, sf_dir)
    replace_table(spark.createDataFrame([], rows.schema), table, path)
    found = replace_table(rows, table, path)
    # The scan is of the table's files, which outlive its entry in the catalog.
    drop_table(spark, table)
    return found


def refresh_after_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delay-type table after a rebuild that died midway: the rows from before, through the catalog."""
    path = scratch_path(spark, "delay-type")
    table = f"aerolag_{uuid.uuid4().hex}"
    rows = replace_table(features_type(spark, sf_dir), table, path)
    dies = F.when(F.crc32(F.col(S.KEY).cast("binary")) % 4 == 1, F.raise_error(F.lit("died midway")))
    try:
        replace_table(rows.withColumn(S.KEY, F.coalesce(dies.cast("string"), S.KEY)), table, path)
    except PySparkException:
        found = spark.read.table(table)
    else:
        raise RuntimeError("the rebuild did not die")
    drop_table(spark, table)
    return found


def unload_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delay-minutes table exported and read back."""
    frame = features_minutes(spark, sf_dir)
    path = scratch_path(spark, "unload-roundtrip")
    export_parquet(frame, path)
    return read_export(spark, path, frame.schema)


def dropna_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_incomplete(unload_roundtrip(spark, sf_dir))


def dropna_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_incomplete(stage(features_type(spark, sf_dir), "type-rows"))


def dropped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each column of the delay-minutes table makes incomplete, counted while the table is exported."""
    rows, incomplete = observe_incomplete(features_minutes(spark, sf_dir))
    export_parquet(rows, scratch_path(spark, "observed-export"))
    return incomplete.report(spark).drop("position")


def _minutes_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.minutes_target(dropna_minutes(spark, sf_dir))


def total_delay_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _minutes_rows(spark, sf_dir).select(S.KEY, "total_delay")


def dense_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the delay-type table: is the id within 1..N, and does it occur once?

    Which row gets which id is not defined.
    """
    numbered = dense_id(features_type(spark, sf_dir)).select(S.KEY, "id")
    rows = numbered.count()
    occurs = F.count("*").over(Window.partitionBy("id"))
    return numbered.select(
        S.KEY,
        F.col("id").between(1, rows).cast("int").alias("in_range"),
        (occurs == 1).cast("int").alias("occurs_once"),
    )


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_test(_minutes_rows(spark, sf_dir)).select(S.KEY, "is_test")


def assembled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vectors, taken apart again into named columns."""
    vectors = assemble(_minutes_rows(spark, sf_dir)).select(S.KEY, vector_to_array(VECTOR).alias("v"))
    return vectors.select(S.KEY, *[F.col("v")[i].alias(name) for i, name in enumerate(S.FEATURES)])


def _rounded(df: DataFrame) -> DataFrame:
    doubles = {name for name, kind in df.dtypes if kind == "double"}
    return df.select(*[F.round(name, 6).alias(name) if name in doubles else name for name in df.columns])


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a rule on the test rows."""
    _, test = hash_split(_minutes_rows(spark, sf_dir))
    ruled = test.withColumn("prediction", 4.0 * F.col("departure_hour") - 20.0)
    return _rounded(measure(ruled, "total_delay", "prediction"))


def _ruled_types(complete: DataFrame) -> tuple[DataFrame, list[str]]:
    _, test = hash_split(complete)
    names = [predicted(label) for label in S.LABELS]
    rules = [(F.col("departure_hour") >= 8 + i).cast("int").alias(name) for i, name in enumerate(names)]
    return test.select("*", *rules), names


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ruled, names = _ruled_types(dropna_type(spark, sf_dir))
    return count_labels(ruled, S.LABELS, names)


def multilabel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report of one rule per label on the test rows."""
    ruled, names = _ruled_types(dropna_type(spark, sf_dir))
    return _rounded(report_labels(ruled, S.LABELS, names))


def _model_key(spark: SparkSession, sf_dir: str, kind: str) -> tuple[str, str, str]:
    return (spark.sparkContext.applicationId, sf_dir, kind)


def _stored_model(spark: SparkSession, sf_dir: str, kind: str, train: Callable[[str], object]) -> str:
    """Folder of a model trained with full rounds; the queries of one session share it."""
    key = _model_key(spark, sf_dir, kind)
    if key not in _stored:
        path = scratch_path(spark, f"{kind}-model")
        train(path)
        _stored[key] = path
    return _stored[key]


def _minutes_model(spark: SparkSession, sf_dir: str, train: DataFrame) -> tuple[MinutesModel, str]:
    """The stored model of the training rows, and its folder."""
    path = _stored_model(spark, sf_dir, "minutes", lambda path: save_minutes(spark, fit_minutes(train), path))
    model = load_minutes(spark, path)
    return model, f"{path}/{model.folder}"


def _off_by(one: Column, other: Column) -> Column:
    """The difference of two scores, to nine digits."""
    return F.round(F.abs(one - other), 9)


def delay_minutes_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the test rows, held against a walk through the stored trees."""
    train, test = hash_split(_minutes_rows(spark, sf_dir))
    model, folder = _minutes_model(spark, sf_dir, train)
    walked = walk(test, node_table(spark, {"minutes": folder}))
    scored = score_minutes(model, test).join(walked, S.KEY)
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return scored.select(
        S.KEY,
        "total_delay",
        finite.cast("int").alias("prediction_is_finite"),
        _off_by(F.col("prediction"), F.col("score")).alias("off_the_walk"),
        "trees",
    )


def delay_minutes_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's error on the test rows against that of the training rows' mean."""
    train, test = hash_split(_minutes_rows(spark, sf_dir))
    mean = train.agg(F.avg("total_delay")).first()[0]
    scored = score_minutes(_minutes_model(spark, sf_dir, train)[0], test)

    def rmse(value: Column) -> Column:
        return F.sqrt(F.avg((F.col("total_delay") - value) * (F.col("total_delay") - value)))

    return scored.agg(
        F.count("*").alias("n"),
        F.round(rmse(F.lit(mean)), 6).alias("mean_rmse"),
        (rmse(F.col("prediction")) < rmse(F.lit(mean))).cast("int").alias("beats_mean"),
    )


def warm_start_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored model loaded, continued, stored, loaded and scored: one model of all trees, with one start value.

    The continued model is held against a walk through its stored trees, and against the first model's prediction
    plus the shrunken trees that were added.
    """
    train, test = hash_split(_minutes_rows(spark, sf_dir))
    first, _ = _minutes_model(spark, sf_dir, train)
    path = scratch_path(spark, "warm-model")
    save_minutes(spark, fit_minutes(train, replace(first, version=None)), path)
    both = load_minutes(spark, path)
    nodes = stage(node_table(spark, {"both": f"{path}/{both.folder}"}), "nodes")
    starts = nodes.filter("node = 0 AND weight = 1").count()
    added = nodes.filter(F.col("tree") >= len(first.model.trees)).withColumn("model", F.lit("added"))
    walked = walk(test, nodes.unionByName(added.withColumn("tree", F.col("tree") + TREES)))
    walked = walked.groupBy(S.KEY).agg(
        F.max(F.when(F.col("model") == "both", F.col("score"))).alias("whole"),
        F.max(F.when(F.col("model") == "added", F.col("score"))).alias("more"),
        F.max("trees").alias("trees"),
    )
    scored = score_minutes(first, score_minutes(both, test), "before").join(walked, S.KEY)
    return scored.select(
        S.KEY,
        "total_delay",
        F.lit(both.runs).alias("generations"),
        "trees",
        F.lit(starts).cast("long").alias("start_values"),
        _off_by(F.col("prediction"), F.col("whole")).alias("off_the_walk"),
        (F.abs(F.col("prediction") - F.col("before") - F.col("more")) < 1e-9).cast("int").alias("is_sum_of_parts"),
    )


def _types_model(spark: SparkSession, sf_dir: str, train: DataFrame) -> str:
    return _stored_model(spark, sf_dir, "types", lambda path: save_types(spark, fit_types(train), path))


def _types_scored(spark: SparkSession, sf_dir: str, complete: DataFrame) -> DataFrame:
    train, test = hash_split(complete)
    return score_types(load_types(spark, _types_model(spark, sf_dir, train)), test)


def delay_type_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of the test rows for all labels, held against a walk through the stored trees."""
    train, test = hash_split(dropna_type(spark, sf_dir))
    path = _types_model(spark, sf_dir, train)
    model = load_types(spark, path)
    margins = score_margins(model, test)
    walked = walk(test, node_table(spark, stored_classifiers(spark, path))).withColumnRenamed("model", "label")
    off = margins.join(walked, [S.KEY, "label"]).groupBy(S.KEY).agg(
        F.max(_off_by(F.col("margin"), F.col("score"))).alias("off_the_walk"), F.sum("trees").alias("trees")
    )
    flags = [F.col(predicted(label)).isin(0, 1) for label in S.LABELS]
    return score_types(model, test).join(off, S.KEY).select(
        S.KEY, *S.LABELS, reduce(and_, flags).cast("int").alias("predictions_are_flags"), "off_the_walk", "trees"
    )


def _lines_from_counts(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 (again_*) of labels and averages but the one over rows, from tp, pred and support."""
    kinds = {"precision": ("tp", "pred"), "recall": ("tp", "support"), "f1": ("2 * tp", "pred + support")}
    one = {k: f"if({d} = 0, 0D, double({n}) / ({d}))" for k, (n, d) in kinds.items()}
    whole = {k: one[k].replace("tp", "sum(tp)").replace("pred", "sum(pred)").replace("support", "sum(support)") for k in kinds}
    lines = counts.selectExpr("label", "support", *[f"{one[k]} AS again_{k}" for k in kinds])
    averages = [
        counts.selectExpr("'micro avg' AS label", *[f"{whole[k]} AS again_{k}" for k in kinds]),
        lines.selectExpr("'macro avg' AS label", *[f"avg(again_{k}) AS again_{k}" for k in kinds]),
        lines.selectExpr(
            "'weighted avg' AS label", *[f"sum(again_{k} * support) / sum(support) AS again_{k}" for k in kinds]
        ),
    ]
    return reduce(DataFrame.unionByName, averages, lines.drop("support"))


def delay_type_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 of one rule per label on the test rows, and what holds of the models' report.

    Whether its figures lie within 0 and 1, whether they follow from the models' counts (not for the average over
    rows, which does not), and whether the micro average beats the rules'.
    """
    names = [predicted(label) for label in S.LABELS]
    complete = dropna_type(spark, sf_dir)
    ruled, _ = _ruled_types(complete)
    rules = report_labels(ruled, S.LABELS, names).select("label", "support", F.col("f1").alias("rule_f1"))
    scored = stage(_types_scored(spark, sf_dir, complete).select(*S.LABELS, *names), "scored-types")
    figures = ["precision", "recall", "f1"]
    models = report_labels(scored, S.LABELS, names).drop("position", "support")
    again = _lines_from_counts(count_labels(scored, S.LABELS, names))
    joined = rules.join(models, "label").join(again, "label", "left")
    within = reduce(and_, [F.col(name).between(0, 1) for name in figures])
    follows = reduce(and_, [F.abs(F.col(name) - F.col(f"again_{name}")) < 1e-9 for name in figures])
    beats = F.when(F.col("label") == "micro avg", (F.col("f1") > F.col("rule_f1")).cast("int"))
    return joined.select(
        "label",
        "support",
        F.round("rule_f1", 6).alias("rule_f1"),
        within.cast("int").alias("within_bounds"),
        follows.cast("int").alias("follows_from_counts"),
        beats.alias("models_beat_rules"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "flights_scan": flights_scan,
        "hour_buckets": hour_buckets,
        "calendar_flags": calendar_flags,
        "weather_diffs": weather_diffs,
        "delay_labels": delay_labels,
        "carrier_counts": carrier_counts,
        "carrier_counts_kept": carrier_counts_kept,
        "total_count": total_count,
        "frequency_encode": carrier_frequency,
        "snapshot_frequency": snapshot_frequency,
        "features_minutes": features_minutes,
        "features_type": features_type,
        "feature_sql_text": feature_sql_text,
        "table_refresh": table_refresh,
        "refresh_after_failure": refresh_after_failure,
        "unload_roundtrip": unload_roundtrip,
        "dropna_minutes": dropna_minutes,
        "dropna_type": dropna_type,
        "dropped_rows": dropped_rows,
        "total_delay_target": total_delay_target,
        "dense_row_id": dense_row_id,
        "train_test_split": train_test_split,
        "assembled_features": assembled_features,
        "regression_metrics": regression_metrics,
        "label_counts": label_counts,
        "multilabel_report": multilabel_report,
        "delay_minutes_predict": delay_minutes_predict,
        "delay_minutes_eval": delay_minutes_eval,
        "warm_start_predict": warm_start_predict,
        "delay_type_predict": delay_type_predict,
        "delay_type_eval": delay_type_eval,
    }
