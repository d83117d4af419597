import uuid

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tidemark.operators import metrics, profile, split
from tidemark.operators.lookup import join_labels
from tidemark.operators.metrics import Threshold
from tidemark.plans import features, medallion, monitoring, scoring, training, validation
from tidemark.plans.training import train_trip_model
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources import sample_views as views
from tidemark.sources import tables
from tidemark.sources.feature_table import FeatureTable

PAIRS = [(3.0, 2.0), (5.0, 5.0), (1.0, 4.0), (None, 1.0), (1.0, None)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(PAIRS, "prediction double, target double")


def test_regression_metrics(scored):
    got = metrics.regression_metrics(scored, custom=metrics.CUSTOM_METRICS).first().asDict()
    assert got["example_count"] == 3 and got["max_error"] == 3.0 and got["sum_on_target"] == 11.0
    assert got["mean_absolute_error"] == pytest.approx(4 / 3)
    assert got["mean_squared_error"] == pytest.approx(10 / 3)
    assert got["root_mean_squared_error"] == pytest.approx((10 / 3) ** 0.5)
    assert got["r2_score"] == pytest.approx(1 - 10 / (14 / 3))
    assert got["mean_absolute_percentage_error"] == pytest.approx((0.5 + 0 + 0.75) / 3)
    assert got["squared_diff_plus_one"] == 4.0 + 1.0 + 4.0


def test_thresholds(scored):
    row = metrics.regression_metrics(scored)
    limits = {"max_error": Threshold(3.0), "mean_squared_error": Threshold(3.0), "r2_score": Threshold(-2.0, True)}
    assert {r["metric"]: r["passed"] for r in metrics.check_thresholds(row, limits).collect()} == {
        "max_error": True, "mean_squared_error": False, "r2_score": True,
    }


def test_run_modes(scored):
    validation.THRESHOLD_SETS["tight"] = {"max_error": Threshold(1.0)}
    assert validation.validate_predictions(scored, "target", "disabled").passed is None
    assert validation.validate_predictions(scored, "target", "enabled").passed is True
    assert validation.validate_predictions(scored, "target", "dry_run", thresholds="tight").passed is False
    with pytest.raises(validation.ValidationFailed, match="max_error"):
        validation.validate_predictions(scored, "target", "enabled", thresholds="tight")
    with pytest.raises(ValueError):
        validation.validate_predictions(scored, "target", "sometimes")
    with pytest.raises(KeyError):
        validation.validate_predictions(scored, "target", thresholds="unknown")


def test_baseline_comparison(spark, scored):
    validation.THRESHOLD_SETS["improve"] = {"mean_squared_error": Threshold(500.0, min_relative_change=0.5)}
    better = scored.withColumn("prediction", F.col("target"))
    assert validation.validate_predictions(better, "target", thresholds="improve", baseline=scored).passed is True
    with pytest.raises(validation.ValidationFailed, match="against baseline"):
        validation.validate_predictions(scored, "target", thresholds="improve", baseline=scored)


def test_changes_against_a_baseline(spark):
    frame = spark.createDataFrame(
        [("new", 8.0, 0.5, 0.0), ("old", 10.0, 0.5, 0.0)], "model_id string, mse double, r2 double, zero double"
    )

    def passed(**threshold):
        metric = threshold.pop("metric")
        rows_ = metrics.compare_models(frame, {metric: Threshold(**threshold)}, "new", "old").collect()
        return rows_[0]["passed"]

    assert passed(metric="mse") and passed(metric="mse", min_absolute_change=2.0)
    assert not passed(metric="mse", min_absolute_change=2.1)
    assert passed(metric="mse", min_relative_change=0.2) and not passed(metric="mse", min_relative_change=0.21)
    assert not passed(metric="r2", greater_is_better=True, min_absolute_change=0.01)
    assert not passed(metric="zero", min_relative_change=0.01)


def test_profile_all_models_row_equals_direct_metrics(spark):
    preds = views.predictions(spark, SMALL)
    got = profile.error_profile(preds).filter("model_id = '*'")
    direct = metrics.regression_metrics(
        preds.withColumn("window", F.window("timestamp", "1 day")), "prediction", "fare_amount", ["window"]
    )
    joined = got.alias("g").join(direct.alias("d"), "window")
    assert joined.count() == got.count() == direct.count()
    worst = joined.agg(
        F.max(F.abs(F.col("g.r2_score") - F.col("d.r2_score"))),
        F.max(F.abs(F.col("g.root_mean_squared_error") - F.col("d.root_mean_squared_error"))),
    ).first()
    assert worst[0] < 1e-9 and worst[1] < 1e-9


def metric_rows(spark, *data):
    """(day, model, rmse) as profile rows."""
    df = spark.createDataFrame(list(data), "day string, model_id string, root_mean_squared_error double")
    start = F.col("day").cast("timestamp")
    return df.select(
        F.struct(start.alias("start"), (start + F.expr("INTERVAL 1 DAY")).alias("end")).alias("window"),
        F.lit(":table").alias("column_name"), F.lit(None).cast("string").alias("slice_key"), "model_id",
        F.lit("INPUT").alias("log_type"), "root_mean_squared_error",
    )


@pytest.mark.parametrize(
    "values,expected",
    [
        ([150, 50, 150], 1),  # newest and one more above
        ([150, 50, 50], 0),  # newest below
        ([50, 50, 150], 0),  # only one above
        ([50, 100, 101], 0),  # equal is not above
        ([150, 150, 50, 50, 50, 50, 150], 0),  # the old ones are out of the last five
    ],
)
def test_violation_check(spark, values, expected):
    data = [(f"2024-01-{i + 1:02d}", "1", float(v)) for i, v in enumerate(values)]
    decoys = [("2024-02-01", "*", 999.0), ("2024-02-02", "*", 999.0)]
    check = profile.violation_check(metric_rows(spark, *data, *decoys))
    assert check.first()["query_result"] == expected and profile.is_violated(check) is bool(expected)


def test_violation_by_model(spark):
    data = [(f"2024-01-0{d}", m, v) for d in (1, 2, 3) for m, v in (("1", 150.0), ("2", 50.0))]
    assert rows(profile.violation_by_model(metric_rows(spark, *data)), "model_id") == [("1", 1), ("2", 0)]


def test_monitoring_of_a_named_table(spark):
    table = f"spark_catalog.mon_{uuid.uuid4().hex[:8]}.predictions"
    tables.write_named(views.predictions(spark, SMALL), table)
    assert monitoring.refresh_profile(spark, table) == f"{table}_profile_metrics"
    assert monitoring.must_retrain(spark, table, threshold=100.0) is False
    assert monitoring.must_retrain(spark, table, threshold=1.0) is True


def test_drift_is_zero_for_equal_shares_and_handles_all_null(spark):
    same = [(f"2024-01-0{d} 00:00:00", float(v)) for d in (1, 2) for v in (5, 15, 15, 30)]
    df = spark.createDataFrame([*same, ("2024-01-03 00:00:00", None)], "t string, v double")
    df = df.select(F.col("t").cast("timestamp").alias("t"), "v")
    got = profile.drift(df, "t", "v", [10, 20], "2024-01-02").orderBy("window").collect()
    # Smoothed by half a row per bucket, equal counts have equal shares.
    assert got[0]["stability_index"] == got[1]["stability_index"] == 0.0
    assert (got[1]["mean"], got[1]["percentile"], got[1]["nulls"]) == (16.25, 15.0, 0)
    assert (got[2]["rows"], got[2]["nulls"], got[2]["mean"], got[2]["percentile"]) == (1, 1, None, None)


def test_split_is_complete_and_repeatable(spark):
    df = spark.range(5000)
    train, test = split.hash_split(df, "id", 75, 123)
    assert train.count() + test.count() == 5000 and train.join(test, "id").isEmpty()
    assert 0.7 < train.count() / 5000 < 0.8
    no_key = spark.sql("SELECT CAST(NULL AS BIGINT) AS id")
    assert [part.count() for part in split.hash_split(no_key, "id")] == [1, 0]
    again, _ = split.hash_split(df.repartition(7), "id", 75, 123)
    assert again.exceptAll(train).isEmpty()


def test_one_row_hours_drop_from_sensor_training(spark):
    gold = medallion.medallion(views.readings(spark, SMALL), medallion.SLIDING_BATCH)
    assert training.sensor_training_rows(gold).count() == gold.filter("std_temp_1h IS NOT NULL").count()


def test_sensor_model(spark):
    gold = cut_lineage(medallion.medallion(views.readings(spark, "/root/testdata/sf0.01"), medallion.SLIDING_BATCH))
    model, scores, example = training.train_sensor_model(gold, trees=5)
    assert model.inputs == ["std_temp_1h", "mean_humidity_1h", "last_pressure_1h", "total_records_1h"]
    assert example.columns == model.inputs and example.count() <= 5
    assert scores.first()["root_mean_squared_error"] > 0


def test_trip_model_from_stored_features_to_predictions(spark):
    base = f"spark_catalog.trips_{uuid.uuid4().hex[:8]}"
    trips = views.trips(spark, SMALL)
    source = scratch_path(spark, "trips")
    trips.write.parquet(source)
    for label, ts in (("pickup", "tpep_pickup_datetime"), ("dropoff", "tpep_dropoff_datetime")):
        features.run_feature_job(spark, source, f"{base}.{label}", f"{label}_features", "zip", ts)
    lookups = training.trip_lookups(spark, f"{base}.pickup", f"{base}.dropoff")
    model, scores = training.train_trip_model(trips, lookups, rounds=5)
    spread = trips.agg(F.stddev("fare_amount")).first()[0]
    assert scores.first()["root_mean_squared_error"] < spread
    assert set(model.inputs) == {"pickup_zip", "dropoff_zip", "trip_distance", *training.PICKUP_FEATURES, *training.DROPOFF_FEATURES}

    path = scratch_path(spark, "model")
    model.save(spark, path, [f"{base}.pickup", f"{base}.dropoff"])
    tables.write_named(scoring.scoring_input(trips), f"{base}.scoring_input")
    out = scoring.predict_batch(spark, path, f"{base}.scoring_input", f"{base}.predictions", 7, "2024-02-01 11:00:00")
    assert out.count() == trips.count() and out.filter("prediction IS NULL").isEmpty()
    assert "fare_amount" not in out.columns and {r[0] for r in out.select("model_id").distinct().collect()} == {7}
    direct = model.score(scoring.scoring_input(trips)).select("trip_id", "prediction")
    assert direct.exceptAll(out.select("trip_id", "prediction")).isEmpty()
    scoring.predict_batch(spark, model, f"{base}.scoring_input", f"{base}.predictions", 8, "2024-02-02 11:00:00", "append")
    assert spark.table(f"{base}.predictions").count() == 2 * trips.count()

    known = trips.filter("trip_id % 2 = 0")
    labelled = scoring.label_predictions(spark, f"{base}.predictions", known, ["trip_id"], f"{base}.labelled")
    assert labelled.filter("fare_amount IS NOT NULL").count() == 2 * known.count()
    profiled = monitoring.refresh_profile(spark, f"{base}.labelled")
    days = {(r["window"].start.day, r["model_id"]) for r in spark.table(profiled).collect()}
    assert days == {(1, "7"), (2, "8"), (1, "*"), (2, "*")}
    assert monitoring.must_retrain(spark, f"{base}.labelled", threshold=0.0) is True
    before = rows(spark.table(profiled), "window", "model_id")
    monitoring.refresh_profile(spark, f"{base}.labelled", since="2024-02-02")
    assert rows(spark.table(profiled), "window", "model_id") == before
    with pytest.raises(ValueError, match="not the start"):
        monitoring.refresh_profile(spark, f"{base}.labelled", since="2024-02-01 05:00:00")

    tables.as_view(trips, "validation_trips")
    result = validation.validate_trip_model(spark, model, "SELECT * FROM validation_trips", run_mode="dry_run")
    assert result.metrics.first()["example_count"] == trips.count()


def test_missing_features_are_scored(spark):
    df = spark.createDataFrame([(float(i), None if i % 2 else float(i), float(i)) for i in range(40)], "a double, b double, y double")
    model = training.fit_boosted(df, "y", ["a", "b"], rounds=2)
    out = model.score(df)
    assert out.columns == ["a", "b", "y", "prediction"] and out.filter("prediction IS NULL").isEmpty()


def test_feature_table_lookup_uses_its_keys(spark):
    name = f"spark_catalog.look_{uuid.uuid4().hex[:8]}.pickup"
    rows_ = features.pickup_features(views.trips(spark, SMALL), "tpep_pickup_datetime")
    FeatureTable.create(spark, name, rows_, ["zip"], "tpep_pickup_datetime")
    lookup = FeatureTable(spark, name).lookup(training.PICKUP_FEATURES, ["pickup_zip"], "rounded_pickup_datetime")
    assert (list(lookup.primary_keys), lookup.timestamp_key) == (["zip"], "tpep_pickup_datetime")


def test_drift_sees_values_outside_all_edges_and_several_columns(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-01 06:00:00' + make_interval(0, 0, 0, i div 10) AS t, 500 + i % 10 AS v, "
        "CAST(NULL AS DOUBLE) AS w FROM (SELECT explode(sequence(0, 19)) AS i)"
    )
    got = profile.drift(df, "t", "v", [10, 200], "2024-01-02").orderBy("window").collect()
    assert [(r.rows, r.mean, r.percentile, r.stability_index) for r in got] == [(10, 504.5, 504.0, 0.0)] * 2
    noon = profile.drift(df, "t", "v", [10, 505], "2024-01-01 12:00:00").collect()
    assert all(abs(r.stability_index) < 1e-12 for r in noon)
    both = profile.drift_of_columns(df, "t", {"v": [10, 200], "w": [1]}, "2024-01-02").collect()
    assert sorted((r.column_name, r.nulls, r.percentile) for r in both) == [
        ("v", 0, 504.0), ("v", 0, 504.0), ("w", 10, None), ("w", 10, None)
    ]


def test_a_second_label_of_a_key_is_refused(spark):
    predictions = spark.createDataFrame([(1, 2.0)], "k long, prediction double")
    labels = spark.createDataFrame([(1, 3.0), (1, 4.0)], "k long, y double")
    with pytest.raises(Exception, match="duplicate"):
        join_labels(predictions, labels, ["k"], "y").collect()


def test_rows_without_a_key_are_split_and_trained_on(spark):
    trips = spark.sql(
        "SELECT timestamp'2022-01-12' + make_interval(0, 0, 0, 0, 0, i) AS tpep_pickup_datetime, "
        "timestamp'2022-01-12' + make_interval(0, 0, 0, 0, 0, i + 9) AS tpep_dropoff_datetime, "
        "94400 + i % 3 AS pickup_zip, 94400 AS dropoff_zip, 2L AS trip_distance, 100L + i % 7 AS fare_amount "
        "FROM (SELECT explode(sequence(1, 80)) AS i)"
    )
    _, scores = train_trip_model(trips, [], rounds=2)
    assert scores.first()["root_mean_squared_error"] < 50


def test_model_beats_the_mean_of_its_test_rows(spark):
    """The fare follows from the distance, so a few rounds must explain most of it."""
    train, test = split.hash_split(views.trips(spark, "/root/testdata/sf0.01"), "trip_id", 75, 123)
    model = training.fit_boosted(train, training.TRIP_LABEL, ["trip_distance"], rounds=3)
    scores = metrics.regression_metrics(model.score(test), "prediction", training.TRIP_LABEL).first()
    assert scores["r2_score"] > 0.5


def test_forest_rows_are_dealt_evenly(spark, monkeypatch):
    """However the rows come, each task of the fit has its share of them, and all are there."""
    seen, fit = [], training.Pipeline.fit
    monkeypatch.setattr(training.Pipeline, "fit", lambda self, df: seen.append(df) or fit(self, df))
    rows_ = spark.range(4000).coalesce(1).selectExpr("id % 97 + 0D AS `a b`", "id AS k", "id % 7 + 0D AS y")
    training.fit_forest(rows_, "y", ["a b"], trees=2)
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 2 * spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes)
    assert seen[0].exceptAll(rows_.select("a b", "y")).isEmpty() and sum(sizes) == 4000
