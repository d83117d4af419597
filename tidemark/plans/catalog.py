"""One query per operator, over the sample views."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.signals import synth_readings
from tidemark.functions.timekeys import epoch_seconds, from_epoch_seconds, month_key, round_to_minutes, weekend_flag
from tidemark.operators import filters, lookup, metrics, profile, quality, rescue, split
from tidemark.plans import features, medallion, monitoring, scoring, training, validation
from tidemark.plans.medallion import SLIDING_BATCH, SLIDING_STREAM, TUMBLING
from tidemark.session import cut_lineage, scratch_path
from tidemark.sources import sample_views as views
from tidemark.sources import tables
from tidemark.sources.feature_table import FeatureTable, merge_rows, unique_rows
from tidemark.sources.window_states import on_day
from tidemark.streaming import batches, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
RANGE = ("2024-01-10", "2024-01-20")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6, shift: float = 0.0) -> DataFrame:
    """Doubles at a fixed number of digits; floats widened first."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out: list[Column] = []
    for name, kind in kinds.items():
        c = F.col(name)
        if isinstance(kind, T.FloatType):
            c = F.round(c.cast("double"), 3)
        elif isinstance(kind, T.DoubleType):
            c = F.round(c + F.lit(shift) if shift else c, digits)
        elif isinstance(kind, T.TimestampType):
            c = c.cast("timestamp_ntz")
        out.append(c.alias(name))
    return df.select(*out)


def settled(df: DataFrame) -> DataFrame:
    """Eight digits, shifted off the rounding ties that means of cents end in."""
    return rounded(df, 8, 1.3e-10)


# --- scans and inputs -------------------------------------------------------------------


@query
def scan_by_path(spark: SparkSession, folder: str) -> DataFrame:
    return tables.read_path(spark, f"{folder}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")


@query
def scan_by_name(spark: SparkSession, folder: str) -> DataFrame:
    tables.as_view(views.trips(spark, folder), "trips")
    return tables.read_table(spark, "trips").drop("trip_distance")


@query
def sql_input(spark: SparkSession, folder: str) -> DataFrame:
    tables.as_view(views.trips(spark, folder), "trips")
    text = "SELECT pickup_zip, count(*) AS n, round(sum(fare_amount), 2) AS fares FROM trips GROUP BY pickup_zip"
    return tables.read_sql(spark, text)


# --- filters and columns ----------------------------------------------------------------


@query
def time_range_filter(spark: SparkSession, folder: str) -> DataFrame:
    kept = filters.time_range(views.trips(spark, folder), PICKUP, *RANGE)
    return kept.select("trip_id", PICKUP, "fare_amount")


@query
def open_range_filter(spark: SparkSession, folder: str) -> DataFrame:
    kept = filters.time_range(views.trips(spark, folder), PICKUP, "", RANGE[0])
    return kept.select("trip_id", PICKUP, "fare_amount")


@query
def plausibility_filter(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(filters.plausible(views.readings(spark, folder), filters.PLAUSIBLE_STRICT))


@query
def plausibility_wide(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(filters.plausible(views.readings(spark, folder), filters.PLAUSIBLE_WIDE))


@query
def drop_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    # Hours with one 5-minute row have no deviation and drop out.
    gold = medallion.medallion(views.readings(spark, folder), TUMBLING).drop("forecast_feature")
    return settled(gold.na.drop())


@query
def enforce_schema(spark: SparkSession, folder: str) -> DataFrame:
    readings = views.readings(spark, folder)
    holes = readings.withColumn("humidity", F.when(F.col("sensor_id") != 7, F.col("humidity")))
    return rounded(filters.enforce_schema(holes))


RESCUE_SCHEMA = (
    T.StructType()
    .add("event_id", T.LongType())
    .add("sensor_id", T.IntegerType())
    .add("temperature", T.DoubleType())
    .add("humidity", T.DoubleType())
)


def _json_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Readings as JSON texts; some are cut short, so that they are no valid document, and some
    have fields that no schema names."""
    event = F.col("event_id")
    readings = views.events(spark, folder).select(
        event,
        (F.col("user_id") % 50 + 1).cast("int").alias("sensor_id"),
        (F.col("value") - 10).alias("temperature"),
        (event % 100).cast("double").alias("humidity"),
    )
    cut_short = F.concat(F.lit('{"event_id": '), event.cast("string"))
    wider = F.to_json(F.struct("*", F.lit("east").alias("site"), (event % 3).alias("shift")))
    text = F.when(event % 97 == 0, cut_short).when(event % 50 == 1, wider).otherwise(F.to_json(F.struct("*")))
    return readings.select(text.alias("body"))


def _broken_readings(spark: SparkSession, folder: str) -> DataFrame:
    return _with_faults(views.readings(spark, folder))


def _with_faults(readings: DataFrame) -> DataFrame:
    """Readings of which some have an impossible sensor, no time or no temperature."""
    sensor = F.col("sensor_id")
    return readings.withColumns(
        {
            "event_time": F.when(sensor != 17, F.col("event_time")),
            "temperature": F.when(sensor != 19, F.col("temperature")),
            "sensor_id": F.when(sensor == 13, F.lit(13000)).otherwise(sensor),
        }
    )


@query
def rescue_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(filters.rescue_json(_json_rows(spark, folder), "body", RESCUE_SCHEMA))


NESTED_SCHEMA = (
    T.StructType()
    .add("event_id", T.LongType())
    .add("place", T.StructType().add("sensor_id", T.IntegerType()).add("zone", T.StructType().add("code", T.StringType())))
    .add("temperature", T.DoubleType())
    .add("levels", T.ArrayType(T.StructType().add("x", T.LongType())))
)


def _nested_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as nested JSON texts: some with unknown fields at any depth, some with single values
    of another kind, some cut short."""
    event = F.col("event_id").cast("string")
    zone = F.concat(F.lit('{"code":"z'), event, F.when(F.col("event_id") % 4 == 1, '","since":2020}').otherwise('"}'))
    sensor = F.when(F.col("event_id") % 6 == 2, F.lit('"north"')).otherwise((F.col("user_id") % 50 + 1).cast("string"))
    heat = F.when(F.col("event_id") % 10 == 3, F.lit('"hot"')).otherwise(F.floor("value").cast("string"))
    levels = F.when(F.col("event_id") % 9 == 4, F.lit('[{"x":1},{"x":2,"y":3}]')).otherwise('[{"x":5}]')
    text = F.concat(
        F.lit('{"event_id":'), event, F.lit(',"place":{"sensor_id":'), sensor, F.lit(',"zone":'), zone,
        F.lit('},"temperature":'), heat, F.lit(',"levels":'), levels,
        F.when(F.col("event_id") % 8 == 5, ',"site":{"east":true}}').otherwise("}"),
    )
    cut = F.when(F.col("event_id") % 97 == 0, F.concat(F.lit('{"event_id":'), event)).otherwise(text)
    return views.events(spark, folder).select(cut.alias("value"))


def _flat_places(df: DataFrame) -> DataFrame:
    return df.select(
        "event_id",
        F.col("place.sensor_id").alias("sensor_id"),
        F.col("place.zone.code").alias("code"),
        "temperature",
        F.array_join(F.transform("levels", lambda item: item["x"].cast("string")), ",").alias("levels"),
        "_rescued_data",
    )


@query
def rescue_nested(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_flat_places(rescue.rescue_document(_nested_texts(spark, folder), "value", NESTED_SCHEMA)))


@query
def stamp_constants(spark: SparkSession, folder: str) -> DataFrame:
    scored = views.predictions(spark, folder).select("trip_id", "prediction")
    return rounded(filters.stamp(scored, 3, "2024-02-01 11:00:00"))


# --- scalar functions -------------------------------------------------------------------


@query
def month_keys(spark: SparkSession, folder: str) -> DataFrame:
    trips = views.trips(spark, folder)
    return trips.select("trip_id", month_key(F.col(DROPOFF)).alias("yyyy_mm"))


@query
def weekend_flags(spark: SparkSession, folder: str) -> DataFrame:
    trips = views.trips(spark, folder)
    return trips.select("trip_id", weekend_flag(F.col(PICKUP)).alias("is_weekend"))


def _rounding(minutes: int, direction: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        at = round_to_minutes(F.col(PICKUP), minutes, direction)
        return views.trips(spark, folder).select("trip_id", at.alias("rounded_at"))

    return run


QUERIES["round_up_15"] = _rounding(15, "up")
QUERIES["round_up_30"] = _rounding(30, "up")
QUERIES["round_up_45"] = _rounding(45, "up")
QUERIES["round_down_15"] = _rounding(15, "down")


@query
def epoch_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    seconds = epoch_seconds(F.col(PICKUP))
    return views.trips(spark, folder).select(
        "trip_id", seconds.alias("seconds"), from_epoch_seconds(seconds).cast("timestamp_ntz").alias("at")
    )


@query
def rounded_trips(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(training.rounded_trips(views.trips(spark, folder)))


@query
def synth_wave(spark: SparkSession, folder: str) -> DataFrame:
    ticks = views.events(spark, folder).select(F.col("ts").alias("timestamp"), F.col("event_id").alias("value"))
    return rounded(synth_readings(ticks))


# --- time-window features ---------------------------------------------------------------


@query
def pickup_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.pickup_features(views.trips(spark, folder), PICKUP))


@query
def pickup_features_in_range(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.pickup_features(views.trips(spark, folder), PICKUP, *RANGE))


@query
def dropoff_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.dropoff_features(views.trips(spark, folder), DROPOFF))


@query
def sensor_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.sensor_features(views.readings(spark, folder), "event_time"))


# --- sensor layers ----------------------------------------------------------------------


@query
def bronze_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(medallion.bronze(_broken_readings(spark, folder), TUMBLING))


@query
def silver_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return settled(medallion.silver(views.readings(spark, folder), SLIDING_BATCH))


@query
def silver_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    return settled(medallion.silver(views.readings(spark, folder), TUMBLING))


@query
def gold_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return settled(medallion.medallion(views.readings(spark, folder), SLIDING_BATCH))


@query
def gold_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    return settled(medallion.medallion(views.readings(spark, folder), TUMBLING).drop("forecast_feature"))


@query
def gold_forecast(spark: SparkSession, folder: str) -> DataFrame:
    gold = medallion.medallion(views.readings(spark, folder), TUMBLING)
    # Means of cents end in rounding ties; a small shift takes them off.
    shifted = F.round(F.col("forecast_feature") + F.lit(0.000013), 3)
    return gold.select("sensor_id", "event_time", shifted.alias("forecast_feature"))


@query
def gold_from_stored_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Overwrite silver by month at a path, read the path back, compute gold from it."""
    path = scratch_path(spark, "silver")
    tables.overwrite_path(medallion.silver(views.readings(spark, folder), TUMBLING), path)
    silver = spark.read.option("basePath", path).parquet(path)
    return settled(medallion.gold(silver, TUMBLING).drop("forecast_feature"))


# --- quality rules ----------------------------------------------------------------------


@query
def expect_report(spark: SparkSession, folder: str) -> DataFrame:
    rules = [*quality.BRONZE_RULES, *quality.SILVER_WARN_RULES, *quality.SILVER_DROP_RULES]
    return quality.report(_broken_readings(spark, folder), rules)


@query
def expect_drop(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quality.expect(_broken_readings(spark, folder), quality.SILVER_DROP_RULES))


@query
def expect_keep(spark: SparkSession, folder: str) -> DataFrame:
    """Warn rules keep every row; the counts are those taken on the way, next to the rows that came out."""
    seen = Observation()
    out = quality.expect(_broken_readings(spark, folder), quality.SILVER_WARN_RULES, seen)
    kept = out.agg(F.count(F.lit(1)).alias("kept")).first()
    return spark.createDataFrame([{"kept": kept["kept"], **seen.get}])


# --- point-in-time lookup ---------------------------------------------------------------


def _lookups(spark: SparkSession, folder: str) -> list[lookup.FeatureLookup]:
    trips = views.trips(spark, folder)
    return [
        training.pickup_lookup(features.pickup_features(trips, PICKUP), PICKUP),
        training.dropoff_lookup(features.dropoff_features(trips, DROPOFF), DROPOFF),
    ]


@query
def lookup_pickup(spark: SparkSession, folder: str) -> DataFrame:
    trips = training.rounded_trips(views.trips(spark, folder)).select("trip_id", "pickup_zip", "rounded_pickup_datetime")
    return rounded(lookup.lookup_features(trips, _lookups(spark, folder)[:1]))


@query
def lookup_dropoff(spark: SparkSession, folder: str) -> DataFrame:
    trips = training.rounded_trips(views.trips(spark, folder)).select("trip_id", "dropoff_zip", "rounded_dropoff_datetime")
    return rounded(lookup.lookup_features(trips, _lookups(spark, folder)[1:]))


@query
def lookup_exact_times(spark: SparkSession, folder: str) -> DataFrame:
    """Unrounded lookup times: almost every instant is distinct."""
    trips = views.trips(spark, folder)
    found = lookup.FeatureLookup(
        features.pickup_features(trips, PICKUP), training.PICKUP_FEATURES, ("pickup_zip",), PICKUP, ("zip",), PICKUP
    )
    return rounded(lookup.lookup_features(trips.select("trip_id", "pickup_zip", PICKUP), [found]))


@query
def lookup_hot_key(spark: SparkSession, folder: str) -> DataFrame:
    """All trips of one key: its newest rows are carried from task to task."""
    trips = views.trips(spark, folder).withColumn("k", F.lit(1))
    told = trips.where("trip_id % 5 = 0").groupBy("k", PICKUP).agg(F.max("fare_amount").alias("fare"), F.max("trip_id").alias("told_by"))
    found = lookup.FeatureLookup(told, ("fare", "told_by"), ("k",), PICKUP, ("k",), PICKUP)
    return rounded(lookup.lookup_features(trips.select("trip_id", "k", PICKUP), [found]).drop("k"))


@query
def training_set(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(training.trip_training_set(views.trips(spark, folder), _lookups(spark, folder)))


@query
def training_set_no_leak(spark: SparkSession, folder: str) -> DataFrame:
    """Lookup times rounded down: only windows that closed before the trip are seen."""
    return rounded(training.trip_training_set(views.trips(spark, folder), _lookups(spark, folder), "down"))


# --- keyed upsert -----------------------------------------------------------------------


@query
def upsert_features(spark: SparkSession, folder: str) -> DataFrame:
    """Features of the whole month, then those of a date range upserted over them."""
    trips = views.trips(spark, folder)
    current = features.pickup_features(trips, PICKUP, "", RANGE[1])
    incoming = features.pickup_features(trips, PICKUP, RANGE[0], "")
    keys = ["zip", PICKUP]
    return rounded(merge_rows(current, cut_lineage(unique_rows(incoming, keys)), keys))


@query
def feature_table_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The same, through a stored feature table: create, upsert twice, read back."""
    trips = views.trips(spark, folder)
    current = features.pickup_features(trips, PICKUP, "", RANGE[1])
    name, path = f"default.pickup_{uuid.uuid4().hex}", scratch_path(spark, "table")
    table = FeatureTable.create(spark, name, current, ["zip"], PICKUP, path)
    table.merge(current)
    table.merge(features.pickup_features(trips, PICKUP, RANGE[0], ""))
    stored = tables.read_path(spark, path, schema=table.read().schema)
    spark.sql(f"DROP TABLE {name}")  # the catalog entry only; the files stay at their path
    return rounded(stored)


@query
def upsert_new_column(spark: SparkSession, folder: str) -> DataFrame:
    """An upsert with a column that the stored table lacks: older rows get a null there."""
    trips = views.trips(spark, folder)
    current = features.pickup_features(trips, PICKUP, "", RANGE[1])
    incoming = features.pickup_features(trips, PICKUP, RANGE[0], "")
    name, path = f"default.wider_{uuid.uuid4().hex}", scratch_path(spark, "table")
    table = FeatureTable.create(spark, name, current, ["zip"], PICKUP, path)
    table.merge(current)
    table.merge(incoming.withColumn("zip_group", (F.col("zip") % 7).cast("int")))
    stored = tables.read_path(spark, path, schema=table.read().schema)
    spark.sql(f"DROP TABLE {name}")
    return rounded(stored)


@query
def feature_job_in_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The stored job run over two neighbouring ranges; one run over everything gives the same."""
    source, name = scratch_path(spark, "trips"), f"default.parts_{uuid.uuid4().hex}"
    views.trips(spark, folder).write.parquet(source)
    for start, end in ((None, "2024-01-10 12:10:00"), ("2024-01-10 12:10:00", None)):
        table = features.run_feature_job(spark, source, name, "pickup_features", "zip", PICKUP, start, end)
    stored = cut_lineage(table.read(), "parts")
    spark.sql(f"DROP TABLE {name}")
    return rounded(stored)


@query
def full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """A stored feature table replaced as a whole: rows of other months do not stay."""
    trips = views.trips(spark, folder)
    later = trips.withColumn(PICKUP, F.col(PICKUP) + F.expr("INTERVAL 90 DAYS"))
    name, path = f"default.fresh_{uuid.uuid4().hex}", scratch_path(spark, "table")
    table = FeatureTable.create(spark, name, features.pickup_features(later, PICKUP), ["zip"], PICKUP, path)
    table.merge(features.pickup_features(later, PICKUP))
    table.overwrite(features.find_feature_set("pickup_features")(trips, PICKUP, None, None))
    stored = tables.read_path(spark, path, schema=table.read().schema)
    spark.sql(f"DROP TABLE {name}")
    return rounded(stored)


@query
def named_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A path registered under a name, its rows appended to an empty typed table, read by name."""
    path, tag = scratch_path(spark, "preds"), uuid.uuid4().hex
    predicted = views.predictions(spark, folder)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in tables.PREDICTIONS_SCHEMA]
    predicted.select(*columns).write.parquet(path)
    registered = tables.register_path(spark, f"default.path_{tag}", path)
    tables.create_empty_table(spark, f"default.typed_{tag}")
    registered.write.insertInto(f"default.typed_{tag}")
    tables.write_named(tables.read_table(spark, f"default.typed_{tag}").where("model_id = 1"), f"default.named_{tag}")
    stored = cut_lineage(tables.read_table(spark, f"default.named_{tag}"), "named")
    for kind in ("path", "typed", "named"):
        spark.sql(f"DROP TABLE default.{kind}_{tag}")
    return rounded(stored)


@query
def hash_split_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Split of rows that have no key: both parts together, and how a repeated row falls."""
    trips = views.trips(spark, folder).drop("trip_id")
    train, test = split.hash_split(trips)
    both = train.select(F.lit(1).alias("n")).union(test.select(F.lit(1)))
    apart = train.intersect(test).agg(F.count(F.lit(1)).alias("in_both"))
    near = (F.abs(F.try_divide(F.lit(train.count()), F.lit(trips.count())) - 0.75) < 0.05).alias("near_75")
    return both.agg(F.sum("n").alias("rows")).select("rows", apart.scalar().alias("in_both"), near)


# --- split, scoring input, labels -------------------------------------------------------


@query
def hash_split_75(spark: SparkSession, folder: str) -> DataFrame:
    trips = views.trips(spark, folder)
    return trips.select("trip_id", split.is_train(F.col("trip_id"), 75, 123).alias("in_train"))


@query
def hash_split_80(spark: SparkSession, folder: str) -> DataFrame:
    train, test = split.hash_split(views.trips(spark, folder), "trip_id", 80, 42)
    return train.select("trip_id", F.lit("train").alias("part")).unionByName(
        test.select("trip_id", F.lit("test").alias("part"))
    )


@query
def score_prepare(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scoring.scoring_input(views.trips(spark, folder)))


@query
def score_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Rows to score with the lookups of training repeated on them."""
    rows = scoring.scoring_input(views.trips(spark, folder))
    return rounded(lookup.lookup_features(rows, _lookups(spark, folder)))


@query
def label_join(spark: SparkSession, folder: str) -> DataFrame:
    predicted = views.predictions(spark, folder).drop("fare_amount")
    # Labels have come in for the trips picked up before a date.
    truth = filters.time_range(views.trips(spark, folder), PICKUP, "", RANGE[1])
    return rounded(lookup.join_labels(predicted, truth, ["trip_id"], "fare_amount"))


# --- evaluation -------------------------------------------------------------------------


@query
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.regression_metrics(views.predictions(spark, folder), "prediction", "fare_amount"))


@query
def squared_diff_plus_one(spark: SparkSession, folder: str) -> DataFrame:
    row = metrics.regression_metrics(
        views.predictions(spark, folder), "prediction", "fare_amount", custom=metrics.CUSTOM_METRICS
    )
    return rounded(row.select("squared_diff_plus_one"), 4)


@query
def threshold_gate(spark: SparkSession, folder: str) -> DataFrame:
    row = metrics.regression_metrics(views.predictions(spark, folder), "prediction", "fare_amount")
    return rounded(metrics.check_thresholds(row))


@query
def baseline_compare(spark: SparkSession, folder: str) -> DataFrame:
    rows = metrics.regression_metrics(views.predictions(spark, folder), "prediction", "fare_amount", by=["model_id"])
    limits = {
        "max_error": metrics.Threshold(500.0),
        "mean_squared_error": metrics.Threshold(500.0, min_relative_change=0.01),
        "r2_score": metrics.Threshold(greater_is_better=True, min_absolute_change=0.0001),
    }
    return rounded(metrics.compare_models(rows, limits, candidate=2, baseline=1))


@query
def validation_modes(spark: SparkSession, folder: str) -> DataFrame:
    """What a validation run says in each of its modes, with limits and metrics taken by name."""
    lines = []
    for mode in validation.RUN_MODES:
        try:
            result = validation.validate_predictions(views.predictions(spark, folder), "fare_amount", mode)
            checks = result.checks.count() if result.checks is not None else 0
            lines.append((mode, checks, result.passed, False))
        except validation.ValidationFailed:
            lines.append((mode, 0, False, True))
    return spark.createDataFrame(lines, "mode string, checks int, passed boolean, refused boolean")


# --- monitoring -------------------------------------------------------------------------


def _flat(df: DataFrame) -> DataFrame:
    out = df.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
    return rounded(out.drop("window"))


@query
def profile_by_day_model(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(profile.error_profile(views.predictions(spark, folder)))


@query
def recent_windows(spark: SparkSession, folder: str) -> DataFrame:
    return _flat(profile.recent_windows(profile.error_profile(views.predictions(spark, folder))))


def _check(threshold: float) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return profile.violation_check(profile.error_profile(views.predictions(spark, folder)), threshold=threshold)

    return run


QUERIES["violation_check"] = _check(100.0)
QUERIES["violation_check_low_limit"] = _check(3.0)


@query
def violation_by_model(spark: SparkSession, folder: str) -> DataFrame:
    return profile.violation_by_model(profile.error_profile(views.predictions(spark, folder)), threshold=5.4)


@query
def drift_by_day(spark: SparkSession, folder: str) -> DataFrame:
    holes = views.trips(spark, folder).withColumn(
        "fare_amount", F.when(F.col("trip_id") % 11 != 0, F.col("fare_amount"))
    )
    return _flat(profile.drift(holes, PICKUP, "fare_amount", [10, 25, 50, 100, 200], RANGE[0]))


@query
def profile_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """A stored profile brought up to date from one day on; the same as one over everything."""
    name = f"default.preds_{uuid.uuid4().hex}"
    rows = views.predictions(spark, folder)
    tables.write_named(filters.time_range(rows, "timestamp", None, "2024-01-15 12:00:00"), name)
    monitoring.refresh_profile(spark, name)
    tables.write_named(filters.time_range(rows, "timestamp", "2024-01-15 12:00:00"), name, "append")
    target = monitoring.refresh_profile(spark, name, since="2024-01-15")
    stored = cut_lineage(tables.read_table(spark, target), "profile")
    for table in (name, target):
        spark.sql(f"DROP TABLE {table}")
    return _flat(stored)


def _in_parts(rows: DataFrame, parts: int) -> list[DataFrame]:
    """The rows dealt out by hash: each part has all days."""
    part = F.pmod(F.xxhash64("trip_id"), F.lit(parts))
    return [rows.where(part == n) for n in range(parts)]


@query
def profile_from_states(spark: SparkSession, folder: str) -> DataFrame:
    """A profile from stored sums of three batches that each have all days; one of them comes twice."""
    states = monitoring.profile_states(spark, scratch_path(spark, "states"))
    for n, part in enumerate(_in_parts(views.predictions(spark, folder), 3)):
        monitoring.add_predictions(states, part, n)
        if n == 1:
            monitoring.add_predictions(states, part, n)
    return _flat(profile.profile_of_states(states.windows()))


@query
def drift_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Drift of two columns from the stored sketches of two runs, of which the second reads its own rows only."""
    trips = views.trips(spark, folder)
    holes = trips.withColumn("fare_amount", F.when(F.col("trip_id") % 11 != 0, F.col("fare_amount")))
    columns = ["fare_amount", "trip_distance"]
    states = monitoring.drift_states(spark, scratch_path(spark, "sketches"), columns)
    for n, part in enumerate(_in_parts(holes, 2)):
        states.add(part, PICKUP, n)
    found = profile.drift_of_sketches(states.windows(), columns, RANGE[0])
    return settled(found.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window"))


# --- models: what SQL can repeat of their test rows ---------------------------------------


def _test_summary(scores: DataFrame) -> DataFrame:
    """Which rows were tested, and the error of the mean of their labels, as the model's metrics have it."""
    return scores.select(
        "example_count",
        F.round("sum_on_target", 2).alias("label_sum"),
        F.round("mean_on_target", 4).alias("label_mean"),
        F.round(F.try_divide(F.col("mean_squared_error"), 1 - F.col("r2_score")), 4).alias("error_of_mean"),
    )


@query
def train_score_forest(spark: SparkSession, folder: str) -> DataFrame:
    gold = cut_lineage(medallion.medallion(views.readings(spark, folder), SLIDING_BATCH), "gold")
    _, scores, _ = training.train_sensor_model(gold)
    return _test_summary(scores)


@query
def train_score_boosted(spark: SparkSession, folder: str) -> DataFrame:
    _, scores = training.train_trip_model(views.trips(spark, folder), _lookups(spark, folder))
    return _test_summary(scores)


@query
def training_example(spark: SparkSession, folder: str) -> DataFrame:
    """The input example that is kept beside the forest: the first test rows by key."""
    rows = training.sensor_training_rows(medallion.medallion(views.readings(spark, folder), SLIDING_BATCH))
    _, test = split.hash_split(rows, "row_key", 80, 42)
    inputs = training.features_of(rows, training.SENSOR_LABEL, ("row_key",))
    return settled(training.input_example(test, "row_key", inputs))


@query
def score_table(spark: SparkSession, folder: str) -> DataFrame:
    """Train on looked-up features, save, load, and score a named table with the saved lookups; what is stored."""
    trips, tag = views.trips(spark, folder), uuid.uuid4().hex
    names = [f"default.pickup_{tag}", f"default.dropoff_{tag}"]
    stored = (features.pickup_features(trips, PICKUP), PICKUP), (features.dropoff_features(trips, DROPOFF), DROPOFF)
    for name, (rows, at) in zip(names, stored, strict=True):
        FeatureTable.create(spark, name, rows, ["zip"], at, scratch_path(spark, "table")).merge(rows)
    lookups = training.trip_lookups(spark, *names)
    rows = cut_lineage(training.trip_training_set(trips, lookups), "training")
    inputs = training.features_of(rows, training.TRIP_LABEL, ("trip_id",))
    path, asked, scored = scratch_path(spark, "model"), f"default.asked_{tag}", f"default.scored_{tag}"
    training.fit_forest(rows, training.TRIP_LABEL, inputs, lookups=lookups).save(spark, path, names)
    tables.write_named(scoring.scoring_input(trips), asked)
    out = scoring.predict_batch(spark, path, asked, scored, 7, "2024-02-01 11:00:00")
    summary = out.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("prediction").isNull()).alias("without_prediction"),
        F.sum("count_trips_window_1h_pickup_zip").cast("long").alias("looked_up"),
        F.countDistinct("trip_id").alias("trips"),
        F.min("model_id").cast("int").alias("model_id"),
        F.max("timestamp").cast("timestamp_ntz").alias("timestamp"),
    )
    stored = cut_lineage(summary, "scored")
    for table in (asked, scored, *names):
        spark.sql(f"DROP TABLE {table}")
    return stored


# --- streams ----------------------------------------------------------------------------


def _readings_stream(spark: SparkSession, folder: str) -> DataFrame:
    # A pattern, so that both a single file and a folder of files are found.
    path = f"{folder}/events.parque[t]"
    return views.readings_of(streams.file_stream(spark, path, views.events(spark, folder).schema))


def _run_to_end(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    streams.run_bounded(streams.append_sink(stream, f"{path}/rows", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/rows")


@query
def stream_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """Every event once through a file stream and the first layer's rules into the bronze files."""
    return rounded(_run_to_end(spark, medallion.bronze(_with_faults(_readings_stream(spark, folder)), TUMBLING), "bronze"))


@query
def stream_json_rescue(spark: SparkSession, folder: str) -> DataFrame:
    """JSON files as a stream, with the texts that do not fit kept in a column of their own."""
    source = scratch_path(spark, "json")
    _json_rows(spark, folder).write.text(source)
    stream = streams.file_stream(spark, source, RESCUE_SCHEMA, "json", rescued=True)
    return rounded(_run_to_end(spark, stream, "rescued"))


@query
def stream_rescue_nested(spark: SparkSession, folder: str) -> DataFrame:
    """Nested JSON files as a stream, with what does not fit kept by its path."""
    source = scratch_path(spark, "json")
    _nested_texts(spark, folder).write.text(source)
    stream = streams.document_stream(spark, source, NESTED_SCHEMA)
    return rounded(_flat_places(_run_to_end(spark, stream, "rescued")))


@query
def stream_stored_silver(spark: SparkSession, folder: str) -> DataFrame:
    """A stored layer read as a stream, appended file by file, and read again as a table."""
    path = scratch_path(spark, "silver")
    tables.overwrite_path(medallion.silver(views.readings(spark, folder), TUMBLING), path)
    return settled(_run_to_end(spark, streams.stored_stream(spark, path), "again"))


@query
def stream_silver_closed(spark: SparkSession, folder: str) -> DataFrame:
    """The windows a stream has closed: those that end at or before the watermark."""
    stream = streams.silver_stream(_readings_stream(spark, folder), SLIDING_STREAM, "10 minutes")
    return settled(_run_to_end(spark, stream, "silver"))


def _shuffled_files(rows: DataFrame, files: int) -> str:
    """The rows as so many files, each with rows of the whole time range."""
    path = scratch_path(rows.sparkSession, "files")
    for n in range(files):
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(files)) == n
        rows.where(part).coalesce(1).write.mode("append").parquet(path)
    return path


@query
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Silver of a stream whose every file has readings of all days, and whose last batch comes twice."""
    source, path = _shuffled_files(views.readings(spark, folder), 4), scratch_path(spark, "late")
    readings = views.readings(spark, folder)
    stream = streams.file_stream(spark, source, readings.schema, max_files_per_trigger=1)
    sink = streams.late_silver_sink(stream, f"{path}/states", f"{path}/silver", f"{path}/checkpoint", TUMBLING)
    streams.run_bounded(sink)
    again = readings.where(F.pmod(F.xxhash64(*readings.columns), F.lit(4)) == 3)
    states = streams.silver_states(spark, f"{path}/states", TUMBLING)
    days = states.add(medallion.clean_readings(again, TUMBLING), "event_time", 3)
    silver = medallion.silver_columns(states.windows(days), TUMBLING).withColumn("on_day", on_day(F.col("event_time")))
    tables.overwrite_path(silver, f"{path}/silver", ("yyyy_mm", "on_day"), only_touched=True)
    return settled(spark.read.parquet(f"{path}/silver").drop("on_day"))


@query
def stream_rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows checked and failed by rule over all batches of a stream, next to the rows that came out."""
    source, path = _shuffled_files(_broken_readings(spark, folder), 6), scratch_path(spark, "counted")
    stream = streams.file_stream(spark, source, _broken_readings(spark, folder).schema, max_files_per_trigger=1)
    write = batches.dated_writer(f"{path}/rows", "event_time", f"{path}/checkpoint", TUMBLING.bronze_rules)
    streams.run_bounded(batches.batch_sink(stream, write, f"{path}/checkpoint"))
    counts = batches.rule_counts(spark, f"{path}/checkpoint")
    out = spark.read.parquet(f"{path}/rows")
    return out.agg(F.count(F.lit(1)).alias("kept"), F.count_distinct("batch").alias("batches")).select(
        "kept", "batches", *[F.lit(n).cast("long").alias(c) for c, n in counts.items()]
    )


LABEL_DELAY, LABEL_BOUND = "1 hour", "2 hours"


@query
def stream_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions with the labels that come within two hours, some twice, some late, some never."""
    # A pattern, so that both a single file and a folder of files are found.
    path = f"{folder}/events.parque[t]"
    predicted = views.predictions_of(streams.file_stream(spark, path, views.events(spark, folder).schema))
    labels = _late_labels(views.events(spark, folder))
    stored = scratch_path(spark, "labels")
    labels.write.parquet(stored)
    told = streams.file_stream(spark, stored, labels.schema)
    zoned = predicted.select("trip_id", "prediction", F.col("timestamp").cast("timestamp"))
    joined = streams.label_stream(
        zoned, told, "trip_id", "fare_amount", "timestamp", "labelled_at", LABEL_BOUND, LABEL_DELAY
    )
    return rounded(_run_to_end(spark, joined, "labelled"))


def _late_labels(events: DataFrame) -> DataFrame:
    """Labels 0 to 179 minutes after the prediction; none for every fifth, the same twice for some."""
    event = F.col("event_id")
    at = (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), (event % 180).cast("int"))).cast("timestamp")
    told = events.where(event % 5 != 0).select(event.alias("trip_id"), F.col("value").alias("fare_amount"), at.alias("labelled_at"))
    return told.unionByName(told.where("trip_id % 7 = 1"))


@query
def stream_rate(spark: SparkSession, folder: str) -> DataFrame:
    """All events replayed by a clocked counter in a continuous run, which ends when the last has come."""
    events = views.events(spark, folder)
    last = events.agg(F.max("event_id")).first()[0] or 0
    per_batch = last // RATE_BATCHES + 1
    ticks = streams.clocked_ticks(spark, per_batch, RATE_START, RATE_ADVANCE)
    told = events.select("event_id", F.col("value").alias("fare"))
    replayed = ticks.join(told, F.col("value") == F.col("event_id")).select("event_id", "timestamp", "fare")
    path = scratch_path(spark, "rate")
    running = streams.append_sink(replayed, f"{path}/rows", f"{path}/checkpoint", every="100 milliseconds")
    streams.run_until(running, lambda: _ticks_done(running) > last, seconds=600)
    return rounded(spark.read.parquet(f"{path}/rows"))


RATE_BATCHES, RATE_START, RATE_ADVANCE = 6, 1_700_000_000_000, 60_000


def _ticks_done(running: StreamingQuery) -> int:
    """How many counters have been written."""
    done = running.lastProgress
    return json.loads(done.json)["sources"][0]["endOffset"]["offset"] if done else 0


@query
def refresh_from_month(spark: SparkSession, folder: str) -> DataFrame:
    """A stored sensor job refreshed from a month on, after readings of that month came and those of the next went."""
    readings = views.readings(spark, folder).withColumn("event_time", F.col("event_time").cast("timestamp"))
    base, schema_name = scratch_path(spark, "job"), f"refresh_{uuid.uuid4().hex}"
    later = readings.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 31 DAYS"))
    gone = readings.withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 62 DAYS"))

    def run(month: str | None = None) -> DataFrame:
        source = streams.file_stream(spark, f"{base}/source", readings.schema)
        return streams.run_sensor_job(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/gold", f"{base}/check", TUMBLING,
            source=source, every=None, seconds=None, schema_name=schema_name, refresh_from=month,
        )

    readings.unionByName(gone).write.parquet(f"{base}/source")
    run()
    tables.drop_partitions(spark, f"{base}/bronze", "on_day", lambda day: day >= "2024-03")
    later.write.mode("append").parquet(f"{base}/source")
    stored = cut_lineage(run("2024-02").drop("forecast_feature"), "refreshed")
    for layer in ("bronze_sensor_data", "silver_sensor_data", "gold_sensor_features"):
        spark.sql(f"DROP TABLE {schema_name}.{layer}")
    spark.sql(f"DROP SCHEMA {schema_name}")
    return settled(stored)
