"""Trip and sensor feature sets, and the job that computes and stores one.

A feature set is a function ``(input_df, timestamp_column, start_date, end_date)`` that
returns keyed rows whose timestamp is the *end* of their window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timekeys import month_key, weekend_flag
from tidemark.operators.filters import Bound, time_range
from tidemark.operators.windows import Measure, windowed_agg
from tidemark.session import require_utc
from tidemark.sources.feature_table import FeatureTable
from tidemark.sources.tables import ensure_namespace, read_path

FeatureSet = Callable[[DataFrame, str, Bound, Bound], DataFrame]

FEATURE_SETS: dict[str, FeatureSet] = {}
WINDOW_MINUTES: dict[str, int] = {}


def feature_set(name: str, minutes: int) -> Callable[[FeatureSet], FeatureSet]:
    """Register a feature set, with the length of its windows, under a name that jobs can refer to."""

    def register(fn: FeatureSet) -> FeatureSet:
        FEATURE_SETS[name] = fn
        WINDOW_MINUTES[name] = minutes
        return fn

    return register


def find_feature_set(name: str) -> FeatureSet:
    """A registered feature set, or ``compute_features_fn`` of an importable module."""
    if name in FEATURE_SETS:
        return FEATURE_SETS[name]
    return import_module(name).compute_features_fn


@feature_set("pickup_features", 60)
def pickup_features(
    input_df: DataFrame, timestamp_column: str, start_date: Bound = None, end_date: Bound = None
) -> DataFrame:
    """Mean fare and trip count per pickup zip, over one hour every 15 minutes."""
    mean, count = "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip"
    stats = windowed_agg(
        time_range(input_df, timestamp_column, start_date, end_date),
        ["pickup_zip"],
        timestamp_column,
        [Measure(mean, "mean", "fare_amount"), Measure(count, "count")],
        size=60,
        slide=15,
    )
    end = F.col("window.end")
    return stats.select(
        F.col("pickup_zip").alias("zip"),
        end.alias(timestamp_column),
        month_key(end).alias("yyyy_mm"),
        F.col(mean).cast("float").alias(mean),
        F.col(count).cast("int").alias(count),
    )


@feature_set("dropoff_features", 30)
def dropoff_features(
    input_df: DataFrame, timestamp_column: str, start_date: Bound = None, end_date: Bound = None
) -> DataFrame:
    """Trip count per dropoff zip and half hour, and whether the window ends on a weekend."""
    count = "count_trips_window_30m_dropoff_zip"
    stats = windowed_agg(
        time_range(input_df, timestamp_column, start_date, end_date),
        ["dropoff_zip"],
        timestamp_column,
        [Measure(count, "count")],
        size=30,
    )
    end = F.col("window.end")
    return stats.select(
        F.col("dropoff_zip").alias("zip"),
        end.alias(timestamp_column),
        month_key(end).alias("yyyy_mm"),
        F.col(count).cast("int").alias(count),
        weekend_flag(end).alias("dropoff_is_weekend"),
    )


@feature_set("sensor_features", 60)
def sensor_features(
    input_df: DataFrame, timestamp_column: str, start_date: Bound = None, end_date: Bound = None
) -> DataFrame:
    """Temperature and humidity statistics per sensor, over one hour every 15 minutes."""
    stats = windowed_agg(
        time_range(input_df, timestamp_column, start_date, end_date),
        ["sensor_id"],
        timestamp_column,
        [
            Measure("mean_temp_1h", "mean", "temperature"),
            Measure("stddev_temp_1h", "std", "temperature"),
            Measure("mean_humidity_1h", "mean", "humidity"),
            Measure("event_count_1h", "count"),
        ],
        size=60,
        slide=15,
    )
    end = F.col("window.end")
    return stats.select(
        "sensor_id",
        end.alias(timestamp_column),
        month_key(end).alias("yyyy_mm"),
        *[F.col(c).cast("float").alias(c) for c in ("mean_temp_1h", "stddev_temp_1h", "mean_humidity_1h")],
        F.col("event_count_1h").cast("int").alias("event_count_1h"),
    )


def run_feature_job(
    spark: SparkSession,
    input_path: str,
    output_table: str,
    feature_set_name: str,
    primary_keys: Sequence[str] | str,
    timestamp_column: str,
    start_date: Bound = None,
    end_date: Bound = None,
    input_format: str = "parquet",
    full_refresh: bool = False,
    whole_windows: bool = True,
) -> FeatureTable:
    """Compute a feature set from a stored table and upsert it into its feature table.

    A run over a date range stores the windows that end after ``start_date`` and not after
    ``end_date``, each from all its rows, so runs over neighbouring ranges give what one run
    gives. Without ``whole_windows`` (and for feature sets of unknown window length) the rows of
    the range alone are used, and windows over its edges hold only the part inside.
    ``full_refresh`` replaces the table.
    """
    if not input_path or not output_table:
        raise ValueError("input_path and output_table must be given")
    require_utc(spark)
    ensure_namespace(spark, output_table)
    if isinstance(primary_keys, str):
        primary_keys = [k.strip() for k in primary_keys.split(",")]
    raw = read_path(spark, input_path, input_format)
    if whole_windows and feature_set_name in WINDOW_MINUTES:
        rows = complete_windows(raw, feature_set_name, timestamp_column, start_date, end_date)
    else:
        rows = find_feature_set(feature_set_name)(raw, timestamp_column, start_date, end_date)
    table = FeatureTable.create(spark, output_table, rows, primary_keys, timestamp_column)
    if full_refresh:
        table.overwrite(rows)
    else:
        table.merge(rows)
    return table


def complete_windows(
    rows: DataFrame, feature_set_name: str, timestamp_column: str, start: Bound = None, end: Bound = None
) -> DataFrame:
    """Features of the windows that end after ``start`` and not after ``end``, from all their rows."""
    kind = rows.schema[timestamp_column].dataType.simpleString()
    at = F.col(timestamp_column)
    if start:
        first = F.lit(str(start)).cast(kind) - F.expr(f"INTERVAL {WINDOW_MINUTES[feature_set_name]} MINUTES")
        rows = rows.where(at >= first)
    out = FEATURE_SETS[feature_set_name](rows, timestamp_column, None, end)
    if start:
        out = out.where(at > F.lit(str(start)).cast(kind))
    return out.where(at <= F.lit(str(end)).cast(kind)) if end else out
