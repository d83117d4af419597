"""Trips, sensor readings and predictions derived from an ``events`` table.

Plain arithmetic on ``events`` columns, so that other engines can repeat it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns of the table; naming them saves the job that would read them from the files.
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")


def _after(ts: Column, minutes: Column | int = 0, seconds: Column | int = 0) -> Column:
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return ts + F.make_dt_interval(
        F.lit(0), F.lit(0), as_column(minutes).cast("int"), as_column(seconds).cast("decimal(18,6)")
    )


def trips_of(df: DataFrame) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    return df.select(
        event.alias("trip_id"),
        F.col("ts").alias("tpep_pickup_datetime"),
        _after(F.col("ts"), minutes=1 + event % 50).alias("tpep_dropoff_datetime"),
        (10000 + user % 20).cast("int").alias("pickup_zip"),
        (10000 + (user * 7 + event) % 20).cast("int").alias("dropoff_zip"),
        (F.col("value") / 10).alias("trip_distance"),
        F.col("value").alias("fare_amount"),
    )


def readings_of(df: DataFrame) -> DataFrame:
    event = F.col("event_id")
    origin = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"))
    return df.select(
        (F.col("user_id") % 50 + 1).cast("int").alias("sensor_id"),
        _after(origin, seconds=event * 3).alias("event_time"),
        (F.col("value") - 10).alias("temperature"),
        (event * 37 % 1100 / 10).alias("humidity"),
        (990 + event % 21).cast("double").alias("pressure"),
    )


def predictions_of(df: DataFrame) -> DataFrame:
    event = F.col("event_id")
    return df.select(
        event.alias("trip_id"),
        (1 + event % 2).alias("model_id"),
        (F.col("value") * 0.9 + event % 7).alias("prediction"),
        F.col("value").alias("fare_amount"),
        F.col("ts").alias("timestamp"),
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return trips_of(events(spark, folder))


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_of(events(spark, folder))


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return predictions_of(events(spark, folder))
