"""Sensor tables in three layers: readings, 5-minute statistics, hourly features.

Hourly rows are grouped by the *end* of the 5-minute window, so a window that ends on the
hour counts toward the next hour. In the sliding variants every reading lies in five
5-minute windows, and ``total_records_1h`` counts it five times.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.timekeys import epoch_seconds, month_key
from tidemark.operators.filters import PLAUSIBLE_STRICT, PLAUSIBLE_WIDE, plausible
from tidemark.operators.quality import (
    BRONZE_RULES,
    GOLD_RULES,
    SILVER_DROP_RULES,
    SILVER_WARN_RULES,
    Rule,
    expect,
)
from tidemark.operators.windows import Measure, windowed_agg


@dataclass(frozen=True)
class Variant:
    """What differs between the sensor jobs. Rules apply to the input of their layer."""

    rows_per_second: int
    slide_minutes: int
    ranges: Mapping[str, tuple[float, float]]
    count_column: str = "count_records_5m"
    bronze_rules: Sequence[Rule] = ()
    silver_rules: Sequence[Rule] = ()
    gold_rules: Sequence[Rule] = ()
    forecast: bool = False


SLIDING_BATCH = Variant(rows_per_second=20, slide_minutes=1, ranges=PLAUSIBLE_STRICT)
SLIDING_STREAM = Variant(
    rows_per_second=20, slide_minutes=1, ranges=PLAUSIBLE_STRICT, silver_rules=SILVER_DROP_RULES
)
TUMBLING = Variant(
    rows_per_second=40,
    slide_minutes=5,
    ranges=PLAUSIBLE_WIDE,
    count_column="count_5m",
    bronze_rules=BRONZE_RULES,
    silver_rules=SILVER_WARN_RULES,
    gold_rules=GOLD_RULES,
    forecast=True,
)


def bronze(readings: DataFrame, variant: Variant = TUMBLING, observe: Observation | str | None = None) -> DataFrame:
    """Readings that satisfy the rules of the first layer; ``observe`` takes the rule counts."""
    return expect(readings, variant.bronze_rules, observe)


def silver(
    readings: DataFrame,
    variant: Variant = TUMBLING,
    delay: str | None = None,
    observe: Observation | str | None = None,
) -> DataFrame:
    """5-minute statistics of plausible readings per sensor; ``observe`` takes the rule counts.

    ``delay`` is for streams: it sets a watermark on the plausible readings, so that a broken
    reading cannot move it.
    """
    clean = clean_readings(readings, variant, observe)
    if delay:
        clean = clean.withWatermark("event_time", delay)
    measures = silver_measures(variant)
    stats = windowed_agg(
        clean, ["sensor_id"], "event_time", measures, size=SILVER_MINUTES, slide=variant.slide_minutes, panes=delay is None
    )
    return silver_columns(stats, variant)


def clean_readings(readings: DataFrame, variant: Variant, observe: Observation | str | None = None) -> DataFrame:
    """The readings that count in 5-minute statistics."""
    return plausible(expect(readings, variant.silver_rules, observe), variant.ranges)


SILVER_MINUTES = 5


def silver_measures(variant: Variant) -> list[Measure]:
    return [
        Measure("avg_temp_5m", "mean", "temperature"),
        Measure("avg_humidity_5m", "mean", "humidity"),
        Measure("min_pressure_5m", "min", "pressure"),
        Measure("max_pressure_5m", "max", "pressure"),
        Measure(variant.count_column, "count"),
    ]


def silver_columns(stats: DataFrame, variant: Variant) -> DataFrame:
    """The stored form of 5-minute statistics: the time of a row is the end of its window."""
    end = F.col("window.end")
    names = [m.name for m in silver_measures(variant)]
    return stats.select("sensor_id", end.alias("event_time"), month_key(end).alias("yyyy_mm"), *names)


def gold(silver_rows: DataFrame, variant: Variant = TUMBLING, observe: Observation | str | None = None) -> DataFrame:
    """Hourly features from 5-minute statistics; the last pressure is the newest window's."""
    measures = [
        Measure("mean_temp_1h", "mean", "avg_temp_5m"),
        Measure("std_temp_1h", "std", "avg_temp_5m"),
        Measure("mean_humidity_1h", "mean", "avg_humidity_5m"),
        Measure("last_pressure_1h", "newest", "max_pressure_5m", by="event_time"),
        Measure("total_records_1h", "sum", variant.count_column),
    ]
    stats = windowed_agg(expect(silver_rows, variant.gold_rules, observe), ["sensor_id"], "event_time", measures, size=60)
    end = F.col("window.end")
    out = stats.select("sensor_id", end.alias("event_time"), month_key(end).alias("yyyy_mm"), *[m.name for m in measures])
    if variant.forecast:
        out = out.withColumn("forecast_feature", F.col("mean_temp_1h") + epoch_seconds(F.col("event_time")) * 1.0)
    return out


def medallion(readings: DataFrame, variant: Variant = TUMBLING) -> DataFrame:
    """All three layers in one plan, without storing the middle one."""
    return gold(silver(bronze(readings, variant), variant), variant)
