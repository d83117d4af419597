"""The synthetic sensor signal: two waves plus noise, and the modulo entity id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_fraction


def sensor_bucket(value: Column, sensors: int = 50) -> Column:
    """Spread a counter over sensor ids ``1..sensors``."""
    return (F.pmod(value, F.lit(sensors)) + F.lit(1)).cast("int")


def noise(value: Column, label: str, random: bool) -> Column:
    """Centred noise in ``[-0.5, 0.5)``; from a hash of the counter unless ``random``."""
    draw = F.rand() if random else hash_fraction(value, label)
    return draw - F.lit(0.5)


def synth_readings(ticks: DataFrame, random: bool = False) -> DataFrame:
    """Turn ``(timestamp, value)`` ticks, streaming or not, into sensor readings.

    With ``random`` left off, a replayed tick gives the same reading again.
    """
    value = F.col("value")
    return ticks.select(
        sensor_bucket(value).alias("sensor_id"),
        F.col("timestamp").alias("event_time"),
        (20.0 + 10.0 * F.sin(value * 0.05) + noise(value, "temperature", random) * 3.0).alias("temperature"),
        (50.0 + 20.0 * F.cos(value * 0.03) + noise(value, "humidity", random) * 5.0).alias("humidity"),
        (1000.0 + noise(value, "pressure", random) * 20.0).alias("pressure"),
    )
