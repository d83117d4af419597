from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_bucket, hash_fraction
from tidemark.functions.signals import sensor_bucket, synth_readings
from tidemark.functions.timekeys import month_key, round_to_minutes, weekend_flag


def at(spark, *texts, kind="timestamp"):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", F.col("t").cast(kind).alias("t")
    )


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_rounding(spark, kind):
    df = at(spark, "2024-01-01 01:00:00", "2024-01-01 01:00:00.000001", "2024-01-01 01:14:59", "2024-01-01 23:59:00", None, kind=kind)
    got = df.select(
        round_to_minutes(F.col("t"), 15).alias("up"), round_to_minutes(F.col("t"), 15, "down").alias("down"), "i"
    ).orderBy("i").collect()
    assert [r.up for r in got] == [
        datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 1, 15), datetime(2024, 1, 1, 1, 15), datetime(2024, 1, 2), None,
    ]
    assert [r.down for r in got][:4] == [
        datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 23, 45),
    ]


def test_rounding_grid_restarts_each_hour(spark):
    got = at(spark, "2024-01-01 01:10:00", "2024-01-01 01:50:00").select(
        round_to_minutes(F.col("t"), 45).alias("t"), "i"
    ).orderBy("i").collect()
    assert [r.t for r in got] == [datetime(2024, 1, 1, 1, 45), datetime(2024, 1, 1, 2, 30)]


def test_rounding_refuses_other_directions():
    with pytest.raises(ValueError):
        round_to_minutes(F.lit("x"), 15, "nearest")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_weekend_in_new_york(spark, kind):
    # Friday 23:59 and Saturday 00:00 in New York; both sides of the clock changes; null.
    df = at(
        spark,
        "2024-01-06 04:59:00", "2024-01-06 05:00:00", "2024-01-08 04:59:00", "2024-01-08 05:00:00",
        "2024-03-11 03:59:00", "2024-03-11 04:00:00", "2024-11-04 04:59:00", "2024-11-04 05:00:00", None,
        kind=kind,
    )
    got = [r.w for r in df.select(weekend_flag(F.col("t")).alias("w"), "i").orderBy("i").collect()]
    assert got == [0, 1, 1, 0, 1, 0, 1, 0, None]


def test_month_key(spark):
    df = at(spark, "2024-01-31 23:59:59.999999", "2024-02-01 00:00:00", None)
    assert [r.m for r in df.select(month_key(F.col("t")).alias("m"), "i").orderBy("i").collect()] == [
        "2024-01", "2024-02", None,
    ]


def test_hash_bucket_known_value_and_range(spark):
    df = spark.range(1000).select(hash_bucket(F.col("id"), 100, 123).alias("b"), hash_fraction(F.col("id"), "x").alias("f"))
    low, high, fmin, fmax, mean = df.agg(F.min("b"), F.max("b"), F.min("f"), F.max("f"), F.avg("f")).first()
    assert 0 <= low and high <= 99 and 0 <= fmin and fmax < 1 and 0.45 < mean < 0.55


def test_synthetic_readings_stay_in_their_bands(spark):
    start = F.timestamp_seconds(F.lit(1704067200) + F.col("id"))
    ticks = spark.range(5000).select(start.alias("timestamp"), F.col("id").alias("value"))
    once, again = synth_readings(ticks), synth_readings(ticks.repartition(3))
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()
    for frame in (once, synth_readings(ticks, random=True)):
        r = frame.agg(
            F.min("temperature"), F.max("temperature"), F.min("humidity"), F.max("humidity"),
            F.min("pressure"), F.max("pressure"), F.min("sensor_id"), F.max("sensor_id"),
        ).first()
        assert 8.5 <= r[0] and r[1] <= 31.5 and 27.5 <= r[2] and r[3] <= 72.5 and 990 <= r[4] and r[5] <= 1010
        assert (r[6], r[7]) == (1, 50)


def test_sensor_bucket_type(spark):
    assert spark.range(1).select(sensor_bucket(F.col("id")).alias("s")).schema["s"].dataType.simpleString() == "int"


def test_rounding_moves_less_than_one_step(spark):
    df = spark.range(2000).select(F.timestamp_micros(F.col("id") * 987_654_321).alias("t"))
    for r in df.select("t", round_to_minutes(F.col("t"), 30).alias("u")).collect():
        assert timedelta(0) <= r.u - r.t < timedelta(minutes=30) and r.u.minute % 30 == 0
