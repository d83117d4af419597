import json
import uuid
from datetime import datetime

import pytest
from conftest import SMALL, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import filters, quality
from tidemark.plans import medallion
from tidemark.plans.medallion import SLIDING_BATCH, SLIDING_STREAM, TUMBLING
from tidemark.session import scratch_path
from tidemark.sources import sample_views as views
from tidemark.streaming import streams

READING = "sensor_id int, event_time timestamp, temperature double, humidity double, pressure double"


def readings(spark, *data):
    raw = spark.createDataFrame(list(data), READING.replace("timestamp", "string"))
    return raw.withColumn("event_time", F.col("event_time").cast("timestamp"))


def test_rules_count_keep_and_drop(spark):
    df = readings(
        spark,
        (1, "2024-01-01 00:00:00", 20.0, 50.0, 1000.0),
        (1, None, 200.0, 50.0, 1000.0),
        (0, "2024-01-01 00:00:00", None, 50.0, 1000.0),
    )
    assert rows(quality.report(df, [*quality.BRONZE_RULES, *quality.SILVER_WARN_RULES]), "rule") == [
        ("not_null_temperature", 2, 1), ("temperature_safe_range", 1, 2), ("valid_event_time", 2, 1), ("valid_sensor_id", 2, 1),
    ]
    seen = Observation()
    kept = quality.expect(df, quality.BRONZE_RULES, seen)
    assert kept.count() == 1
    assert seen.get == {"checked": 3, "failed_valid_event_time": 1, "failed_valid_sensor_id": 1}
    assert quality.expect(df, quality.SILVER_WARN_RULES).count() == 3
    assert quality.expect(df, ()) is df


def test_plausible_bounds_are_included(spark):
    df = readings(
        spark,
        (1, "2024-01-01", -5.0, 0.0, 1.0), (2, "2024-01-01", 80.0, 100.0, 1.0), (3, "2024-01-01", -5.1, 50.0, 1.0),
        (4, "2024-01-01", 20.0, 100.1, 1.0), (5, "2024-01-01", None, 50.0, 1.0),
    )
    assert [r[0] for r in rows(filters.plausible(df), "sensor_id")] == [1, 2]
    assert [r[0] for r in rows(filters.plausible(df, filters.PLAUSIBLE_WIDE), "sensor_id")] == [1, 2, 3]


def test_hour_boundary_counts_toward_the_next_hour(spark):
    # The 00:55-01:00 window ends at 01:00 and so belongs to the hour that ends at 02:00.
    df = readings(spark, (1, "2024-01-01 00:54:59", 20.0, 50.0, 1000.0), (1, "2024-01-01 00:55:00", 30.0, 50.0, 1010.0))
    got = rows(medallion.medallion(df, TUMBLING), "event_time")
    assert [(r[1], r[3], r[4], r[6], r[7]) for r in got] == [
        (datetime(2024, 1, 1, 1), 20.0, None, 1000.0, 1), (datetime(2024, 1, 1, 2), 30.0, None, 1010.0, 1),
    ]
    assert got[0][8] == 20.0 + datetime(2024, 1, 1, 1).timestamp() - datetime(1970, 1, 1).timestamp()


def test_last_pressure_is_that_of_the_newest_window(spark):
    df = readings(
        spark,
        (1, "2024-01-01 00:01:00", 20.0, 50.0, 1900.0), (1, "2024-01-01 00:31:00", 20.0, 50.0, 1000.0),
        (1, "2024-01-01 00:32:00", 20.0, 50.0, 1001.0),
    )
    assert medallion.medallion(df, TUMBLING).first()["last_pressure_1h"] == 1001.0


def test_totals_of_the_variants(spark):
    df = views.readings(spark, SMALL)
    kept = filters.plausible(df).count()
    total = lambda v: medallion.medallion(df, v).agg(F.sum("total_records_1h")).first()[0]
    assert total(SLIDING_BATCH) == 5 * kept and total(SLIDING_STREAM) == 5 * kept
    assert total(TUMBLING) == filters.plausible(df, filters.PLAUSIBLE_WIDE).count()


def test_schema_enforcement(spark):
    df = readings(spark, (1, "2024-01-01", 1.0, 2.0, 3.0), (None, "2024-01-01", 1.0, 2.0, 3.0)).withColumn("more", F.lit(1))
    got = filters.enforce_schema(df.withColumn("sensor_id", F.col("sensor_id").cast("long")))
    assert got.count() == 1 and [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in filters.READING_SCHEMA
    ]


def stored(spark, folder, batches):
    """Write each batch of readings as one Parquet file."""
    for batch in batches:
        readings(spark, *batch).coalesce(1).write.mode("append").parquet(folder)


def test_stream_equals_batch_on_closed_windows(spark):
    source, out = scratch_path(spark, "source"), scratch_path(spark, "out")
    views.readings(spark, SMALL).withColumn("event_time", F.col("event_time").cast("timestamp")).repartition(3).write.parquet(source)
    stream = streams.silver_stream(streams.stored_stream(spark, source), SLIDING_STREAM, "5 minutes")
    streams.run_bounded(streams.append_sink(stream, f"{out}/rows", f"{out}/check"))
    got = spark.read.parquet(f"{out}/rows")
    batch = medallion.silver(spark.read.parquet(source), SLIDING_STREAM)
    newest = filters.plausible(spark.read.parquet(source)).agg(F.max("event_time")).first()[0]
    closed = batch.filter(F.col("event_time") <= F.lit(newest) - F.expr("INTERVAL 5 MINUTES"))
    same = ["sensor_id", "event_time", "count_records_5m", "min_pressure_5m", "max_pressure_5m"]
    assert rows(got.select(*same), *same) == rows(closed.select(*same), *same)
    assert 0 < got.count() < batch.count()


def test_late_rows_are_left_out(spark):
    source, out = scratch_path(spark, "source"), scratch_path(spark, "out")

    def run():
        schema = T.StructType.fromDDL(READING)
        stream = streams.silver_stream(streams.file_stream(spark, source, schema), TUMBLING, "1 minute")
        streams.run_bounded(streams.append_sink(stream, f"{out}/rows", f"{out}/check"))
        return rows(spark.read.parquet(f"{out}/rows").select("event_time", "count_5m"), "event_time")

    stored(spark, source, [[(1, "2024-01-01 00:01:00", 20.0, 50.0, 1.0), (1, "2024-01-01 01:00:00", 20.0, 50.0, 1.0)]])
    assert run() == [(datetime(2024, 1, 1, 0, 5), 1)]
    stored(spark, source, [[(1, "2024-01-01 00:02:00", 20.0, 50.0, 1.0), (1, "2024-01-01 02:00:00", 20.0, 50.0, 1.0)]])
    # The late row of 00:02 opens no second result for the closed window.
    assert run() == [(datetime(2024, 1, 1, 0, 5), 1), (datetime(2024, 1, 1, 1, 5), 1)]


def test_rules_are_counted_on_a_stream(spark):
    source, out = scratch_path(spark, "source"), scratch_path(spark, "out")
    stored(spark, source, [[(1, "2024-01-01 00:01:00", 20.0, 50.0, 1.0), (0, "2024-01-01 00:02:00", 20.0, 50.0, 1.0)]])
    stream = quality.expect(streams.stored_stream(spark, source), quality.BRONZE_RULES, "bronze_rules")
    query = streams.append_sink(stream, f"{out}/rows", f"{out}/check")
    streams.run_bounded(query)
    counts = [p.observedMetrics["bronze_rules"] for p in query.recentProgress if p.observedMetrics]
    assert counts[0].asDict() == {"checked": 2, "failed_valid_event_time": 0, "failed_valid_sensor_id": 1}
    assert spark.read.parquet(f"{out}/rows").count() == 1


def test_json_stream_rescues_broken_lines(spark, tmp_path):
    lines = [json.dumps({"sensor_id": 1, "temperature": 2.5}), '{"sensor_id": ', json.dumps({"sensor_id": "x"})]
    (tmp_path / "a.json").write_text("\n".join(lines))
    schema = T.StructType.fromDDL("sensor_id int, temperature double")
    stream = streams.file_stream(spark, str(tmp_path), schema, "json", rescued=True)
    out = scratch_path(spark, "json")
    streams.run_bounded(streams.append_sink(stream, f"{out}/rows", f"{out}/check"))
    got = spark.read.parquet(f"{out}/rows")
    assert {r["_rescued_data"] for r in got.collect()} == {None, lines[1], lines[2]}
    assert got.filter("_rescued_data IS NULL").first()["sensor_id"] == 1


def test_rate_stream_runs_for_a_bounded_time(spark):
    out = scratch_path(spark, "rate")
    stream = medallion.bronze(streams.rate_readings(spark, TUMBLING), TUMBLING)
    assert stream.isStreaming and stream.columns == ["sensor_id", "event_time", "temperature", "humidity", "pressure"]
    query = streams.append_sink(stream, f"{out}/rows", f"{out}/check", every="1 second", name="rate_bronze")
    streams.run_bounded(query, 6)
    assert not query.isActive
    got = spark.read.parquet(f"{out}/rows")
    assert got.count() > 0 and got.filter("sensor_id NOT BETWEEN 1 AND 50").isEmpty()


@pytest.mark.parametrize("variant", [SLIDING_BATCH, TUMBLING])
def test_sensor_job_end_to_end(spark, variant):
    base, schema_name = scratch_path(spark, "job"), f"sensors_{uuid.uuid4().hex[:8]}"
    source = scratch_path(spark, "source")
    data = views.readings(spark, SMALL).withColumn("event_time", F.col("event_time").cast("timestamp"))
    data.write.parquet(source)

    def run():
        return streams.run_sensor_job(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/gold", f"{base}/check", variant,
            source=streams.stored_stream(spark, source), every=None, seconds=None, schema_name=schema_name,
            rule_counts=counts,
        )

    order = ["sensor_id", "event_time"]
    expected = medallion.medallion(data, variant)
    counts = {}
    for _ in range(2):  # a second run finds nothing new and rebuilds the same tables
        gold = run()
        same = ["sensor_id", "event_time", "yyyy_mm", F.round("mean_temp_1h", 8), "last_pressure_1h", "total_records_1h"]
        assert rows(gold.select(*same), *order) == rows(expected.select(*same), *order)
        if variant.silver_rules:
            assert counts["silver"]["checked"] == data.count()
            assert counts["gold"].get("failed_non_null_avg_temp", 0) == 0
    assert spark.table(f"{schema_name}.silver_sensor_data").count() > gold.count()


def test_refresh_from_a_month_equals_a_full_rebuild(spark):
    base, schema_name = scratch_path(spark, "job"), f"sensors_{uuid.uuid4().hex[:8]}"
    source = scratch_path(spark, "source")

    def run(month=None):
        return streams.run_sensor_job(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/gold", f"{base}/check", SLIDING_BATCH,
            source=streams.file_stream(spark, source, T.StructType.fromDDL(READING)),
            every=None, seconds=None, schema_name=schema_name, refresh_from=month,
        )

    stored(spark, source, [[(1, "2024-01-10 00:00:30", 20.0, 50.0, 1.0), (1, "2024-01-31 23:58:30", 30.0, 50.0, 2.0)]])
    run()
    old = {f for f in spark.table(f"{schema_name}.silver_sensor_data").inputFiles() if "2024-01" in f}
    stored(spark, source, [[(1, "2024-02-01 00:01:30", 40.0, 50.0, 3.0), (1, "2024-03-05 10:00:00", 10.0, 50.0, 4.0)]])
    got = rows(run("2024-02"), "event_time")
    assert {f for f in spark.table(f"{schema_name}.silver_sensor_data").inputFiles() if "2024-01" in f} == old
    whole = medallion.medallion(spark.table(f"{schema_name}.bronze_sensor_data"), SLIDING_BATCH)
    columns = spark.table(f"{schema_name}.gold_sensor_features").columns
    assert got == rows(whole.select(*columns), "event_time") and len(got) == 4
