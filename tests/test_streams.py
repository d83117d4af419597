"""Streams written by batch: late rows, replays, counts, labels, clocked ticks, pruned refresh."""

import json
import random
import uuid
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.windows import Measure, windowed_agg
from tidemark.plans import medallion
from tidemark.plans.medallion import SLIDING_BATCH, SLIDING_STREAM, TUMBLING
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.sources.window_states import WindowStates
from tidemark.streaming import batches, streams

READING = "sensor_id int, event_time timestamp, temperature double, humidity double, pressure double"
START = datetime(2024, 1, 30, 23, 40)


def readings(seed, count, minutes):
    rng = random.Random(seed)
    return [
        (rng.choice((1, 2)), START + timedelta(seconds=rng.randrange(minutes * 60)), rng.uniform(-20, 90), rng.uniform(0, 100), 1000.0)
        for _ in range(count)
    ]


@pytest.mark.parametrize(("size", "slide"), [(5, 5), (5, 1), (60, 15), (2880, 720)])
def test_windows_of_states_equal_windows_of_rows(spark, size, slide):
    """Batches in any order of time, one replayed, one empty; days are chosen and pruned."""
    parts = [readings(n, 60, 4000) for n in range(3)]
    parts[2] += [(1, None, 1.0, 2.0, 3.0)]
    measures = [
        Measure("n", "count"), Measure("mean", "mean", "temperature"), Measure("low", "min", "temperature"),
        Measure("total", "sum", "temperature"), Measure("dev", "std", "temperature"),
    ]
    states = WindowStates(spark, scratch_path(spark, "states"), ["sensor_id"], measures, size, slide)
    assert states.add(spark.createDataFrame([], READING), "event_time", 0) == []
    every = set()
    for n, part in enumerate(parts):
        touched = states.add(spark.createDataFrame(part, READING), "event_time", n + 1)
        assert touched == states.add(spark.createDataFrame(part, READING), "event_time", n + 1)
        every.update(touched)
    whole = windowed_agg(spark.createDataFrame(sum(parts, []), READING), ["sensor_id"], "event_time", measures, size, slide)
    shown = ["sensor_id", "window", "n", F.round("mean", 9), "low", F.round("total", 9), F.round("dev", 9)]
    expected = rows(whole.select(*shown), "sensor_id", "window")
    assert rows(states.windows().select(*shown), "sensor_id", "window") == expected
    assert rows(states.windows(sorted(every)).select(*shown), "sensor_id", "window") == expected
    day = touched[1]
    found = states.windows([day])
    assert rows(found.select(*shown), "sensor_id", "window") == [r for r in expected if str(r[1].end.date()) == day]
    with pytest.raises(ValueError, match="multiple"):
        WindowStates(spark, "x", ["sensor_id"], measures, 5, 2)
    with pytest.raises(ValueError, match="nothing is stored"):
        WindowStates(spark, scratch_path(spark, "none"), ["sensor_id"], measures, 5).windows()


@pytest.mark.parametrize("variant", [TUMBLING, SLIDING_STREAM])
def test_late_rows_reach_silver(spark, variant):
    """Every batch goes back over months that the batches before it closed."""
    path = scratch_path(spark, "late")
    parts = [readings(n, 40, 80) for n in range(3)]
    parts[1] += [(1, datetime(2024, 3, 1), 20.0, 50.0, 1.0)]
    parts[2] += [(1, datetime(2023, 12, 31, 23, 59, 30), 20.0, 50.0, 1.0)]

    def run():
        schema = spark.createDataFrame([], READING).schema
        stream = streams.file_stream(spark, f"{path}/source", schema, max_files_per_trigger=1)
        sink = streams.late_silver_sink(stream, f"{path}/states", f"{path}/silver", f"{path}/check", variant)
        streams.run_bounded(sink)

    for n in range(len(parts)):
        spark.createDataFrame(parts[n], READING).coalesce(1).write.mode("append").parquet(f"{path}/source")
        run()
        silver = spark.read.parquet(f"{path}/silver").drop("on_day")
        same = [*silver.columns[:2], "yyyy_mm", F.round("avg_temp_5m", 9), "max_pressure_5m", variant.count_column]
        batch = medallion.silver(spark.createDataFrame(sum(parts[: n + 1], []), READING), variant)
        assert rows(silver.select(*same), "sensor_id", "event_time") == rows(batch.select(*same), "sensor_id", "event_time")


def test_rules_are_counted_over_more_batches_than_progress_lists(spark, tmp_path):
    lines = [json.dumps({"sensor_id": n % 3, "event_time": None if n % 50 == 7 else "2024-01-01 00:00:00"}) for n in range(240)]
    (tmp_path / "source").mkdir()
    for n in range(120):
        (tmp_path / "source" / f"{n:03}.json").write_text("\n".join(lines[2 * n : 2 * n + 2]))
    schema = "sensor_id int, event_time timestamp"
    check = scratch_path(spark, "check")

    def run(count):
        stream = streams.file_stream(spark, str(tmp_path / "source"), spark.createDataFrame([], schema).schema, "json", 1)
        write = batches.dated_writer(f"{check}/rows", "event_time", check, quality.BRONZE_RULES)
        streams.run_bounded(batches.batch_sink(stream, write, check))
        assert batches.next_batch(spark, check) == count

    run(120)
    expected = {"checked": 240, "failed_valid_event_time": 5, "failed_valid_sensor_id": 80}
    assert batches.rule_counts(spark, check) == expected
    # A batch that runs again leaves rows and counts as they are.
    again = spark.read.schema(schema).json(str(tmp_path / "source" / "119.json"))
    batches.dated_writer(f"{check}/rows", "event_time", check, quality.BRONZE_RULES)(again, 119)
    assert batches.rule_counts(spark, check) == expected
    good = sum(n % 50 != 7 and n % 3 != 0 for n in range(240))
    assert spark.read.parquet(f"{check}/rows").count() == good
    # A second run goes on with the numbers; its own counts can be told apart.
    (tmp_path / "source" / "200.json").write_text(lines[1])
    run(121)
    assert batches.rule_counts(spark, check, 120) == {"checked": 1, "failed_valid_event_time": 0, "failed_valid_sensor_id": 0}
    assert batches.rule_counts(spark, check)["checked"] == 241 and batches.rule_counts(spark, check, 500) == {}
    assert batches.rule_counts(spark, scratch_path(spark, "none")) == {}


def test_labels_that_come_later(spark):
    path = scratch_path(spark, "labels")
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    predictions = [(1, 0.1, at(0)), (2, 0.2, at(5)), (3, 0.3, at(10)), (4, 0.4, at(300)), (None, 0.5, at(1))]
    labels = [(1, 9.0, at(0)), (2, 8.0, at(64)), (2, 8.0, at(65)), (3, 7.0, at(71)), (4, 6.0, at(299)), (None, 1.0, at(2)), (9, 1.0, at(300))]
    spark.createDataFrame(predictions, "id int, prediction double, t timestamp").coalesce(1).write.parquet(f"{path}/p")
    spark.createDataFrame(labels, "id int, y double, u timestamp").coalesce(1).write.parquet(f"{path}/l")
    joined = streams.label_stream(
        streams.stored_stream(spark, f"{path}/p"), streams.stored_stream(spark, f"{path}/l"), "id", "y", "t", "u", "1 hour", "1 minute"
    )
    streams.run_bounded(streams.append_sink(joined, f"{path}/rows", f"{path}/check"))
    found = spark.read.parquet(f"{path}/rows")
    # An hour or less apart counts, once; a label before its prediction or without a key does not;
    # what may still get its label (4) is not out yet.
    assert found.columns == ["id", "prediction", "t", "y"]
    assert rows(found.select("prediction", "y"), "prediction") == [(0.1, 9.0), (0.2, 8.0), (0.3, None), (0.5, None)]


def test_clocked_ticks_repeat(spark):
    def run():
        path = scratch_path(spark, "ticks")
        ticks = streams.clocked_ticks(spark, 5, 1_000_000_000_000, 2000)
        query = streams.append_sink(ticks, f"{path}/rows", f"{path}/check", every="50 milliseconds")
        streams.run_until(query, lambda: bool(query.lastProgress) and query.lastProgress["batchId"] >= 3, 60)
        assert not query.isActive
        return [r for r in rows(spark.read.parquet(f"{path}/rows").select("value", F.unix_millis("timestamp")), "value") if r[0] < 15]

    first = run()
    assert first == run() == [(n, 1_000_000_000_000 + n // 5 * 2000) for n in range(15)]


def test_a_run_that_takes_too_long_is_stopped(spark):
    path = scratch_path(spark, "ticks")
    query = streams.append_sink(streams.clocked_ticks(spark, 1), f"{path}/rows", f"{path}/check", every="1 second")
    with pytest.raises(TimeoutError):
        streams.run_until(query, lambda: False, 1)
    assert not query.isActive


def test_refresh_reads_its_days_only_and_drops_emptied_months(spark, capsys):
    base, schema_name = scratch_path(spark, "job"), f"sensors_{uuid.uuid4().hex[:8]}"
    reading = lambda at, v: (1, datetime.fromisoformat(at), v, 50.0, 1.0)

    def run(*new, month=None):
        spark.createDataFrame(list(new), READING).coalesce(1).write.mode("append").parquet(f"{base}/source")
        schema = spark.createDataFrame([], READING).schema
        return streams.run_sensor_job(
            spark, f"{base}/bronze", f"{base}/silver", f"{base}/gold", f"{base}/check", SLIDING_BATCH,
            source=streams.file_stream(spark, f"{base}/source", schema),
            every=None, seconds=None, schema_name=schema_name, refresh_from=month,
        )

    run(reading("2024-01-10 00:00:30", 20.0), reading("2024-01-31 23:58:30", 30.0), reading("2024-03-05 10:00:00", 40.0))
    bronze = spark.table(f"{schema_name}.bronze_sensor_data")
    streams._since(bronze, "2024-02", "5 MINUTES", "on_day", "yyyy-MM-dd").explain()
    assert "PartitionFilters: [isnotnull(on_day" in capsys.readouterr().out
    # The readings of March go; refreshing from February then leaves no March behind.
    tables.drop_partitions(spark, f"{base}/bronze", "on_day", lambda day: day >= "2024-03")
    gold = run(reading("2024-02-01 00:01:30", 50.0), month="2024-02")
    spark.catalog.refreshTable(f"{schema_name}.bronze_sensor_data")
    whole = medallion.medallion(spark.read.parquet(f"{base}/bronze"), SLIDING_BATCH).select(*gold.columns)
    assert rows(gold, "event_time") == rows(whole, "event_time") and gold.count() == 3
    assert {r[0] for r in gold.select("yyyy_mm").distinct().collect()} == {"2024-01", "2024-02"}
    # A month without any rows left at all; January, which is not refreshed, keeps its silver.
    tables.drop_partitions(spark, f"{base}/bronze", "on_day", lambda day: day >= "2024-01-31")
    gold = run(month="2024-02")
    silver = spark.table(f"{schema_name}.silver_sensor_data")
    assert {r[0] for r in silver.select("yyyy_mm").distinct().collect()} == {"2024-01"}
    assert rows(gold, "event_time") == rows(medallion.gold(silver, SLIDING_BATCH).select(*gold.columns), "event_time")
