"""Streaming sources, sinks and the sensor stream."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.signals import synth_readings
from tidemark.operators.filters import rescue_json
from tidemark.operators.rescue import rescue_document
from tidemark.plans import medallion as layers
from tidemark.plans.medallion import SLIDING_STREAM, TUMBLING, Variant
from tidemark.session import require_utc
from tidemark.sources.tables import drop_partitions, overwrite_path, register_path
from tidemark.sources.window_states import DAY, WindowStates, on_day
from tidemark.streaming.batches import batch_sink, dated_writer, next_batch, rule_counts as counted_rules

RESCUED = "_rescued_data"


def rate_readings(spark: SparkSession, variant: Variant = TUMBLING, random: bool = False) -> DataFrame:
    """Synthetic readings at the variant's rate."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", variant.rows_per_second).load()
    return synth_readings(ticks, random)


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    rescued: bool = False,
) -> DataFrame:
    """Files arriving under ``path`` as a stream; replayable, so results repeat.

    ``rescued`` adds a column that takes the whole text of rows that do not fit (JSON, CSV) and,
    for JSON, the fields outside the schema of those that do.
    """
    if rescued and fmt == "json":
        lines = file_stream(spark, path, T.StructType().add("value", T.StringType()), "text", max_files_per_trigger)
        return rescue_json(lines, "value", schema, RESCUED)
    reader = spark.readStream.format(fmt)
    if rescued:
        schema = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType(), True)])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.schema(schema).load(path)


def document_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None, rescued: str = RESCUED
) -> DataFrame:
    """JSON lines arriving under ``path``, read by a schema of any depth; what does not fit is kept by its path."""
    lines = file_stream(spark, path, T.StructType().add("value", T.StringType()), "text", max_files_per_trigger)
    return rescue_document(lines, "value", schema, rescued)


def stored_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a stored layer as a stream; its schema is taken from the files present."""
    return file_stream(spark, path, spark.read.format(fmt).load(path).schema, fmt)


def silver_stream(readings: DataFrame, variant: Variant = SLIDING_STREAM, delay: str = "10 minutes") -> DataFrame:
    """5-minute statistics of a stream of readings, emitted once a window is past ``delay``.

    The watermark bounds the state. Readings later than it are left out.
    """
    zoned = readings.withColumn("event_time", F.col("event_time").cast("timestamp"))
    return layers.silver(zoned, variant, delay)


def late_silver_sink(
    stream: DataFrame,
    states_path: str,
    silver_path: str,
    checkpoint: str,
    variant: Variant = TUMBLING,
    every: str | None = None,
) -> StreamingQuery:
    """Keep 5-minute statistics right however late a reading comes.

    A batch adds its partial states to a table of states; the days of silver on which a touched
    window ends are then written anew from the states of those days. No reading is dropped and no
    window held in memory; a batch that runs again leaves the same tables.
    """

    def write(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        states = silver_states(spark, states_path, variant)
        days = states.add(layers.clean_readings(rows, variant), "event_time", number)
        if days:
            silver = layers.silver_columns(states.windows(days), variant)
            dated = silver.withColumn(DAY, on_day(F.col("event_time")))
            overwrite_path(dated, silver_path, ("yyyy_mm", DAY), only_touched=True)

    return batch_sink(stream, write, checkpoint, every)


def silver_states(spark: SparkSession, path: str, variant: Variant) -> WindowStates:
    """The table of partial 5-minute statistics at ``path``."""
    return WindowStates(
        spark, path, ["sensor_id"], layers.silver_measures(variant), layers.SILVER_MINUTES, variant.slide_minutes
    )


def label_stream(
    predictions: DataFrame,
    labels: DataFrame,
    on: str,
    label: str,
    predicted_at: str,
    labelled_at: str,
    within: str,
    delay: str = "10 minutes",
) -> DataFrame:
    """Predictions with the label that comes at most ``within`` after them, else null.

    A labelled prediction comes out with its label, one without once the watermarks of both streams
    (the newest time less ``delay``) have passed its bound; until then both sides wait in the state,
    which the bound limits. Of several labels of a key within the watermark the one read first counts.
    """
    waiting = predictions.drop(label).withWatermark(predicted_at, delay)
    told = labels.select(F.col(on).alias("__on"), F.col(label), F.col(labelled_at).alias("__labelled_at"))
    told = told.withWatermark("__labelled_at", delay).dropDuplicatesWithinWatermark(["__on"])
    bound = F.expr(f"__labelled_at >= `{predicted_at}` AND __labelled_at <= `{predicted_at}` + INTERVAL {within}")
    return waiting.join(told, (F.col(on) == F.col("__on")) & bound, "leftOuter").drop("__on", "__labelled_at")


def clocked_ticks(spark: SparkSession, per_batch: int, start: int = 0, advance: int = 1000, partitions: int = 4) -> DataFrame:
    """Counters 0, 1, 2, ... at a fixed number per batch, with a clock that every run repeats.

    ``start`` (milliseconds since 1970) is the time of the first batch, ``advance`` the time between two.
    """
    options = {"rowsPerBatch": per_batch, "startTimestamp": start, "advanceMillisPerBatch": advance, "numPartitions": partitions}
    return spark.readStream.format("rate-micro-batch").options(**options).load()


def append_sink(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to Parquet files: every ``every`` (continuous run), or, without it, all
    that is available now and then stop (triggered run)."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def run_bounded(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait for a stream to end by itself, or for at most ``seconds``, then stop it."""
    try:
        if seconds is None:
            query.awaitTermination()
        else:
            query.awaitTermination(seconds)
    finally:
        query.stop()


def run_until(query: StreamingQuery, done: Callable[[], bool], seconds: int, every: float = 0.2) -> None:
    """Let a continuous run go on until ``done``, then stop it; it is an error if that takes longer than ``seconds``."""
    end = time.monotonic() + seconds
    try:
        while not done():
            if query.awaitTermination(every):
                raise RuntimeError("the stream ended before it was done")
            if time.monotonic() > end:
                raise TimeoutError(f"the stream was not done after {seconds} seconds")
    finally:
        query.stop()


def run_sensor_job(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    gold_path: str,
    checkpoint_base: str,
    variant: Variant = TUMBLING,
    source: DataFrame | None = None,
    every: str | None = "12 seconds",
    seconds: int | None = 60,
    schema_name: str = "sensor_streaming",
    refresh_from: str | None = None,
    rule_counts: dict[str, dict[str, int]] | None = None,
) -> DataFrame:
    """Ingest readings for a while, then bring the silver and gold tables up to date.

    Returns the registered gold table. ``source`` replaces the synthetic stream. By default
    both tables are rebuilt from all stored readings; ``refresh_from`` ("YYYY-MM") rebuilds
    only that month and the later ones, from the readings those months need. ``rule_counts``
    gets, by layer, how many rows were checked and how many failed each rule in this run.
    """
    require_utc(spark)
    counts = {} if rule_counts is None else rule_counts
    readings = rate_readings(spark, variant) if source is None else source
    checkpoint = f"{checkpoint_base}/bronze"
    first = next_batch(spark, checkpoint)
    write = dated_writer(bronze_path, "event_time", checkpoint, variant.bronze_rules)
    run_bounded(batch_sink(readings, write, checkpoint, every), seconds)
    counts["bronze"] = counted_rules(spark, checkpoint, first)
    bronze = register_path(spark, f"{schema_name}.bronze_sensor_data", bronze_path)
    seen = Observation()
    silver = layers.silver(_since(bronze, refresh_from, "5 MINUTES", DAY, "yyyy-MM-dd"), variant, observe=seen)
    _store_layer(silver, silver_path, refresh_from)
    counts["silver"] = seen.get if variant.silver_rules else {}
    silver = register_path(spark, f"{schema_name}.silver_sensor_data", silver_path)
    seen = Observation()
    gold = layers.gold(_since(silver, refresh_from, "1 HOUR", "yyyy_mm", "yyyy-MM"), variant, seen)
    _store_layer(gold, gold_path, refresh_from)
    counts["gold"] = seen.get if variant.gold_rules else {}
    return register_path(spark, f"{schema_name}.gold_sensor_features", gold_path)


def _since(rows: DataFrame, month: str | None, reach: str, folder: str, pattern: str) -> DataFrame:
    """Rows that can lie in a window ending in ``month`` or later; ``reach`` is the window size.

    The partition column ``folder`` is named too, so that folders of earlier times are not opened.
    """
    if month is None:
        return rows
    first = F.lit(f"{month}-01").cast("timestamp") - F.expr(f"INTERVAL {reach}")
    if folder in rows.columns:
        rows = rows.filter(F.col(folder).cast("string") >= F.date_format(first, pattern))
    return rows.filter(F.col("event_time") >= first)


def _store_layer(rows: DataFrame, path: str, month: str | None) -> None:
    """Replace the layer, or its months from ``month`` on; of those, months without rows any more go."""
    if month is None:
        overwrite_path(rows, path)
        return
    rows = rows.filter(F.col("yyyy_mm") >= month)
    present = {r[0] for r in rows.select("yyyy_mm").distinct().collect()}  # a name per month
    overwrite_path(rows, path, only_touched=True)
    drop_partitions(rows.sparkSession, path, "yyyy_mm", lambda found: found >= month and found not in present)
