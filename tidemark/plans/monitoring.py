"""Monitoring of a predictions table: store its error profile, decide on retraining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.filters import time_range
from tidemark.operators.profile import (
    PROFILE_MEASURES,
    error_profile,
    is_violated,
    judged_rows,
    profile_of_states,
    sketch_measures,
    violation_check,
)
from tidemark.session import cut_lineage, require_utc
from tidemark.sources.tables import read_table, write_named
from tidemark.sources.window_states import WindowStates

PROFILE_SUFFIX = "_profile_metrics"


def refresh_profile(
    spark: SparkSession,
    table: str,
    ts: str = "timestamp",
    model: str = "model_id",
    prediction: str = "prediction",
    label: str = "fare_amount",
    granularity: str = "1 day",
    since: str | None = None,
) -> str:
    """Recompute the profile of ``table`` into ``<table>_profile_metrics``; returns that name.

    With ``since``, the start of a window, only predictions from then on are read; the stored
    metric rows of earlier windows stay as they are.
    """
    require_utc(spark)
    rows, target = read_table(spark, table), table + PROFILE_SUFFIX
    profile = error_profile(time_range(rows, ts, since), ts, model, prediction, label, granularity)
    if since and spark.catalog.tableExists(target):
        first = F.lit(since).cast(profile.schema["window"].dataType["start"].dataType)
        inside = profile.where(F.col("window.start") < first)
        if not inside.isEmpty():
            raise ValueError(f"{since} is not the start of a window of {granularity}")
        # A small table: a line per window and model. Stored before it replaces what it reads.
        old = read_table(spark, target).where(F.col("window.start") < first)
        profile = cut_lineage(old.unionByName(profile), "profile")
    write_named(profile, target)
    return target


def must_retrain(
    spark: SparkSession,
    table: str,
    metric: str = "root_mean_squared_error",
    threshold: float = 100.0,
    windows: int = 5,
    violations: int = 2,
) -> bool:
    """Whether the stored profile of ``table`` calls for retraining."""
    profile = read_table(spark, table + PROFILE_SUFFIX)
    return is_violated(violation_check(profile, metric, threshold, windows, violations))


DAY_MINUTES = 24 * 60


def profile_states(spark: SparkSession, path: str, minutes: int = DAY_MINUTES) -> WindowStates:
    """The table of partial sums of the error profile at ``path``."""
    return WindowStates(spark, path, ["model_id"], PROFILE_MEASURES, minutes)


def add_predictions(states: WindowStates, rows: DataFrame, batch: int, **columns: str) -> None:
    """Add a batch of predictions with labels, of whatever time; a batch that comes again replaces itself.

    ``columns`` names those of :func:`judged_rows`. No earlier prediction is read again.
    """
    require_utc(states.spark)
    states.add(judged_rows(rows, **columns), "at", batch)


def store_profile(states: WindowStates, target: str) -> None:
    """Write the profile of all batches, a line per window and model, under the name ``target``."""
    write_named(profile_of_states(states.windows()), target)


def drift_states(spark: SparkSession, path: str, columns: Sequence[str], minutes: int = DAY_MINUTES) -> WindowStates:
    """The table of counts and quantile sketches of ``columns`` at ``path``."""
    return WindowStates(spark, path, [], sketch_measures(columns), minutes)
