"""Model validation: metrics of a candidate against limits and against a baseline model."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metrics import (
    CUSTOM_METRICS,
    VALIDATION_THRESHOLDS,
    Metric,
    Threshold,
    check_thresholds,
    compare_models,
    regression_metrics,
)
from tidemark.plans.training import ScoringModel, rounded_trips
from tidemark.session import require_utc
from tidemark.sources.tables import read_sql

RUN_MODES = ("disabled", "dry_run", "enabled")

# Loader functions a job may name: custom metrics and threshold sets.
METRIC_SETS: dict[str, Mapping[str, Metric]] = {"custom_metrics": CUSTOM_METRICS, "none": {}}
THRESHOLD_SETS: dict[str, Mapping[str, Threshold]] = {"validation_thresholds": VALIDATION_THRESHOLDS, "none": {}}


class ValidationFailed(Exception):
    """A candidate missed a limit while validation was enabled."""


@dataclass(frozen=True)
class ValidationResult:
    metrics: DataFrame | None
    checks: DataFrame | None
    passed: bool | None


def find_plugin(registry: Mapping[str, Mapping], name: str) -> Mapping:
    """A registered set by name, or the result of ``package.module:function``."""
    if name in registry:
        return registry[name]
    module, _, function = name.partition(":")
    if not function:
        raise KeyError(f"{name} is not one of {sorted(registry)}")
    return getattr(import_module(module), function)()


def validate_predictions(
    scored: DataFrame,
    target: str,
    run_mode: str = "enabled",
    custom_metrics: str = "custom_metrics",
    thresholds: str = "validation_thresholds",
    baseline: DataFrame | None = None,
) -> ValidationResult:
    """Check scored rows against a threshold set, and against a baseline's scored rows if given.

    ``disabled`` does nothing, ``dry_run`` reports, ``enabled`` raises on a missed limit.
    """
    if run_mode not in RUN_MODES:
        raise ValueError(f"run_mode must be one of {RUN_MODES}, got {run_mode!r}")
    if run_mode == "disabled":
        return ValidationResult(None, None, None)
    custom = find_plugin(METRIC_SETS, custom_metrics)
    limits = find_plugin(THRESHOLD_SETS, thresholds)
    metrics = _once(regression_metrics(scored, "prediction", target, custom=custom))
    if not limits:
        return ValidationResult(metrics, None, True)
    checks = check_thresholds(metrics, limits)
    failed = [r["metric"] for r in checks.filter("NOT passed").collect()]  # at most one row per limit
    if baseline is not None:
        changes = baseline_changes(
            metrics, _once(regression_metrics(baseline, "prediction", target, custom=custom)), limits
        )
        failed += [f"{r['metric']} against baseline" for r in changes.filter("NOT passed").collect()]
    if failed and run_mode == "enabled":
        raise ValidationFailed(f"limits missed: {', '.join(sorted(failed))}")
    return ValidationResult(metrics, checks, not failed)


def _once(metrics: DataFrame) -> DataFrame:
    """Compute a one-row frame now, so that its uses do not score the input again."""
    return metrics.sparkSession.createDataFrame([metrics.first()], metrics.schema)


def baseline_changes(
    candidate: DataFrame, baseline: DataFrame, thresholds: Mapping[str, Threshold]
) -> DataFrame:
    """Compare two one-row metric frames."""
    both = candidate.withColumn("model_id", F.lit("candidate")).unionByName(
        baseline.withColumn("model_id", F.lit("baseline"))
    )
    return compare_models(both, thresholds, "candidate", "baseline")


def validate_trip_model(
    spark: SparkSession,
    model: ScoringModel,
    validation_input: str,
    target: str = "fare_amount",
    run_mode: str = "enabled",
    baseline_model: ScoringModel | None = None,
    **plugins: str,
) -> ValidationResult:
    """Validate a trip model on the rows of a SQL query."""
    if run_mode == "disabled":
        return ValidationResult(None, None, None)
    require_utc(spark)
    rows = rounded_trips(read_sql(spark, validation_input), view="taxi_data")
    baseline = baseline_model.score(rows) if baseline_model else None
    return validate_predictions(model.score(rows), target, run_mode, baseline=baseline, **plugins)

