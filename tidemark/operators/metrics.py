"""Regression metrics, thresholds and model comparison, each from a single aggregate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The smallest divisor in a percentage error (double machine epsilon). Fixed value.
EPSILON = 2.220446049250313e-16

Metric = Callable[[Column, Column], Column]


def _error(p: Column, t: Column) -> Column:
    return p - t


# Built-in metrics: name -> aggregate of (prediction, target).
REGRESSION_METRICS: dict[str, Metric] = {
    "example_count": lambda p, t: F.count(_error(p, t)),
    "mean_absolute_error": lambda p, t: F.avg(F.abs(_error(p, t))),
    "mean_squared_error": lambda p, t: F.avg(F.pow(_error(p, t), 2)),
    "root_mean_squared_error": lambda p, t: F.sqrt(F.avg(F.pow(_error(p, t), 2))),
    "sum_on_target": lambda p, t: F.sum(t),
    "mean_on_target": lambda p, t: F.avg(t),
    "r2_score": lambda p, t: F.lit(1.0) - F.try_divide(F.avg(F.pow(_error(p, t), 2)), F.var_pop(t)),
    "max_error": lambda p, t: F.max(F.abs(_error(p, t))),
    "mean_absolute_percentage_error": lambda p, t: F.avg(
        F.abs(_error(p, t)) / F.greatest(F.abs(t), F.lit(EPSILON))
    ),
}

# Custom metrics a validation job may add by name.
CUSTOM_METRICS: dict[str, Metric] = {
    "squared_diff_plus_one": lambda p, t: F.sum(F.pow(F.abs(p - t + F.lit(1)), 2)),
}


@dataclass(frozen=True)
class Threshold:
    """Limit for one metric, and how much a candidate must improve on a baseline model."""

    threshold: float | None = None
    greater_is_better: bool = False
    min_absolute_change: float | None = None
    min_relative_change: float | None = None


# The default validation gate. Fixed values.
VALIDATION_THRESHOLDS = {
    "max_error": Threshold(500.0),
    "mean_squared_error": Threshold(500.0),
}


def regression_metrics(
    df: DataFrame,
    prediction: str = "prediction",
    target: str = "target",
    by: Sequence[str] = (),
    custom: Mapping[str, Metric] | None = None,
) -> DataFrame:
    """One row of metrics (per group of ``by``), over rows that have prediction and target."""
    p, t = F.col(prediction), F.col(target)
    metrics = {**REGRESSION_METRICS, **(custom or {})}
    complete = df.filter(p.isNotNull() & t.isNotNull())
    return complete.groupBy(*by).agg(*[m(p, t).alias(name) for name, m in metrics.items()])


def as_rows(metrics: DataFrame, names: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Unpivot metric columns into ``(metric, value)`` rows."""
    doubles = metrics.select(*ids, *[F.col(n).cast("double").alias(n) for n in names])
    return doubles.unpivot([F.col(i) for i in ids], [F.col(n) for n in names], "metric", "value")


def _threshold_rows(df: DataFrame, thresholds: Mapping[str, Threshold]) -> DataFrame:
    """The thresholds as a small frame: one row per named metric."""
    schema = T.StructType(
        [
            T.StructField("metric", T.StringType(), False),
            T.StructField("threshold", T.DoubleType(), True),
            T.StructField("greater_is_better", T.BooleanType(), False),
            T.StructField("min_absolute_change", T.DoubleType(), True),
            T.StructField("min_relative_change", T.DoubleType(), True),
        ]
    )
    rows = [
        (name, t.threshold, t.greater_is_better, t.min_absolute_change, t.min_relative_change)
        for name, t in thresholds.items()
    ]
    return df.sparkSession.createDataFrame(rows, schema)


def check_thresholds(
    metrics: DataFrame, thresholds: Mapping[str, Threshold] = VALIDATION_THRESHOLDS
) -> DataFrame:
    """One row per limited metric: its value, its limit and whether it passed."""
    limits = _threshold_rows(metrics, thresholds)
    value, limit = F.col("value"), F.col("threshold")
    inside = F.when(F.col("greater_is_better"), value >= limit).otherwise(value <= limit)
    return (
        as_rows(metrics, list(thresholds))
        .join(limits, "metric")
        .select("metric", "value", "threshold", F.coalesce(inside, limit.isNull()).alias("passed"))
    )


def compare_models(
    metrics: DataFrame,
    thresholds: Mapping[str, Threshold],
    candidate: int | str,
    baseline: int | str,
    model_column: str = "model_id",
) -> DataFrame:
    """One row per metric: candidate and baseline values, the change and whether it is enough.

    ``metrics`` has one row per model. The change counts improvement as positive. A metric
    without a required change passes; over a baseline of zero any improvement is enough.
    """
    picked = metrics.filter(F.col(model_column).isin(candidate, baseline))
    pairs = (
        as_rows(picked, list(thresholds), [model_column])
        .groupBy("metric")
        .agg(
            F.max(F.when(F.col(model_column) == candidate, F.col("value"))).alias("candidate"),
            F.max(F.when(F.col(model_column) == baseline, F.col("value"))).alias("baseline"),
        )
    )
    new, old = F.col("candidate"), F.col("baseline")
    gain = F.when(F.col("greater_is_better"), new - old).otherwise(old - new)
    relative = F.try_divide(gain, F.abs(old))
    absolute_change, relative_change = F.col("min_absolute_change"), F.col("min_relative_change")
    enough_absolute = F.when(absolute_change.isNull(), True).otherwise(gain >= absolute_change)
    enough_relative = (
        F.when(relative_change.isNull(), True)
        .when(old == 0, gain >= F.lit(1e-10))
        .otherwise(relative >= relative_change)
    )
    return pairs.join(_threshold_rows(metrics, thresholds), "metric").select(
        "metric",
        "candidate",
        "baseline",
        gain.alias("absolute_change"),
        relative.alias("relative_change"),
        F.coalesce(enough_absolute & enough_relative, F.lit(False)).alias("passed"),
    )
