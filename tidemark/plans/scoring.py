"""Batch prediction from a named table into a named table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.filters import stamp
from tidemark.operators.lookup import join_labels
from tidemark.plans.training import TRIP_LABEL, ScoringModel, rounded_trips
from tidemark.session import require_utc
from tidemark.sources.tables import read_table, write_named


def scoring_input(trips: DataFrame) -> DataFrame:
    """Rows to score: rounded times instead of raw ones, and no label."""
    return rounded_trips(trips).drop(TRIP_LABEL)


def predict_batch(
    spark: SparkSession,
    model: ScoringModel | str,
    input_table: str,
    output_table: str,
    model_version: int | str,
    run_time: str,
    mode: str = "overwrite",
) -> DataFrame:
    """Score a table, stamp model version and run time, and store the result.

    ``model`` may be the path of a saved model. ``mode="append"`` keeps earlier runs.
    """
    require_utc(spark)
    if isinstance(model, str):
        model = ScoringModel.load(spark, model)
    scored = stamp(model.score(read_table(spark, input_table)), model_version, run_time)
    write_named(scored, output_table, mode)
    return spark.table(output_table)


def label_predictions(
    spark: SparkSession,
    predictions_table: str,
    labels: DataFrame,
    on: Sequence[str],
    output_table: str,
    label: str = TRIP_LABEL,
) -> DataFrame:
    """Store predictions with the ground truth that has come in, as monitoring needs them."""
    require_utc(spark)
    write_named(join_labels(read_table(spark, predictions_table), labels, on, label), output_table)
    return spark.table(output_table)
