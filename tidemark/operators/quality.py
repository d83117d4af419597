"""Data-quality rules: count failing rows, keep or drop them, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate. Rows for which it is false or null fail the rule."""

    name: str
    predicate: str
    drop: bool = False

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


# The rule sets of the sensor tables. Fixed values.
BRONZE_RULES = (
    Rule("valid_event_time", "event_time IS NOT NULL", drop=True),
    Rule("valid_sensor_id", "sensor_id BETWEEN 1 AND 10000", drop=True),
)
SILVER_WARN_RULES = (
    Rule("not_null_temperature", "temperature IS NOT NULL"),
    Rule("temperature_safe_range", "temperature BETWEEN -20 AND 120"),
)
SILVER_DROP_RULES = (
    Rule("valid_temperature", "temperature BETWEEN -5 AND 80", drop=True),
    Rule("valid_humidity", "humidity BETWEEN 0 AND 100", drop=True),
)
GOLD_RULES = (Rule("non_null_avg_temp", "avg_temp_5m IS NOT NULL", drop=True),)


def failures(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates: rows checked, and rows that fail each rule."""
    return [F.count(F.lit(1)).alias("checked"), *[F.count_if(~r.holds()).alias(f"failed_{r.name}") for r in rules]]


def expect(df: DataFrame, rules: Sequence[Rule], observe: Observation | str | None = None) -> DataFrame:
    """Apply rules to a batch or a stream: failing rows of ``drop`` rules go, others stay.

    With ``observe``, counts of checked and failing rows are taken on the way, without a
    second pass; a string names the metrics for a stream's progress events.
    """
    if not rules:
        return df
    if observe is not None:
        df = df.observe(observe, *failures(rules))
    for rule in rules:
        if rule.drop:
            df = df.filter(rule.holds())
    return df


def report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with the number of passing and failing rows, from a single pass."""
    counts = []
    for i, rule in enumerate(rules):
        counts.append(F.count_if(rule.holds()).alias(f"p{i}"))
        counts.append(F.count_if(~rule.holds()).alias(f"f{i}"))
    parts = ", ".join(f"'{r.name}', p{i}, f{i}" for i, r in enumerate(rules))
    return df.agg(*counts).selectExpr(f"stack({len(rules)}, {parts}) AS (rule, passed, failed)")
