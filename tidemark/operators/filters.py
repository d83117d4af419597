"""Row filters, column choice and schema enforcement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Bound = str | date | datetime | None

# Plausible sensor ranges, both ends included. Fixed values.
PLAUSIBLE_STRICT = {"temperature": (-5, 80), "humidity": (0, 100)}
PLAUSIBLE_WIDE = {"temperature": (-10, 80), "humidity": (0, 100)}


def time_range(df: DataFrame, ts: str, start: Bound = None, end: Bound = None) -> DataFrame:
    """Keep ``start <= ts < end``; an empty or missing bound is no bound.

    Bounds go in as text, so that they take the column's own type and the comparison reaches
    the Parquet scan.
    """
    if ts and start:
        df = df.filter(F.col(ts) >= F.lit(str(start)))
    if ts and end:
        df = df.filter(F.col(ts) < F.lit(str(end)))
    return df


def months_between(start: Bound, end: Bound, column: str = "yyyy_mm", kind: str = "timestamp") -> Column:
    """Partition predicate for a half-open time range on a month-partitioned table.

    The months are those of the bounds as times of type ``kind``, that of the time column.
    """

    def month(bound: Bound) -> Column:
        return F.date_format(F.lit(str(bound)).cast(kind), "yyyy-MM")

    keep = F.lit(True)
    if start:
        keep = keep & (F.col(column) >= month(start))
    if end:
        keep = keep & (F.col(column) <= month(end))
    return keep


def plausible(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = PLAUSIBLE_STRICT) -> DataFrame:
    """Keep rows whose columns all lie inside their ranges; nulls drop."""
    for column, (low, high) in ranges.items():
        df = df.filter(F.col(column).between(low, high))
    return df


def stamp(df: DataFrame, model_version: int | str, run_time: str, model_column: str = "model_id") -> DataFrame:
    """Add the model id and the run time as constant columns."""
    return df.withColumns({model_column: F.lit(model_version), "timestamp": F.to_timestamp(F.lit(run_time))})


def features_of(df: DataFrame, label: str, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the model inputs: every column but the label and the excluded ones."""
    return [c for c in df.columns if c != label and c not in exclude]


# Non-null reading schema of the bronze table. Fixed values.
READING_SCHEMA = T.StructType(
    [
        T.StructField("sensor_id", T.IntegerType(), False),
        T.StructField("event_time", T.TimestampType(), False),
        T.StructField("temperature", T.DoubleType(), False),
        T.StructField("humidity", T.DoubleType(), False),
        T.StructField("pressure", T.DoubleType(), False),
    ]
)


def enforce_schema(df: DataFrame, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """Fixed columns, order and types; rows with a null in a required column drop."""
    required = [f.name for f in schema.fields if not f.nullable]
    for name in required:
        df = df.filter(F.col(name).isNotNull())
    return df.select(*[_as_declared(f).alias(f.name) for f in schema.fields])


def _as_declared(field: T.StructField) -> Column:
    """The column in its type; for a required one a default that is never used makes it non-null."""
    value = F.col(field.name).cast(field.dataType)
    if field.nullable:
        return value
    if isinstance(field.dataType, T.TimestampType):
        return F.coalesce(value, F.timestamp_seconds(F.lit(0)))
    return F.coalesce(value, F.lit("" if isinstance(field.dataType, T.StringType) else 0).cast(field.dataType))


def rescue_json(df: DataFrame, text: str, schema: T.StructType, rescued: str = "_rescued_data") -> DataFrame:
    """Parse one JSON document per row.

    Text that does not fit lands whole in ``rescued``; of text that fits, the fields outside the
    schema do, as one JSON object of texts.
    """
    fields = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    wide = T.StructType([*fields, T.StructField(rescued, T.StringType(), True)])
    parsed = F.from_json(F.col(text), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": rescued})
    known = [f.name for f in fields]
    others = F.map_filter(F.from_json(F.col(text), "map<string, string>"), lambda name, _: ~name.isin(known))
    unknown = F.when(F.size(others) > 0, F.to_json(others))
    kept = [c for c in df.columns if c != text]
    return df.withColumns({"_row": parsed, "_others": unknown}).select(
        *kept, *[f"_row.{n}" for n in known], F.coalesce(f"_row.{rescued}", "_others").alias(rescued)
    )
