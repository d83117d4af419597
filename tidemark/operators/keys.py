"""Checks of row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pass ``df`` through; its job fails on a null key or on a second row with the same key."""
    seen = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    null_key = F.lit(False)
    for key in keys:
        null_key = null_key | F.col(key).isNull()
    first = keys[0]
    checked = (
        F.when(null_key, F.raise_error(F.lit(f"null in feature key {list(keys)}")))
        .when(F.col("__seen") > 1, F.raise_error(F.lit(f"duplicate feature key {list(keys)}")))
        .otherwise(F.col(first))
    )
    return df.withColumn("__seen", seen).withColumn(first, checked).select(*df.columns)
