"""Train/test split by a hash of the row key: repeatable and independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_bucket


def is_train(key: Column, train_percent: int = 75, seed: int = 123) -> Column:
    """Whether a row belongs to the training part; rows without a key do."""
    return F.coalesce(hash_bucket(key, 100, seed) < train_percent, F.lit(True))


def row_key(df: DataFrame) -> Column:
    """A text of all columns, for rows without a key of their own; equal rows have equal ones."""
    return F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"})


def hash_split(
    df: DataFrame, key: str | None = None, train_percent: int = 75, seed: int = 123
) -> tuple[DataFrame, DataFrame]:
    """Two frames that together hold every row exactly once; without a key, by the whole row."""
    chosen = is_train(F.col(key) if key else row_key(df), train_percent, seed)
    return df.filter(chosen), df.filter(~chosen)
