"""What several operators share: tables, folds, stored copies, scratch clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import use_checkpoints

LEARN_FOLDS = 5
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def long_id(df: DataFrame, name: str = "doc_id") -> Column:
    """The id as a long; left alone if it is one, so that equal scans stay equal to the planner."""
    return F.col(name) if df.schema[name].dataType == T.LongType() else F.col(name).cast("long").alias(name)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of ids that nothing may learn from; a null id is held out too."""
    return fold(doc_id) == 0


def fold(doc_id: Column) -> Column:
    """Fold 0 to 4 of an id; 0 for a null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % LEARN_FOLDS


def kept(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared checkpoint folder and cut its lineage.

    Survives lost executors; Spark removes the files once nothing refers to them, where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on.
    """
    use_checkpoints(df.sparkSession)
    return df.checkpoint()
