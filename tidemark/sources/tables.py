"""Batch inputs and outputs: by path, by name, by SQL text."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the predictions table. Fixed values.
PREDICTIONS_SCHEMA = T.StructType(
    [
        T.StructField("model_id", T.LongType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def stored_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """What is stored under ``path`` (or a pattern of paths), None if nothing is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    if not found:
        return None
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files
            return None
        raise


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_sql(spark: SparkSession, text: str) -> DataFrame:
    """Use a query, for instance one passed as a job parameter, as the input."""
    if not text:
        raise ValueError("the input query must not be empty")
    return spark.sql(text)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def ensure_namespace(spark: SparkSession, table: str) -> None:
    """Create the schema of a two- or three-part table name; a bare name is refused."""
    parts = table.split(".")
    if len(parts) < 2:
        raise ValueError(f"{table!r} names no schema; put one in front, as in 'features.{table}'")
    spark.sql("CREATE SCHEMA IF NOT EXISTS " + ".".join(quoted(p) for p in parts[:-1][-2:]))


def quoted(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def table_ident(name: str) -> str:
    return ".".join(quoted(p) for p in name.split("."))


def column_ddl(schema: T.StructType) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)


def create_empty_table(spark: SparkSession, name: str, schema: T.StructType = PREDICTIONS_SCHEMA) -> None:
    """Create a typed table without rows unless it exists."""
    ensure_namespace(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table_ident(name)} ({column_ddl(schema)}) USING PARQUET")


def register_path(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Give stored Parquet files a table name, and make the catalog see their partitions.

    An earlier registration of another path, or whose columns no longer fit the files, is
    replaced; only the catalog entry is dropped, never files.
    """
    ensure_namespace(spark, name)
    if spark.catalog.tableExists(name):
        stored = spark.read.parquet(path).schema
        fits = {(f.name, f.dataType) for f in stored} == {(f.name, f.dataType) for f in spark.table(name).schema}
        if not fits or not same_path(table_location(spark, name), path):
            if spark.catalog.getTable(name).tableType != "EXTERNAL":
                raise ValueError(f"{name} is a table of its own, not a name for {path}")
            spark.sql(f"DROP TABLE {table_ident(name)}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table_ident(name)} USING PARQUET LOCATION '{path}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.sql(f"MSCK REPAIR TABLE {table_ident(name)}")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def table_location(spark: SparkSession, name: str) -> str:
    """Where the files of a table lie."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table_ident(name)}").where("col_name = 'Location'").first()
    return found["data_type"] if found else ""


def same_path(left: str, right: str) -> bool:
    def plain(path: str) -> str:
        return "/" + path.removeprefix("file:").strip("/") if path.startswith(("file:", "/")) else path.rstrip("/")

    return plain(left) == plain(right)


def spread_for_write(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Gather each output partition into few files, with large partitions split over tasks."""
    if not partition_by:
        return df
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def overwrite_path(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("yyyy_mm",),
    fmt: str = "parquet",
    only_touched: bool = False,
) -> None:
    """Replace a stored table; its schema may change.

    With ``only_touched`` just the partitions that have rows in ``df`` are replaced. The session's
    own overwrite mode plays no part.
    """
    writer = spread_for_write(df, partition_by).write.format(fmt).mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "dynamic" if only_touched else "static").save(path)


def drop_partitions(spark: SparkSession, path: str, column: str, gone: Callable[[str], bool]) -> None:
    """Remove the top folders ``column=value`` under ``path`` whose value is ``gone``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(at, f"{column}=*")) or ():
        if gone(found.getPath().getName().partition("=")[2]):
            files.delete(found.getPath(), True)


def write_named(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Replace (or append to) a named table; its schema may change on replacement."""
    ensure_namespace(df.sparkSession, name)
    df.write.format(fmt).mode(mode).saveAsTable(name)
