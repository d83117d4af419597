"""Keyed feature tables: a Parquet table partitioned by month, with its keys as table properties.

An upsert rewrites only the months it touches. The rows of those months are joined with the
incoming rows by key, and the result replaces the months by dynamic partition overwrite.
Commit of several months is not atomic and there may be only one writer at a time; since
upserting the same rows twice equals doing it once, a broken run is repaired by repeating it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timekeys import month_key
from tidemark.operators.filters import Bound, months_between, time_range
from tidemark.operators.keys import unique_rows
from tidemark.operators.lookup import FeatureLookup
from tidemark.session import drop_stored, scratch_path
from tidemark.sources.tables import column_ddl, ensure_namespace, quoted, same_path, spread_for_write, table_ident, table_location

MONTH = "yyyy_mm"
KEYS_PROPERTY = "feature.primary_keys"
TIME_PROPERTY = "feature.timestamp_key"


def merge_rows(current: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows, plus the current rows whose key does not come in."""
    kept = current.join(incoming.select(*keys), list(keys), "left_anti")
    return kept.select(*current.columns).unionByName(incoming.select(*current.columns))


_writing = Lock()


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str) -> Iterator[None]:
    """Hold the overwrite mode for one write: ``dynamic`` replaces the partitions in the data only.

    Inserts by name take it from the session alone; the lock keeps writes of other threads out.
    """
    setting = "spark.sql.sources.partitionOverwriteMode"
    with _writing:
        before = spark.conf.get(setting)
        spark.conf.set(setting, mode)
        try:
            yield
        finally:
            spark.conf.set(setting, before)


class FeatureTable:
    """A named feature table. Its key is the primary keys together with the timestamp key."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        rows = spark.sql(f"SHOW TBLPROPERTIES {table_ident(name)}").collect()
        properties = {r["key"]: r["value"] for r in rows}
        if KEYS_PROPERTY not in properties:
            raise ValueError(f"{name} is not a feature table")
        self.primary_keys = properties[KEYS_PROPERTY].split(",")
        self.timestamp_key = properties[TIME_PROPERTY]

    @property
    def keys(self) -> list[str]:
        return [*self.primary_keys, self.timestamp_key]

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        name: str,
        df: DataFrame,
        primary_keys: Sequence[str],
        timestamp_key: str,
        location: str | None = None,
    ) -> FeatureTable:
        """Create the table with the columns of ``df`` (no rows); nothing happens if it exists."""
        ensure_namespace(spark, name)
        missing = [k for k in (*primary_keys, timestamp_key) if k not in df.columns]
        if missing:
            raise ValueError(f"key columns {missing} are not in {df.columns}")
        schema = _with_month(df, timestamp_key).schema
        where = f" LOCATION '{location}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table_ident(name)} ({column_ddl(schema)}) USING PARQUET "
            f"PARTITIONED BY ({MONTH}){where} TBLPROPERTIES "
            f"('{KEYS_PROPERTY}' = '{','.join(primary_keys)}', '{TIME_PROPERTY}' = '{timestamp_key}')"
        )
        table = cls(spark, name)
        if table.keys != [*primary_keys, timestamp_key]:
            raise ValueError(f"{name} exists with other keys: {table.keys}")
        if location and not same_path(table_location(spark, name), location):
            raise ValueError(f"{name} exists at {table_location(spark, name)}, not at {location}")
        return table

    def read(self, start: Bound = None, end: Bound = None) -> DataFrame:
        """Rows with ``start <= timestamp < end``; only their months are scanned."""
        df = self.spark.table(self.name)
        if start or end:
            kind = df.schema[self.timestamp_key].dataType.simpleString()
            df = df.filter(months_between(start, end, MONTH, kind))
        return time_range(df, self.timestamp_key, start, end)

    def merge(self, df: DataFrame) -> None:
        """Update rows whose key exists, insert the others; a repeated key is refused.

        A column the table does not have yet is added to it; rows stored before have null there.
        """
        columns = self._grown_to(df)
        incoming = unique_rows(_with_month(df, self.timestamp_key).select(*columns), self.keys)
        # Stored once: the month list and the join below both read it.
        path = scratch_path(self.spark, "upsert")
        incoming.write.parquet(path)
        try:
            incoming = self.spark.read.schema(incoming.schema).parquet(path)
            months = [r[0] for r in incoming.select(MONTH).distinct().collect()]  # one row per month
            if months:
                touched = self.spark.table(self.name).filter(F.col(MONTH).isin(months))
                self._replace_months(merge_rows(touched, incoming, self.keys))
        finally:
            drop_stored(self.spark, path)

    def overwrite(self, df: DataFrame) -> None:
        """Full refresh: replace every row of the table; new columns are added to it."""
        columns = self._grown_to(df)
        fresh = unique_rows(_with_month(df, self.timestamp_key).select(*columns), self.keys)
        with _overwrite_mode(self.spark, "static"):
            spread_for_write(fresh, [MONTH]).write.insertInto(self.name, overwrite=True)

    def _replace_months(self, rows: DataFrame) -> None:
        with _overwrite_mode(self.spark, "dynamic"):
            spread_for_write(rows, [MONTH]).write.insertInto(self.name, overwrite=True)

    def _grown_to(self, df: DataFrame) -> list[str]:
        """The table's columns, after those that only ``df`` has were added."""
        have = set(self.spark.table(self.name).columns)
        new = [f for f in df.schema.fields if f.name not in have]
        if new:
            added = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
            self.spark.sql(f"ALTER TABLE {table_ident(self.name)} ADD COLUMNS ({added})")
        return self.spark.table(self.name).columns

    def lookup(
        self,
        feature_names: Sequence[str],
        lookup_key: Sequence[str],
        timestamp_lookup_key: str,
        rename: dict[str, str] | None = None,
    ) -> FeatureLookup:
        """A point-in-time lookup into this table."""
        return FeatureLookup(
            features=self.read(),
            feature_names=tuple(feature_names),
            lookup_key=tuple(lookup_key),
            timestamp_lookup_key=timestamp_lookup_key,
            primary_keys=tuple(self.primary_keys),
            timestamp_key=self.timestamp_key,
            rename=dict(rename or {}),
        )


def _with_month(df: DataFrame, timestamp_key: str) -> DataFrame:
    return df if MONTH in df.columns else df.withColumn(MONTH, month_key(F.col(timestamp_key)))
