"""Every registered query with an SQL form gives the same rows in DuckDB."""

import __spark_entry__ as entry
import pytest
from compare import connect, differences
from conftest import SMALL

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    assert differences(entry.queries()[name](spark, SMALL), duck, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry_gives_one_row_per_trip(spark):
    df = entry.entry(spark)
    assert df.count() == spark.read.parquet(f"{SMALL}/events.parquet").count()
