import uuid
from datetime import datetime

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from tidemark.plans.features import pickup_features, run_feature_job
from tidemark.session import cut_lineage, require_utc
from tidemark.sources import sample_views as views
from tidemark.sources import tables
from tidemark.sources.feature_table import FeatureTable, merge_rows, unique_rows

SCHEMA = "zip int, ts timestamp, v double, note string"


def name(label):
    return f"spark_catalog.unit_{uuid.uuid4().hex[:8]}.{label}"


def feats(spark, *data):
    df = spark.createDataFrame(list(data), "zip int, t string, v double, note string")
    return df.select("zip", F.col("t").cast("timestamp").alias("ts"), "v", "note")


@pytest.fixture
def table(spark):
    start = feats(spark, (1, "2024-01-05", 1.0, "a"), (1, "2024-02-05", 2.0, "b"), (2, "2024-02-06", 3.0, "c"))
    t = FeatureTable.create(spark, name("feats"), start, ["zip"], "ts")
    t.merge(start)
    return t


def held(t):
    return [(r["zip"], str(r["ts"])[:10], r["v"], r["note"]) for r in t.read().orderBy("zip", "ts").collect()]


def test_upsert_updates_inserts_and_keeps(spark, table):
    table.merge(feats(spark, (1, "2024-02-05", 20.0, "new"), (3, "2024-03-01", 4.0, "d")))
    assert held(table) == [
        (1, "2024-01-05", 1.0, "a"), (1, "2024-02-05", 20.0, "new"), (2, "2024-02-06", 3.0, "c"), (3, "2024-03-01", 4.0, "d"),
    ]


def test_upsert_twice_equals_once(spark, table):
    change = feats(spark, (2, "2024-02-06", 30.0, None), (9, "2024-01-01", 5.0, "x"))
    table.merge(change)
    once = held(table)
    table.merge(change)
    assert held(table) == once and len(once) == 4


def test_upsert_leaves_other_months_alone(spark, table):
    files = {f for f in spark.table(table.name).inputFiles() if "2024-01" in f}
    table.merge(feats(spark, (5, "2024-02-07", 1.0, "x")))
    assert {f for f in spark.table(table.name).inputFiles() if "2024-01" in f} == files


@pytest.mark.parametrize("bad", [(2, "2024-02-06", 9.0, "again"), (None, "2024-02-06", 9.0, "no key"), (4, None, 1.0, "no time")])
def test_repeated_or_null_keys_are_refused(spark, table, bad):
    before = held(table)
    with pytest.raises(Exception, match="feature key"):
        table.merge(feats(spark, (2, "2024-02-06", 8.0, "x"), bad))
    assert held(table) == before


def test_empty_upsert_is_nothing(spark, table):
    before = held(table)
    table.merge(feats(spark, (1, "2024-01-01", 1.0, "x")).limit(0))
    assert held(table) == before


def test_full_refresh_replaces_all_months(spark, table):
    table.overwrite(feats(spark, (7, "2024-05-01", 1.0, "only")))
    assert held(table) == [(7, "2024-05-01", 1.0, "only")]


def test_create_is_a_no_op_for_an_existing_table(spark, table):
    again = FeatureTable.create(spark, table.name, table.read(), ["zip"], "ts")
    assert len(held(again)) == 3 and again.keys == ["zip", "ts"]
    with pytest.raises(ValueError, match="other keys"):
        FeatureTable.create(spark, table.name, table.read(), ["note"], "ts")


def test_key_columns_must_exist(spark):
    with pytest.raises(ValueError, match="key columns"):
        FeatureTable.create(spark, name("feats"), feats(spark, (1, "2024-01-05", 1.0, "a")), ["nope"], "ts")


def test_read_scans_only_the_months_of_the_range(spark, table, capsys):
    part = table.read("2024-02-01", "2024-02-06")
    assert [r["note"] for r in part.collect()] == ["b"]
    part.explain("formatted")
    assert "PartitionFilters: [isnotnull(yyyy_mm" in capsys.readouterr().out


def test_a_plain_table_is_no_feature_table(spark):
    plain = name("plain")
    tables.create_empty_table(spark, plain)
    with pytest.raises(ValueError, match="not a feature table"):
        FeatureTable(spark, plain)


def test_feature_job_in_parts_equals_one_run(spark):
    path, target = f"{cut(spark, views.trips(spark, SMALL))}", name("pickup")
    keys, ts = "zip", "tpep_pickup_datetime"
    run_feature_job(spark, path, target, "pickup_features", keys, ts)
    whole = rows(FeatureTable(spark, target).read(), "zip", ts)
    expected = pickup_features(views.trips(spark, SMALL), ts)
    assert len(whole) == expected.count()
    run_feature_job(spark, path, target, "pickup_features", keys, ts, "2024-01-10", "2024-01-12")
    again = FeatureTable(spark, target).read()
    assert rows(again, "zip", ts) == whole
    for start, end in ((None, "2024-01-10 07:10:00"), ("2024-01-10 07:10:00", "2024-01-12"), ("2024-01-12", None)):
        run_feature_job(spark, path, target + "_parts", "pickup_features", keys, ts, start, end)
    assert rows(FeatureTable(spark, target + "_parts").read(), "zip", ts) == whole
    run_feature_job(spark, path, target, "pickup_features", keys, ts, full_refresh=True)
    assert rows(FeatureTable(spark, target).read(), "zip", ts) == whole


def cut(spark, df):
    from tidemark.session import scratch_path

    path = scratch_path(spark, "input")
    df.write.parquet(path)
    return path


def test_job_needs_its_parameters(spark):
    with pytest.raises(ValueError):
        run_feature_job(spark, "", "a.b", "pickup_features", "zip", "ts")
    with pytest.raises(ValueError, match="names no schema"):
        run_feature_job(spark, "/tmp/none", "bare", "pickup_features", "zip", "ts")


def test_unique_rows_passes_good_rows(spark):
    good = feats(spark, (1, "2024-01-05", 1.0, "a"), (1, "2024-01-06", 2.0, "b"))
    assert rows(unique_rows(good, ["zip", "ts"]), "ts") == rows(good, "ts")


def test_merge_rows_columns_follow_the_current_table(spark):
    current = feats(spark, (1, "2024-01-05", 1.0, "a"))
    incoming = feats(spark, (1, "2024-01-05", 2.0, "b")).select("note", "v", "ts", "zip")
    assert merge_rows(current, incoming, ["zip", "ts"]).columns == current.columns


def test_path_overwrite_may_change_the_schema(spark):
    from tidemark.session import scratch_path

    path = scratch_path(spark, "over")
    df = feats(spark, (1, "2024-01-05", 1.0, "a")).withColumn("yyyy_mm", F.lit("2024-01"))
    tables.overwrite_path(df, path)
    tables.overwrite_path(df.withColumn("extra", F.lit(1)), path)
    back = tables.read_path(spark, path)
    assert back.count() == 1 and "extra" in back.columns
    assert back.schema["yyyy_mm"].dataType.simpleString() == "string"
    target = name("over")
    assert tables.register_path(spark, target, path).count() == 1
    tables.overwrite_path(df.withColumn("other", F.lit("x")), path)
    again = tables.register_path(spark, target, path)
    assert "other" in again.columns and "extra" not in again.columns and again.count() == 1


def test_registering_spares_tables_of_their_own(spark):
    from tidemark.session import scratch_path

    target, path = name("own"), scratch_path(spark, "files")
    tables.create_empty_table(spark, target)
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="table of its own"):
        tables.register_path(spark, target, path)


def test_named_tables(spark):
    target = name("preds")
    tables.create_empty_table(spark, target)
    tables.create_empty_table(spark, target)
    empty = tables.read_table(spark, target)
    assert empty.isEmpty() and [f.dataType.simpleString() for f in empty.schema] == ["bigint", "double", "double", "timestamp"]
    tables.write_named(spark.range(3), target)
    tables.write_named(spark.range(2), target, mode="append")
    assert tables.read_table(spark, target).count() == 5


def test_sql_text_must_not_be_empty(spark):
    with pytest.raises(ValueError):
        tables.read_sql(spark, "")


def test_zone_check(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stored_copy_keeps_rows_and_types(spark):
    df = feats(spark, (1, "2024-01-05", 1.0, "a"), (2, None, None, None))
    copy = cut_lineage(df)
    assert copy.schema == df.schema and rows(copy, "zip") == rows(df, "zip")
    assert rows(copy, "zip")[0][1] == datetime(2024, 1, 5)


@pytest.mark.parametrize(
    ("start", "end", "found"),
    [
        ("2024-1-1", None, 3),
        ("2024-02-01T00:00:00+09:00", None, 2),
        (None, "2024-2-1", 2),
        ("2024-01-31 15:30:00", "2024-02-01T00:00:00Z", 1),
    ],
)
def test_read_takes_every_spelling_of_a_time(spark, start, end, found):
    rows_in = spark.sql(
        "SELECT 1 AS k, timestamp(t) AS t FROM VALUES ('2024-01-05 00:00:00'), ('2024-01-31 15:30:00'), "
        "('2024-02-01 00:00:00') AS v(t)"
    )
    table = FeatureTable.create(spark, name("spelled"), rows_in, ["k"], "t")
    table.merge(rows_in)
    assert table.read(start, end).count() == found


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_overwrites_do_not_depend_on_the_sessions_mode(spark, mode):
    old = spark.sql("SELECT 1 AS k, timestamp'2024-01-05' AS t, '2024-01' AS yyyy_mm")
    new = spark.sql("SELECT 2 AS k, timestamp'2024-03-05' AS t, '2024-03' AS yyyy_mm")
    path = cut(spark, old)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        table = FeatureTable.create(spark, name("fresh"), old, ["k"], "t")
        table.merge(old)
        table.merge(new)
        assert table.read().count() == 2
        table.overwrite(new)
        assert [r.k for r in table.read().collect()] == [2]
        tables.overwrite_path(old, path + "-out")
        tables.overwrite_path(new, path + "-out")
        assert [r.k for r in spark.read.parquet(path + "-out").collect()] == [2]
        tables.overwrite_path(old, path + "-out", only_touched=True)
        assert spark.read.parquet(path + "-out").count() == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_a_name_follows_its_path_and_a_table_its_columns(spark):
    one, two = cut(spark, spark.range(3)), cut(spark, spark.range(5))
    registered = name("path")
    assert tables.register_path(spark, registered, one).count() == 3
    assert tables.register_path(spark, registered, two).count() == 5
    first = spark.sql("SELECT 1 AS k, timestamp'2024-01-05' AS t, 1.0D AS v")
    table = FeatureTable.create(spark, name("grown"), first, ["k"], "t")
    table.merge(first)
    table.merge(spark.sql("SELECT 2 AS k, timestamp'2024-01-06' AS t, 2.0D AS v, 'x' AS w"))
    assert [(r.k, r.v, r.w) for r in table.read().orderBy("k").collect()] == [(1, 1.0, None), (2, 2.0, "x")]
    with pytest.raises(ValueError, match="not at"):
        FeatureTable.create(spark, table.name, first, ["k"], "t", "/elsewhere")
