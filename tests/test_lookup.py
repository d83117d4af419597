"""Point-in-time lookup against a direct search, on data with hot keys, ties and gaps."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators.lookup import FeatureLookup, _Asked, join_labels, lookup_features, training_set

START = datetime(2024, 1, 1)
BASE = "id long, k int, t timestamp"
FEATURES = "zip int, ts timestamp, a double, b int"


def make(spark, base, features, **kw):
    lookup = FeatureLookup(
        spark.createDataFrame(features, FEATURES), ("a", "b"), ("k",), "t", ("zip",), "ts", **kw
    )
    return spark.createDataFrame(base, BASE), lookup


def search(base, features):
    out = []
    for i, k, t in base:
        held = [f for f in features if k is not None and t is not None and f[0] == k and f[1] <= t]
        best = max(held, key=lambda f: f[1], default=None)
        out.append((i, k, t, best[2] if best else None, best[3] if best else None))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_direct_search(spark, seed):
    rng = random.Random(seed)
    base = [
        # A third of the rows share one key and one instant.
        (i, 1, START + timedelta(hours=30)) if i % 3 == 0
        else (i, rng.choice([1, 2, 3, 9, None]), rng.choice([None, START + timedelta(seconds=rng.randrange(300_000))]))
        for i in range(400)
    ]
    times = rng.sample(range(0, 300_000, 60), 80)
    features = [
        (rng.choice([1, 2, 3]), START + timedelta(seconds=s), rng.choice([None, float(s)]), s) for s in times
    ]
    frame, lookup = make(spark, base, features)
    assert rows(lookup_features(frame, [lookup]), "id") == search(base, features)


def test_edges(spark):
    t = START + timedelta(hours=5)
    base = [(1, 1, t), (2, 1, t - timedelta(microseconds=1)), (3, 1, t + timedelta(days=40)), (4, 2, t), (5, None, t), (6, 1, None)]
    features = [(1, t, None, 7)]
    frame, lookup = make(spark, base, features)
    got = {r[0]: r[3:] for r in rows(lookup_features(frame, [lookup]), "id")}
    # An equal time matches, an earlier one does not; a null value of the newest row stays null.
    assert got == {1: (None, 7), 2: (None, None), 3: (None, 7), 4: (None, None), 5: (None, None), 6: (None, None)}


def test_newest_row_wins_even_if_its_value_is_null(spark):
    base = [(1, 1, START + timedelta(hours=9))]
    features = [(1, START, 1.0, 1), (1, START + timedelta(hours=2), None, None)]
    frame, lookup = make(spark, base, features)
    assert rows(lookup_features(frame, [lookup]), "id")[0][3:] == (None, None)


def test_chain_with_rename_keeps_every_row(spark):
    base = [(i, i % 3, START + timedelta(minutes=i)) for i in range(50)]
    features = [(z, START + timedelta(minutes=m), float(m), m) for z in range(3) for m in range(0, 60, 7)]
    frame, first = make(spark, base, features)
    _, second = make(spark, base, features, rename={"a": "a2", "b": "b2"})
    got = lookup_features(frame, [first, second])
    assert got.columns == ["id", "k", "t", "a", "b", "a2", "b2"]
    assert got.count() == 50 and got.filter("NOT (a <=> a2 AND b <=> b2)").isEmpty()


def test_composite_key(spark):
    base = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 3)], "k int, region string, id int")
    base = base.withColumn("t", F.lit("2024-01-01 12:00:00").cast("timestamp"))
    features = spark.createDataFrame([(1, "x", 5.0), (2, "y", 6.0)], "zip int, area string, v double")
    features = features.withColumn("ts", F.lit("2024-01-01 10:30:00").cast("timestamp"))
    lookup = FeatureLookup(features, ("v",), ("k", "region"), "t", ("zip", "area"), "ts")
    got = lookup_features(base, [lookup]).select("id", "v")
    assert rows(got, "id") == [(1, 5.0), (2, None), (3, None)]


def test_one_feature_column_name_twice_is_refused(spark):
    frame, lookup = make(spark, [(1, 1, START)], [(1, START, 1.0, 1)])
    with pytest.raises(ValueError, match="ambiguous"):
        lookup_features(frame.withColumn("a", F.lit(0)), [lookup])
    with pytest.raises(ValueError, match="ambiguous"):
        lookup_features(frame, [lookup, lookup])


def test_duplicate_base_rows_stay_duplicate(spark):
    frame, lookup = make(spark, [(1, 1, START)] * 5, [(1, START, 1.0, 1)])
    assert lookup_features(frame, [lookup]).count() == 5


def test_training_set_needs_its_label(spark):
    frame, lookup = make(spark, [(1, 1, START)], [(1, START, 1.0, 1)])
    assert training_set(frame, [lookup], "id", ["t"]).columns == ["id", "k", "a", "b"]
    with pytest.raises(ValueError):
        training_set(frame, [lookup], "fare")


def test_second_feature_row_of_a_key_and_time_fails(spark):
    at = START + timedelta(hours=1)
    for twice in ([(1, at, 1.0, 1), (1, at, 2.0, 2)], [(1, at, None, None)] * 2):
        features = [(1, START + timedelta(seconds=s), 0.0, s) for s in range(50)] + twice
        frame, lookup = make(spark, [(1, 1, START)], features)
        with pytest.raises(Exception, match="duplicate feature key"):
            lookup_features(frame, [lookup]).collect()
    # The same key and time in two tables, or rows that can never be met, are no duplicates.
    features = [(1, START, 1.0, 1), (None, START, 1.0, 1), (None, START, 2.0, 1), (1, None, 1.0, 1), (1, None, 1.0, 1)]
    frame, first = make(spark, [(1, 1, START)], features)
    _, second = make(spark, [], features, rename={"a": "a2", "b": "b2"})
    assert rows(lookup_features(frame, [first, second]), "id") == [(1, 1, START, 1.0, 1, 1.0, 1)]


@pytest.mark.parametrize("batch", [3, 10_000])
@pytest.mark.parametrize("every", [1, 7, 400, 100_000])
def test_one_key_in_one_minute_spreads_over_all_tasks(spark, batch, every):
    """Features are dense, thin, or one row at the very head, whose value goes through all tasks."""
    at = lambda n: START + timedelta(microseconds=1000 * n)
    base = [(n, 1, at(n)) for n in range(3000)] + [(9000, 0, at(5)), (9001, 2, at(5))]
    features = [(1, at(n), float(n), n) for n in range(0, 3000, every)] + [(0, at(6), 0.0, 0), (2, at(4), 2.0, 2)]
    settings = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": batch,
        "spark.sql.shuffle.partitions": 16,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        frame, lookup = make(spark, base, features)
        asked = [F.lit(0).alias("p"), F.col("k"), F.col("t"), F.lit(True).alias("__asked"), F.lit(None).cast("int").alias("v")]
        dealt = frame.select(*asked).repartitionByRange("p", "k", "t").groupBy(F.spark_partition_id()).count()
        sizes = [r[1] for r in dealt.collect()]
        assert len(sizes) == 16 and max(sizes) < 2 * 3002 / 16
        found = lookup_features(frame, [lookup])
        assert rows(found, "id") == search(base, features)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lookups_of_different_keys_types_and_times(spark):
    """Keys of unlike types and numbers, one pair of columns asked twice, one table used for two pairs."""
    rng = random.Random(4)
    day = lambda: START + timedelta(minutes=rng.randrange(3000))
    base = [(i, rng.choice((1, 2, None)), rng.choice("xy"), day(), rng.choice((day(), None))) for i in range(300)]
    one = [(k, START + timedelta(minutes=m), m) for k in (1, 2) for m in rng.sample(range(3000), 30)]
    two = [(k, a, START + timedelta(minutes=m), -m) for k in (1, 2) for a in "xy" for m in rng.sample(range(3000), 30)]
    frame = spark.createDataFrame(base, "id long, k int, area string, t timestamp, u timestamp")
    first = spark.createDataFrame(one, "zip long, ts timestamp, v int")
    second = spark.createDataFrame(two, "zip int, area string, ts timestamp, w int")
    lookups = [
        FeatureLookup(first, ("v",), ("k",), "t", ("zip",), "ts"),
        FeatureLookup(second, ("w",), ("k", "area"), "u", ("zip", "area"), "ts"),
        FeatureLookup(first, ("v",), ("k",), "u", ("zip",), "ts", {"v": "v_u"}),
        FeatureLookup(first, ("v",), ("k",), "t", ("zip",), "ts", {"v": "v_again"}),
    ]

    def best(held, at):
        return max((h for h in held if at is not None and h[-2] <= at), key=lambda h: h[-2], default=(None,))[-1]

    expected = []
    for i, k, a, t, u in base:
        mine, pairs = [h for h in one if h[0] == k], [h for h in two if h[:2] == (k, a)]
        expected.append((i, k, a, t, u, best(mine, t), best(pairs, u), best(mine, u), best(mine, t)))
    found = lookup_features(frame, lookups)
    assert found.columns == ["id", "k", "area", "t", "u", "v", "w", "v_u", "v_again"]
    assert rows(found, "id") == sorted(expected)


def test_base_rows_are_read_once_for_all_instants(spark, tmp_path, capsys):
    base = [(i, i % 3, START + timedelta(minutes=i)) for i in range(50)]
    features = [(z, START + timedelta(minutes=m), float(m), m) for z in range(3) for m in range(0, 60, 7)]
    spark.createDataFrame(base, BASE).withColumn("u", F.col("t")).write.parquet(f"{tmp_path}/base")
    frame = spark.read.parquet(f"{tmp_path}/base")
    table = spark.createDataFrame(features, FEATURES)
    lookups = [
        FeatureLookup(table, ("a",), ("k",), "t", ("zip",), "ts"),
        FeatureLookup(table, ("b",), ("k",), "u", ("zip",), "ts"),
    ]
    _Asked(frame, lookups).instants().explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == 1 and "ReadSchema: struct<k:int,t:timestamp,u:timestamp>" in plan
    found = lookup_features(frame, lookups)
    found.explain()
    plan = capsys.readouterr().out
    assert plan.count(f"{tmp_path}/base") == 1 and "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_lookups_and_empty_tables(spark):
    frame, lookup = make(spark, [(1, 1, START)], [])
    assert lookup_features(frame, []).columns == frame.columns
    assert rows(lookup_features(frame, [lookup]), "id") == [(1, 1, START, None, None)]
    assert lookup_features(frame.limit(0), [lookup]).collect() == []


def test_labels_join_keeps_predictions(spark):
    preds = spark.createDataFrame([(1, 0.5), (2, 0.7)], "id int, prediction double").withColumn("y", F.lit(None).cast("double"))
    labels = spark.createDataFrame([(1, 3.0)], "id int, y double")
    assert rows(join_labels(preds, labels, ["id"], "y"), "id") == [(1, 0.5, 3.0), (2, 0.7, None)]
