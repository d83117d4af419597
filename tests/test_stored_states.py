"""Profiles and drift from stored partial states."""

import random
from datetime import datetime, timedelta

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import profile
from tidemark.plans import monitoring
from tidemark.session import scratch_path

START = datetime(2024, 1, 1)
PREDICTIONS = "model_id int, prediction double, fare_amount double, timestamp timestamp"


def predictions(seed, count, days):
    rng = random.Random(seed)
    return [
        (rng.choice((1, 2, None)), rng.choice((None, rng.uniform(0, 50))), rng.choice((None, 1.0, rng.uniform(1, 50), rng.uniform(1, 50))),
         START + timedelta(seconds=rng.randrange(days * 86400)))
        for _ in range(count)
    ]


def test_profile_of_states_equals_profile_of_rows(spark):
    """Late batches, one that runs twice, a window of one row, rows that are not judged."""
    parts = [predictions(1, 200, 2), predictions(2, 200, 6), predictions(3, 5, 2) + [(7, 1.0, 2.0, START + timedelta(days=40))]]
    states = monitoring.profile_states(spark, scratch_path(spark, "profile"))
    for n, part in enumerate([*parts, []]):
        monitoring.add_predictions(states, spark.createDataFrame(part, PREDICTIONS), n)
        so_far = sum(parts[: n + 1], [])
        whole = profile.error_profile(spark.createDataFrame(so_far, PREDICTIONS))
        shown = ["window", "model_id", "log_type", "count", *[F.round(c, 9) for c in whole.columns[6:]]]
        found = profile.profile_of_states(states.windows()).select(*shown)
        order = ["window", "model_id"]
        assert rows(found, *order) == rows(whole.select(*shown), *order)
    monitoring.add_predictions(states, spark.createDataFrame(parts[1], PREDICTIONS), 1)
    assert rows(profile.profile_of_states(states.windows()).select(*shown), *order) == rows(whole.select(*shown), *order)
    name = f"default.{scratch_path(spark, 'p').rsplit('/', 1)[1].replace('-', '_')}"
    monitoring.store_profile(states, name)
    assert spark.table(name).count() == whole.count()
    spark.sql(f"DROP TABLE {name}")


def test_sketched_drift_is_within_its_rank_error(spark):
    rng = np.random.default_rng(5)
    n = 60_000
    day = rng.integers(0, 4, n)
    value = rng.lognormal(1, 1, n) + (day == 3) * 2.0
    data = [(START + timedelta(days=int(d), seconds=i % 80_000), float(v), None) for i, (d, v) in enumerate(zip(day, value, strict=True))]
    data += [(START + timedelta(days=1), float("nan"), None), (START + timedelta(days=1), None, None), (START + timedelta(days=9), None, None)]
    df = spark.createDataFrame(data, "t timestamp, v double, w double").repartition(6)
    states = monitoring.drift_states(spark, scratch_path(spark, "drift"), ["v", "w"])
    states.add(df.where("v < 3"), "t", 0)
    read = df.where("NOT coalesce(v < 3, false)")
    states.add(read, "t", 1)
    found = {(r.window.start.day - 1, r.column_name): r for r in profile.drift_of_sketches(states.windows(), ["v", "w"], "2024-01-04").collect()}
    early = np.sort(value[day < 3])
    for d in range(4):
        r, mine = found[d, "v"], np.sort(value[day == d])
        assert (r.rows, r.nulls) == (len(mine) + 2 * (d == 1), 2 * (d == 1))
        assert r.smallest == mine[0] and r.largest == mine[-1] and abs(r.mean - mine.mean()) < 1e-9 if d != 1 else True
        assert abs(np.searchsorted(mine, r.percentile, "right") / len(mine) - 0.5) < 0.005
        at = np.concatenate([mine, early])
        exact = np.abs(np.searchsorted(mine, at, "right") / len(mine) - np.searchsorted(early, at, "right") / len(early)).max()
        assert abs(r.distance - exact) < 0.02 and (r.distance > 0.2) == (d == 3)
        w = found[d, "w"]
        assert w.nulls == w.rows == r.rows and (w.mean, w.smallest, w.percentile, w.distance) == (None,) * 4
    assert found[9, "v"].nulls == 1 and found[9, "v"].distance is None
    none = profile.drift_of_sketches(states.windows(), ["v", "w"], "2023-01-01")
    assert none.where("distance IS NOT NULL").isEmpty() and none.count() == 10
    edges = profile.baseline_edges(states.windows(), ["v", "w"], "2024-01-04", 4)
    assert set(edges) == {"v"} and len(edges["v"]) == 3
    shares = [np.searchsorted(early, e, "right") / len(early) for e in edges["v"]]
    assert np.abs(np.array(shares) - [0.25, 0.5, 0.75]).max() < 0.005
    assert profile.drift_of_columns(df, "t", edges, "2024-01-04").count() == 5
