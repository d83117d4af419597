"""Centroid clustering against whole rounds in plain Python."""

import hashlib
import math
import random

import pytest

from tidemark.llm import centroids

ROWS = "cluster string, vec_id long, embedding array<float>, x int"


def brute(rows, size, scale, count, rounds, seed):
    kept = [
        (i, [math.floor(scale * v) for v in e])
        for _, i, e, _ in rows
        if e is not None and len(e) == size and all(v is not None and math.isfinite(v) for v in e)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    now = [x for _, x in order[:count]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), k) for k, c in enumerate(now))

    for _ in range(rounds):
        members = {}
        for _, x in kept:
            members.setdefault(nearest(x)[1], []).append(x)
        now = [
            [sum(v) // len(members[k]) for v in zip(*members[k], strict=True)] if k in members else c
            for k, c in enumerate(now)
        ]
    return [(i, nearest(x)[1], nearest(x)[0]) for i, x in kept], now


def sample(count, size, seed=3):
    rng = random.Random(seed)
    homes = [[rng.uniform(-1, 1) for _ in range(size)] for _ in range(5)]
    rows = [("a", i, [h + rng.gauss(0, 0.2) for h in homes[i % 5]], i) for i in range(count)]
    rows += [("a", 1000 + i, rows[0][2], None) for i in range(count // 2)]  # one vector many times
    rows += [("b", i, rows[n % count][2], 0) for i, n in ((7, 7), (7, 8), (None, 3), (None, 4))]
    odd = [None, [], [0.0] * (size - 1), [0.0] * (size + 1), [None] * size]
    odd += [[float("nan")] + [0.0] * (size - 1), [float("-inf")] + [0.0] * (size - 1)]
    return rows + [("c", 5000 + n, e, n) for n, e in enumerate(odd)] + [("d", 9, [0.0] * size, 1)]


@pytest.mark.parametrize(("count", "size", "clusters", "rounds"), [(60, 4, 7, 5), (30, 3, 40, 3), (2, 3, 2, 0)])
def test_clusters_equal_whole_rounds(spark, count, size, clusters, rounds):
    rows = [(a, i, e and [None if v is None else float(f"{v:.3f}") for v in e], x) for a, i, e, x in sample(count, size)]
    table = spark.createDataFrame(rows, ROWS).repartition(5)
    as_floats = [tuple(r) for r in table.select("cluster", "vec_id", "embedding", "x").collect()]
    found = centroids.cluster(table, size=size, scale=256, centroids=clusters, rounds=rounds, seed=2)
    expected, now = brute(as_floats, size, 256, clusters, rounds, 2)
    assert found.centroids == now
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, found.assigned.collect()), key=key) == sorted(expected, key=key)
    total = sum(d for *_, d in expected)
    for r in centroids.with_inertia(found).collect():
        assert r.inertia == total and r.cluster_inertia == sum(d for _, c, d in expected if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, now[r.cluster])).encode()).hexdigest()


def test_no_vectors_and_too_large_components(spark):
    empty = spark.createDataFrame([("a", 1, None, 1)], ROWS)
    for rows in (empty, empty.limit(0)):
        found = centroids.cluster(rows, size=3)
        assert found.centroids == [] and centroids.with_inertia(found).collect() == []
    huge = spark.createDataFrame([("a", 1, [1e30, 0.0, 0.0], 1)], ROWS)
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(huge, size=3)
