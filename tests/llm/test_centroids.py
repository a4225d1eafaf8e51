"""Centroid clustering against a search of every centroid."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm.centroid_search import (
    REACH,
    Centroids,
    assigned,
    clustered,
    first_centroids,
    whole_vectors,
)

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(points, centroids):
    found = []
    for p in points:
        best = min((sum((x - y) ** 2 for x, y in zip(p, c)), n) for n, c in enumerate(centroids))
        found.append((best[1], best[0]))
    return found


def brute_rounds(named, clusters, rounds):
    order = sorted(
        (hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), p) for i, p in named
    )
    centroids = [p for _, p in order[:clusters]]
    points = [p for _, p in named]
    for _ in range(rounds):
        held = brute(points, centroids)
        for n in range(len(centroids)):
            mine = [p for p, (c, _) in zip(points, held) if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    return centroids, brute(points, centroids)


def integers(vector):
    return [max(-REACH, min(REACH, int(np.floor(64 * float(np.float32(x)))))) for x in vector]


def sample(seed=5, count=300, size=6):
    made = random.Random(seed)
    rows = [(i, [made.gauss(0, 1) for _ in range(size)], 0) for i in range(count)]
    rows += [(1000 + i % 3, [0.5] * size, 1) for i in range(150)]
    rows += [(None, [made.gauss(0, 2) for _ in range(size)], 2) for _ in range(5)]
    rows += [(7, [1e30, -1e30] + [0.0] * (size - 2), 3)]
    odd = [(2000, None, 0), (2001, [], 0), (2002, [1.0] * (size + 1), 0)]
    odd += [(2003 + i, [bad] + [1.0] * (size - 1), 0) for i, bad in enumerate(
        [None, float("nan"), float("inf"), float("-inf")])]
    return rows, odd


@pytest.mark.parametrize("scale", [1, 50, 1 << 20])
def test_search_equals_all_distances(scale):
    made = np.random.default_rng(scale)
    points = made.integers(-scale, scale + 1, (500, 8))
    centroids = made.integers(-scale, scale + 1, (40, 8))
    centroids[7] = centroids[31]
    points[3] = centroids[31]
    cluster, distance, computed = Centroids(centroids.tolist()).nearest(points)
    expected = brute(points.tolist(), centroids.tolist())
    assert list(zip(cluster.tolist(), distance.tolist())) == expected
    assert cluster[3] == 7
    assert computed < len(points) * len(centroids)


def test_search_rejects_most_centroids_of_spread_vectors():
    made = np.random.default_rng(3)
    centroids = made.integers(-50, 50, (200, 16)) + np.arange(200)[:, None] * 40
    points = centroids[made.integers(0, 200, 2000)] + made.integers(-3, 4, (2000, 16))
    cluster, distance, computed = Centroids(centroids.tolist()).nearest(points)
    assert computed < 0.05 * len(points) * len(centroids)
    assert list(zip(cluster.tolist(), distance.tolist()))[:50] == brute(
        points[:50].tolist(), centroids.tolist()
    )


def test_rounds(spark):
    rows, odd = sample()
    frame = spark.createDataFrame(rows + odd, SCHEMA).repartition(5)
    found = clustered(frame, clusters=9, rounds=3, dimensions=6).collect()
    named = [(i, integers(v)) for i, v, _ in rows]
    centroids, held = brute_rounds(named, 9, 3)
    totals = {n: sum(d for c, d in held if c == n) for n in range(9)}
    expected = [
        (i, c, d, totals[c], sum(totals.values()), centroids[c])
        for (i, _), (c, d) in zip(named, held)
    ]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_clashing_columns_and_other_ids(spark):
    rows, _ = sample(count=40)
    frame = spark.createDataFrame([(f"v{i}", v, 1, 2, "x") for i, v, _ in rows],
                                  "vec_id string, embedding array<double>, point int, "
                                  "cluster int, `a.b` string")
    found = clustered(frame, clusters=4, rounds=1, dimensions=6)
    assert found.count() == len(rows)
    assert dict(found.dtypes)["vec_id"] == "string"


def test_fewer_vectors_than_clusters_and_none(spark):
    frame = spark.createDataFrame([(1, [0.0, 1.0], 0), (2, [1.0, 1.0], 0)], SCHEMA)
    found = clustered(frame, clusters=5, rounds=3, dimensions=2).collect()
    assert sorted(r.distance for r in found) == [0, 0] and len({r.cluster for r in found}) == 2
    none = clustered(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0
    assert none.columns[:5] == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia"]


def test_an_empty_cluster_keeps_its_centroid(spark):
    # Ten equal vectors: only the first centroid gets any.
    frame = spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(10)], SCHEMA)
    found = clustered(frame, clusters=3, rounds=2, dimensions=2).collect()
    assert {r.cluster for r in found} == {0} and {tuple(r.centroid) for r in found} == {(64, 128)}


def test_a_pass_moves_no_vectors(spark):
    rows, _ = sample(count=40)
    points = whole_vectors(spark.createDataFrame(rows, SCHEMA), 6)
    plan = assigned(points, first_centroids(points, 4))._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()
