"""k-means against a plain loop."""

import hashlib

import numpy as np
import pytest

from rivulet.operators import clusters


def plain(points, k, tolerance, seed):
    unique = {}
    for ident, v in points:
        unique.setdefault(tuple(v), ident)
    start = sorted(unique, key=lambda v: hashlib.md5(f"{seed}:{unique[v]}".encode()).hexdigest())[:k]
    members, centres = np.array(list(unique)), np.array(start)
    while True:
        nearest = np.linalg.norm(members[:, None] - centres[None], axis=2).argmin(axis=1)
        moved = np.array([members[nearest == c].mean(axis=0) if (nearest == c).any() else centres[c] for c in range(k)])
        done = np.linalg.norm(moved - centres, axis=1).max() <= tolerance
        if done:
            return centres, moved
        centres = moved


@pytest.mark.parametrize("seed", [1, 42])
def test_matches_a_plain_loop(spark, seed):
    rng = np.random.default_rng(seed)
    data = [(i, [float(x) for x in np.float32(rng.normal(i % 3 * 5, 1, 3))]) for i in range(60)]
    data += [(100 + i, data[0][1]) for i in range(40)]  # copies of one point count once
    df = spark.createDataFrame(data, "id int, vec array<float>").repartition(3)
    result = clusters.kmeans(df, "vec", "id", 3, seed=seed)
    before, after = plain(data, 3, 0.01, seed)
    assert np.allclose(result.centres, after)
    got = {r.id: (r.cluster, r.distance) for r in result.assigned.collect()}
    assert len(got) == 100
    for ident, v in data:
        distances = np.linalg.norm(before - np.array(v), axis=1)
        assert got[ident][0] == distances.argmin() and np.isclose(got[ident][1], distances.min())


def test_thirteen_points_settle(spark):
    data = [(i, [float(i % 4), float(i // 4), 1.0]) for i in range(13)]
    result = clusters.kmeans(spark.createDataFrame(data, "id int, vec array<float>"), "vec", "id", 3)
    rows = result.assigned.collect()
    assert len(rows) == 13 and {r.cluster for r in rows} == {0, 1, 2}


def test_limits(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [0.0])], "id int, vec array<float>")
    with pytest.raises(ValueError):
        clusters.kmeans(df, "vec", "id", 2)
    with pytest.raises(ValueError):
        clusters.kmeans(df, "vec", "id", 0)
    assert clusters.kmeans(df, "vec", "id", 1).passes == 1
