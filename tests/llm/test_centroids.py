import hashlib
import math

import numpy as np
import pytest

from flowlab.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster int, distance string"


def by_hand(rows, clusters, rounds, seed):
    """Plain k-means in whole numbers."""
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest()))
    centres = [v for _, v in order[:clusters]]

    def assign():
        found = []
        for _, v in kept:
            gaps = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            found.append((gaps.index(min(gaps)), min(gaps)))
        return found

    for _ in range(rounds):
        found = assign()
        for c in range(len(centres)):
            own = [v for (_, v), (k, _) in zip(kept, found) if k == c]
            if own:
                centres[c] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    inertia = [sum(d for k, d in found if k == c) for c in range(len(centres))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i is None, i or 0), k, d, inertia[k], sum(inertia), digest[k]) for (i, _), (k, d) in zip(kept, found))


def by_spark(spark, rows, clusters, rounds=5, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = centroids.clustered(df, clusters=clusters, rounds=rounds).withColumn("digest", centroids.digest())
    return sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.digest) for r in found.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(5, 64))
    found = [(i, (middle[i % 5] + rng.normal(size=64) * 0.4).round(2).tolist(), 0, "x") for i in range(150)]
    copies = [(1000 + i, found[0][1], 0, "x") for i in range(60)]
    bad = [
        (2000, None, 0, "x"), (2001, [1.0] * 63, 0, "x"), (2002, [1.0] * 63 + [None], 0, "x"), (2003, [float("nan")] * 64, 0, "x"),
        (2004, [float("inf")] + [0.0] * 63, 0, "x"), (2005, [], 0, "x"), (2006, [0.0] * 64, 0, "x"), (None, [0.5] * 64, 0, "x"),
    ]
    return [*found, *copies, *bad, found[1], found[1]]


@pytest.mark.parametrize("clusters", [1, 7, 40])
def test_equals_plain_k_means(spark, rows, clusters):
    assert by_spark(spark, rows, clusters) == by_hand(rows, clusters, 5, 2)


def test_fewer_vectors_than_clusters_and_none(spark, rows):
    few = rows[:6]
    assert by_spark(spark, few, 40) == by_hand(few, 40, 5, 2)
    assert by_spark(spark, [], 40) == []
    assert by_spark(spark, [r for r in rows if r[0] in (2000, 2001, 2003)], 40) == []


def test_components_that_are_too_large_take_no_part(spark, rows):
    far = (3000, [3e38] + [0.0] * 63, 0, "x")
    got = by_spark(spark, [*rows[:50], far], 5)
    assert ((False, 3000), None, None, None, None) == got[-1][:5]
    assert got[:-1] == by_hand(rows[:50], 5, 5, 2)
    assert [r[1:5] for r in by_spark(spark, [far], 5)] == [(None,) * 4]


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(-centroids.LARGEST, centroids.LARGEST, size=(200, 64))
    w = centroids.walsh(x)
    assert np.array_equal(centroids.components(w), x)
    assert all(sum(int(a) ** 2 for a in one) == 64 * sum(int(b) ** 2 for b in two) for one, two in zip(w, x))
    changes = (np.diff(centroids.walsh(np.eye(64, dtype=np.int64)).T, axis=1) != 0).sum(1)
    assert changes.tolist() == list(range(64))


def test_search_equals_all_distances_and_keeps_ties():
    rng = np.random.default_rng(2)
    x, c = rng.integers(-3, 4, size=(500, 64)), rng.integers(-3, 4, size=(30, 64))
    c[20], x[:40] = c[5], c[5]
    gaps = ((x[:, None] - c[None]) ** 2).sum(2)
    cluster, distance = centroids.nearest(centroids.walsh(x), centroids.walsh(c))
    assert np.array_equal(cluster, gaps.argmin(1)) and np.array_equal(distance, gaps.min(1))
    assert set(cluster[:40].tolist()) == {5}
