from collections import Counter

import numpy as np
import pandas as pd
import pytest

from flowlab.operators.neighbours import _distances, _Pivots, knn_classify, knn_visits, nearest
from tests.plans import assert_absent


def brute(train, queries, k):
    """Prediction by sorting every distance."""
    result = {}
    for _, q in queries.iterrows():
        found = []
        for _, t in train.iterrows():
            total = 0.0
            for a, b in zip(q["x"], t["x"]):
                total += (a - b) * (a - b)
            found.append((np.sqrt(total), t["id"], t["label"]))
        votes = Counter(label for _, _, label in sorted(found)[:k])
        result[q["id"]] = min(votes, key=lambda label: (-votes[label], label))
    return result


def sample(rng, n, first, copies=0):
    """Points of four clusters; the first ``copies`` rows are one and the same point."""
    x = rng.integers(0, 4, size=(n, 1)) * 3.0 + rng.normal(size=(n, 3)).round(1)
    x[:copies] = [3.0, 3.0, 3.0]
    return pd.DataFrame({"id": range(first, first + n), "label": rng.integers(0, 3, n), "x": x.tolist()})


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    # Two fifths of both sides are copies of one point: a hot cell and ties everywhere.
    return sample(rng, 250, 0, copies=100), sample(rng, 60, 1000, copies=25)


@pytest.mark.parametrize("options", [
    {}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "tile_rows": 16}, {"broadcast_bytes": 0, "tile_rows": 16, "cell_rows": 4},
    {"broadcast_bytes": 0, "tile_rows": 3, "cell_rows": 1},
])
@pytest.mark.parametrize("k", [1, 7])
def test_equals_brute_force(spark, data, options, k):
    train, queries = data
    t, q = spark.createDataFrame(train).repartition(3), spark.createDataFrame(queries).repartition(2)
    df = knn_classify(t, q, "x", "label", "id", k=k, **options)
    assert {r.id: r.prediction for r in df.collect()} == brute(train, queries, k)
    assert_absent(df, "CartesianProduct", "NestedLoop")


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_text_ids_columns_and_small_training_sets(spark, options):
    train = spark.createDataFrame([("b", "x", 0.0, 1.0), ("a", "y", 0.0, 1.0), ("c", "x", 9.0, 9.0)], "id string, label string, u double, v double")
    queries = spark.createDataFrame([("q1", 0, 1), ("q2", 8, 8)], "name string, u int, v int")
    near = knn_classify(train, queries, ["u", "v"], "label", "id", "name", k=1, **options)
    assert dict(map(tuple, near.collect())) == {"q1": "y", "q2": "x"}
    every = knn_classify(train, queries, ["u", "v"], "label", "id", "name", k=7, **options)
    assert dict(map(tuple, every.collect())) == {"q1": "x", "q2": "x"}


def test_empty_sides(spark):
    df = spark.createDataFrame([(1, 0, [1.0])], "id int, label int, x array<double>")
    for options in ({}, {"broadcast_bytes": 0}):
        assert knn_classify(df, df.filter("id > 5"), "x", "label", "id", **options).count() == 0
    with pytest.raises(ValueError, match="empty"):
        knn_classify(df.filter("id > 5"), df, "x", "label", "id")


def test_screening_keeps_near_ties():
    rng = np.random.default_rng(8)
    train = rng.normal(size=(400, 6)) * 1e-6 + 1e3
    queries = train[:40] + 1e-9
    exact = np.sqrt(((queries[:, None, :] - train[None]) ** 2).sum(-1))
    for row, col, distance in nearest(queries, train, 5):
        for i in range(40):
            assert np.allclose(np.sort(exact[i])[:5], distance[row == i], rtol=1e-6)


@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_rows_that_cannot_be_compared(spark, broadcast_bytes):
    train = spark.createDataFrame([(i, i % 2, [float(i), 1.0]) for i in range(20)], "id long, y int, x array<double>")
    bad = [None, [float("nan"), 1.0], [None, 1.0], [float("inf"), 1.0], [1.0]]
    queries = spark.createDataFrame(
        [(i, [float(i), 1.0]) for i in range(5)] + list(enumerate(bad, 10)), "id long, x array<double>"
    )
    got = {r.id: r.prediction for r in knn_classify(train, queries, "x", "y", "id", k=1, broadcast_bytes=broadcast_bytes).collect()}
    assert got == {i: i % 2 for i in range(5)} | {i: None for i in range(10, 15)}
    for x in bad:
        worse = train.union(spark.createDataFrame([(99, 1, x)], train.schema))
        with pytest.raises(ValueError):
            knn_classify(worse, queries, "x", "y", "id", k=1, broadcast_bytes=broadcast_bytes)
    with pytest.raises(ValueError):
        knn_classify(train, queries.union(queries), "x", "y", "id", broadcast_bytes=broadcast_bytes)


def test_few_bins_are_visited(spark):
    """Clusters far apart: the bound of the home bin rules out the others."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 40, size=(2000, 1)) * 100.0 + rng.normal(size=(2000, 3))
    rows = pd.DataFrame({"id": range(2000), "label": 0, "x": x.tolist()})
    df = spark.createDataFrame(rows)
    found = knn_visits(df, df.filter("id % 10 = 0"), "x", "label", "id", k=5, tile_rows=50, cell_rows=10).collect()
    assert len(found) == 200 and all(1 <= r.bins <= r.of for r in found) and found[0].of > 20
    assert np.mean([r.bins for r in found]) < 0.2 * found[0].of


def test_open_cells_miss_no_row_within_the_bound():
    rng = np.random.default_rng(9)
    points, queries = rng.normal(size=(600, 4)), rng.normal(size=(50, 4))
    points[:100] = points[0]
    pivots = _Pivots.of(np.unique(points[::7], axis=0))
    cell, gap = pivots.cells(points)
    radius = np.full(len(pivots.fine), -1.0)
    np.maximum.at(radius, cell, gap)
    bound = rng.random(50) * 2
    row, found = pivots.open_cells(queries, bound + 1e-6, radius, pivots.reach(radius))
    opened = set(zip(row.tolist(), found.tolist()))
    near = np.argwhere(_distances(queries, points) <= bound[:, None])
    assert all((q, cell[p]) in opened for q, p in near.tolist()) and len(opened) < 50 * len(pivots.fine)


def test_both_sides_of_a_bin_meet_when_many_tasks_share_the_keys(spark):
    """Partitions are not merged here, as with large tables; rows of one bin must be dealt to one task all the same."""
    x = np.random.default_rng(5).normal(size=(600, 3))
    rows = spark.createDataFrame([(i, i % 4, v.tolist()) for i, v in enumerate(x)], "id long, y int, x array<double>")
    train, queries = rows.filter("id >= 60"), rows.filter("id < 60")
    wanted = sorted(knn_classify(train, queries, "x", "y", "id", k=5).collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = sorted(knn_classify(train, queries, "x", "y", "id", k=5, broadcast_bytes=0, tile_rows=50, cell_rows=10).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == wanted and len(got) == 60
