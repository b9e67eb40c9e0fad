import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from flowlab.operators import approximate
from flowlab.operators.approximate import Tables, approximate_neighbours, knn_approximate
from flowlab.operators.neighbours import _Sides, knn_classify, nearest
from flowlab.operators.split import train_test
from flowlab.plans.views import vectors
from tests.plans import assert_absent

SF_DIR = "/root/testdata/sf0.01"


def recall(spark, train, queries, k=7, **options):
    sides = _Sides.of(train, queries, "embedding", "label", "vec_id", None)
    found = approximate_neighbours(sides, k, **{"tables": 8, "hashes": 8, "probes": 40, "seed": 2, "tile_rows": 1 << 15, **options}).collect()
    got = {}
    for r in found:
        got.setdefault(r.q, set()).add(r.id)
    t, q = (df.select("vec_id", "embedding").toPandas().sort_values("vec_id", ignore_index=True) for df in (train, queries))
    wanted = {}
    for row, col, _ in nearest(*(np.stack(p["embedding"].to_numpy()).astype(float) for p in (q, t)), k):
        for i, j in zip(row, col):
            wanted.setdefault(q["vec_id"][i], set()).add(t["vec_id"][j])
    assert all(len(v) <= k for v in got.values())
    return np.mean([len(wanted[i] & got.get(i, set())) / len(wanted[i]) for i in wanted]), len(found)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_vectors(spark, sf):
    """Independent directions: the hard case."""
    train, test = train_test(vectors(spark, f"/root/testdata/{sf}"), "label", ["vec_id"])
    assert recall(spark, train, test)[0] >= 0.9


def clustered(rng, n, first):
    """Forty clusters; a third of the rows are copies of one point."""
    x = rng.integers(0, 40, size=(n, 1)) * np.linspace(-3, 3, 12) + rng.normal(size=(n, 12)) * 0.2
    x[: n // 3] = 1.0
    return pd.DataFrame({"vec_id": range(first, first + n), "label": rng.integers(0, 3, n), "embedding": x.tolist()})


@pytest.mark.parametrize("tile_rows", [1 << 15, 64])
def test_recall_on_clusters_with_a_hot_bucket(spark, tile_rows):
    rng = np.random.default_rng(5)
    train, queries = spark.createDataFrame(clustered(rng, 1500, 0)).repartition(3), spark.createDataFrame(clustered(rng, 120, 9000))
    share, rows = recall(spark, train, queries, tile_rows=tile_rows)
    assert share >= 0.9 and rows <= 7 * 120


def test_predictions_and_rows_that_cannot_be_compared(spark):
    train = spark.createDataFrame([(i, i % 2, [float(i % 2) * 100 + (i % 7) * 0.1, 1.0]) for i in range(60)], "id long, y int, x array<double>")
    queries = spark.createDataFrame(
        [(0, [0.2, 1.0]), (1, [100.2, 1.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0])], "id long, x array<double>"
    )
    df = knn_approximate(train, queries, "x", "y", "id", k=5)
    assert {r.id: r.prediction for r in df.collect()} == {0: 0, 1: 1, 2: None, 3: None, 4: None}
    assert_absent(df, "CartesianProduct", "NestedLoop")
    exact = knn_classify(train, queries.filter("id < 2"), "x", "y", "id", k=5)
    assert {r.id: r.prediction for r in exact.collect()} == {0: 0, 1: 1}
    assert knn_approximate(train, queries.filter("id > 9"), "x", "y", "id").count() == 0


def test_probes_are_buckets_next_door():
    tables = Tables.drawn(5, 3, 4, 2.0, 1)
    points = np.random.default_rng(1).normal(size=(50, 5))
    probes = tables.probes(points, 8)
    assert probes.shape == (50, 3, 9) and np.array_equal(probes[..., 0], tables.keys(points))
    assert all(len(set(p)) == 9 for row in probes for p in row)
    moved = points[:, None] + np.random.default_rng(2).normal(size=(50, 20, 5)) * 0.3
    hit = [[(tables.keys(m) == own[None, :, 0]).mean(), np.mean([np.isin(key, own[t]).mean() for t, key in enumerate(tables.keys(m).T)])] for m, own in zip(moved, probes)]
    alone, probed = np.mean(hit, axis=0)
    assert probed > alone


def test_rows_leave_a_task_a_few_at_a_time_and_once_a_bucket(spark):
    """A query looks into hundreds of buckets; what it sends is cut by pairs, and a bucket that comes twice counts once."""
    x = np.random.default_rng(2).normal(size=(50, 8))
    part = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(list(x))], names=["q", "x"])
    found = approximate.keyed_rows(part, lambda p: np.array([[7, -3, 7, 5]] * len(p)), 4).to_pydict()
    assert found["q"][:4] == [0, 0, 0, 1] and found["key"][:3] == [-3, 5, 7] and found["bin"][:3] == [1, 1, 3]
    assert np.allclose(found["x"][3], x[1]) and len(found["q"]) == 150
    rows = spark.createDataFrame([(i, i % 3, v.tolist()) for i, v in enumerate(x)], "id long, y int, x array<double>")
    sides = _Sides.of(rows, rows, "x", "y", "id", None)
    sizes, keyed = [], approximate.keyed_rows
    for chunk in (1, 100, 1 << 13):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(approximate, "CHUNK_PAIRS", chunk)
            sizes.append(sorted(approximate_neighbours(sides, 3, 4, 4, 10, 2, 1000).select("q", "id").collect()))
    assert sizes[0] == sizes[1] == sizes[2] and len(sizes[0]) >= 50


def test_broadcast_vectors_are_not_copied_for_each_batch(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(40, 4))
    rows = spark.createDataFrame([(i, i % 3, v.tolist()) for i, v in enumerate(x)], "id long, y int, x array<double>")
    held = []
    context = type(spark.sparkContext)
    monkeypatch.setattr(context, "broadcast", lambda self, value, f=context.broadcast: held.append(value) or f(self, value))
    assert knn_classify(rows, rows, "x", "y", "id", k=1).filter("prediction = id % 3").count() == 40
    tables = [v for v in held if isinstance(v, tuple) and isinstance(v[-1], np.ndarray)]
    assert len(tables) == 1 and tables[0][1].shape == (40, 4) and "x" not in tables[0][0].columns
