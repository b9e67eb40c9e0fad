import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from flowlab.operators import blocks, boosting, nets
from flowlab.operators.boosting import BoostedTrees, fit_rounds
from flowlab.operators.models import (
    ACTIVATIONS, HIDDEN_LAYERS, SEARCH_RANGES, BoostedParams, best_trial, boosted_pipeline, class_total,
    cross_val_accuracy, draw_params, score, train_boosted, train_mlp, tune_boosted,
)
from flowlab.plans.queries import reduced_split


@pytest.fixture(scope="module")
def points(spark):
    """Three well separated clusters with fold numbers."""
    rng = np.random.default_rng(4)
    y = np.arange(180) % 3
    x = rng.normal(size=(180, 2)) * 0.3 + np.array([[0, 0], [4, 0], [0, 4]])[y]
    frame = pd.DataFrame({"id": range(180), "a": x[:, 0], "b": x[:, 1], "y": y, "fold": (np.arange(180) // 3) % 3})
    return spark.createDataFrame(frame).persist()


def hits(df):
    rows = df.collect()
    return sum(r.prediction == r.y for r in rows) / len(rows)


def test_boosted_separates_three_classes_and_survives_saving(spark, points, tmp_path):
    model = train_boosted(points, ["a", "b"], "y", BoostedParams(trees=2, depth=2, min_child=1))
    assert hits(score(model, points)) > 0.95
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    unlabelled = score(loaded, points.drop("y"))
    assert unlabelled.columns == ["id", "a", "b", "fold", "prediction"] and dict(unlabelled.dtypes)["prediction"] == "int"
    assert sorted(unlabelled.collect()) == sorted(score(model, points.drop("y")).collect())


def plain_boosting(x, y, classes, edges, params):
    """Boosted trees row by row: what the distributed histograms have to add up to."""
    unit = boosting.UNIT
    margins, rounds = np.zeros((len(y), classes)), []

    def bin_of(i, f):
        return sum(e < x[i, f] for e in edges[f]) + 1

    bins = np.array([[bin_of(i, f) for f in range(x.shape[1])] for i in range(len(y))])
    for _ in range(params.trees):
        e = np.exp(margins - margins.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        h = np.rint(np.maximum(2 * p * (1 - p), 1e-6) * unit)
        g = np.rint((p - np.eye(classes)[y]) * unit)
        splits = []
        for k in range(classes):
            def grow(rows, level, node):
                gs, hs = g[rows, k].sum() / unit, h[rows, k].sum() / unit
                best = (1e-9, None)
                if level < params.depth:
                    for f in range(x.shape[1]):
                        for cut in range(len(edges[f]) + 2):
                            left = [i for i in rows if bins[i, f] <= cut]
                            right = [i for i in rows if bins[i, f] > cut]
                            if not left or not right:
                                continue
                            lg, lh, rg, rh = (v[side, k].sum() / unit for side in (left, right) for v in (g, h))
                            if lh < params.min_child or rh < params.min_child:
                                continue
                            gain = lg * lg / (lh + 1) + rg * rg / (rh + 1) - gs * gs / (hs + 1)
                            if gain > best[0]:
                                best = (gain, (f, cut, left, right))
                if best[1] is None:
                    margins[rows, k] += -params.learning_rate * gs / (hs + 1)
                    return
                f, cut, left, right = best[1]
                splits.append((k, node, f, cut))
                grow(left, level + 1, 2 * node)
                grow(right, level + 1, 2 * node + 1)

            grow(list(range(len(y))), 0, 1)
        rounds.append(sorted(splits))
    return margins, rounds


def test_histogram_trees_equal_plain_ones(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(150, 3)).round(2)
    x[:60] = x[0]  # copies and ties
    y = ((x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5)) % 3
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y}))
    params = BoostedParams(trees=4, depth=3, min_child=1.5, subsample=1.0, colsample=1.0)
    monkeypatch.setattr(blocks, "TASK_ROWS", 40)
    models = [BoostedTrees(["a", "b", "c"], "y", 3, params, bins=12).fit(df.repartition(n)) for n in (1, 4)]
    assert all(np.array_equal(a, b) for a, b in zip(models[0].edges, models[1].edges))
    assert np.array_equal(models[0].trees.feature, models[1].trees.feature)
    assert np.array_equal(models[0].trees.value, models[1].trees.value)
    trees = models[0].trees
    margins, rounds = plain_boosting(x, y, 3, models[0].edges, params)
    for turn, wanted in enumerate(rounds):
        k, node = np.nonzero(trees.feature[turn] >= 0)
        got = sorted(zip(k.tolist(), node.tolist(), trees.feature[turn][k, node].tolist(), trees.cut[turn][k, node].tolist()))
        assert got == wanted
    assert np.allclose(models[0].margins(x), margins, atol=1e-9)


@pytest.mark.parametrize("tasks", [1, 4])
def test_trees_grown_in_one_task_equal_those_of_levels(points, monkeypatch, tasks):
    params = BoostedParams(trees=4, depth=4, min_child=0.4, subsample=0.8, colsample=0.5)
    data = boosting.BoostedData.of(points.repartition(4), ["a", "b"], "y", 12)
    jobs, whole, grown = [], [], boosting.grown

    def counted(states, *args):
        tracker = states.context.statusTracker()
        states.context.setJobGroup("grown", "grown")
        before = len(tracker.getJobIdsForGroup("grown"))
        trees = grown(states, *args)
        jobs.append(len(tracker.getJobIdsForGroup("grown")) - before)
        return trees

    monkeypatch.setattr(boosting, "grown", counted)
    for rows in (0, 30, 1 << 17):
        monkeypatch.setattr(boosting, "LOCAL_ROWS", rows)
        whole.append(fit_rounds(data.blocks.repartition(tasks), data.edges, 3, params, 4))
    for other in whole[1:]:
        for name in ("feature", "cut", "value"):
            assert all(np.array_equal(getattr(a, name), getattr(b, name)) for a, b in zip(whole[0], other))
    assert (np.array([t.feature for t in whole[0]]) >= 0).sum() > 20
    # Levels, levels and subtrees, subtrees alone: one job a round.
    assert min(jobs[:4]) > 2 and jobs[8:] == [1] * 4


def test_nodes_are_dealt_evenly():
    sizes = [5, 1, 4, 2, 2, 1]
    assert sorted(np.bincount(boosting.dealt(sizes, 3), sizes)) == [5, 5, 5]
    place = boosting.dealt([100] + [1] * 50, 4)
    assert place.count(place[0]) == 1


def test_missing_values_and_columns_of_one_value(spark):
    rows = [(None if i % 3 == 0 else float(i % 3), 5.0, None, i % 3) for i in range(90)] + [(1.0, 5.0, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y int")
    model = train_boosted(df, ["a", "b", "c"], "y", BoostedParams(trees=3, depth=2, min_child=1))
    known = score(model, df.filter("y is not null"))
    assert hits(known) == 1.0
    assert score(model, df.filter("a > 9")).count() == 0


def test_going_on_equals_one_go(points):
    params = BoostedParams(trees=5, depth=3, min_child=1, subsample=0.7, colsample=0.5)
    data = boosting.BoostedData.of(points, ["a", "b"], "y")
    whole = fit_rounds(data.blocks, data.edges, 3, params, 4)
    first = fit_rounds(data.blocks, data.edges, 3, BoostedParams(params.learning_rate, 2, 3, 1, 0.7, 0.5), 4)
    again = fit_rounds(data.blocks, data.edges, 3, params, 4, first)
    assert len(whole) == len(again) == 5
    assert all(np.array_equal(a.feature, b.feature) and np.array_equal(a.value, b.value) for a, b in zip(whole, again))


def test_defaults_are_the_tuned_settings():
    assert BoostedParams().trees == 211 and BoostedParams().depth == 8 and BoostedParams().min_child == 7
    assert boosted_pipeline(["a"], "y", 3).getStages()[0].settings == BoostedParams()


def test_net_sizes_come_from_the_data(spark, points, tmp_path):
    model = train_mlp(points, ["a", "b"], "y", [5], max_iter=60)
    assert hits(score(model, points)) > 0.95
    assert model.stages[0].layers == [2, 5, 3]
    assert {k: len(v) for k, v in HIDDEN_LAYERS.items()} == {"NN_01": 7, "NN_02": 3, "NN_03": 6, "NN_04": 8}
    assert model.stages[0].losses[-1] < model.stages[0].losses[0]
    model.write().overwrite().save(str(tmp_path / "net"))
    loaded = PipelineModel.load(str(tmp_path / "net"))
    assert sorted(score(loaded, points).collect()) == sorted(score(model, points).collect())
    with pytest.raises(Exception, match="missing or not finite"):
        score(model, points.withColumn("a", F.lit(None).cast("double"))).collect()


@pytest.mark.parametrize("shape", ["NN_01", "NN_02", "NN_03", "NN_04"])
def test_every_shape_learns(points, shape):
    model = train_mlp(points, ["a", "b"], "y", shape, max_iter=30)
    assert model.stages[0].kind == ACTIVATIONS[shape] and hits(score(model, points)) > 0.95


@pytest.mark.parametrize("kind", ["relu", "leaky", "elu"])
def test_gradients_equal_finite_differences(kind):
    rng = np.random.default_rng(3)
    weights = [w + rng.normal(0, 0.1, w.shape) for w in nets.start([4, 6, 5, 3], 1)]
    x, y = rng.normal(size=(9, 4)), rng.integers(0, 3, 9)
    _, found = nets.loss_and_gradients(weights, kind, x, y)
    for part, gradient in zip(weights, found):
        for at in np.ndindex(part.shape):
            held, step = part[at], 1e-6
            part[at] = held + step
            up = nets.loss_and_gradients(weights, kind, x, y)[0]
            part[at] = held - step
            down = nets.loss_and_gradients(weights, kind, x, y)[0]
            part[at] = held
            assert gradient[at] == pytest.approx((up - down) / (2 * step), abs=1e-4)


def test_gradients_add_up_over_tasks(points, monkeypatch):
    one = train_mlp(points.repartition(1), ["a", "b"], "y", [4], max_iter=3).stages[0]
    monkeypatch.setattr(blocks, "TASK_ROWS", 30)
    many = train_mlp(points.repartition(6), ["a", "b"], "y", [4], max_iter=3).stages[0]
    assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(one.weights, many.weights))


def test_rows_of_one_file_are_dealt_to_all_cores(points, monkeypatch):
    monkeypatch.setattr(blocks, "TASK_ROWS", 10)
    found, total = blocks.training_blocks(points.coalesce(1), ["a", "b"], "y", 5)
    rows = found.map(lambda b: len(b[1])).glom().map(sum).collect()
    assert total == sum(rows) == 180 and len(rows) == found.context.defaultParallelism and max(rows) < 60
    monkeypatch.setattr(blocks, "SHARED_TASK_ROWS", 10)
    shared, _ = blocks.training_blocks(points.coalesce(1), ["a", "b"], "y", 5, side_by_side=4)
    assert shared.getNumPartitions() == found.context.defaultParallelism // 4


def test_driver_gets_one_sum_of_any_number_of_tasks(spark):
    weights = [np.arange(7.0).reshape(7, 1), np.ones(3)]
    tasks = spark.sparkContext.parallelize(range(9), 9).map(lambda i: (float(i), [i * w for w in weights]))
    parts = sorted(nets.added_slices(tasks).collect(), key=lambda p: p[0])
    assert [i for i, _ in parts] == list(range(9)) and sum(len(v) for _, v in parts) == 11
    assert np.concatenate([v for _, v in parts]).tolist() == [36.0, *(36 * np.arange(7.0)), 36.0, 36.0, 36.0]


@pytest.mark.parametrize("kind", ["relu", "leaky", "elu"])
def test_products_stay_in_single_precision(kind):
    weights = [w.astype(np.float32) for w in nets.start([4, 6, 5, 3], 1)]
    x = np.random.default_rng(3).normal(size=(9, 4)).astype(np.float32)
    _, found = nets.loss_and_gradients(weights, kind, x, np.arange(9) % 3)
    assert {g.dtype for g in found} == {np.dtype(np.float32)}


def test_draws_stay_in_range_and_repeat():
    draws = [draw_params(random.Random(i)) for i in range(50)]
    for p in draws:
        for name, (lo, hi) in SEARCH_RANGES.items():
            assert lo <= getattr(p, name) <= hi
    assert draw_params(random.Random(1)) == draws[1] and isinstance(draws[0].depth, int)


def test_cross_validation_fits_afresh(points):
    pipeline = boosted_pipeline(["a", "b"], "y", 2, BoostedParams(trees=1, depth=2, min_child=1))
    two = points.filter("y < 2")
    assert cross_val_accuracy(pipeline, two, "y", "fold", 3) == pytest.approx([1.0] * 3)


def test_search_halves(points):
    ranges = {**SEARCH_RANGES, "trees": (4, 9), "depth": (1, 2)}
    trials = tune_boosted(points, ["a", "b"], "y", "fold", trials=4, rungs=2, cut=2, ranges={**ranges, "min_child": (1, 2)}).persist()
    rows = trials.collect()
    assert {(r.trial, r.rung) for r in rows if r.rung == 0} == {(t, 0) for t in range(4)}
    last = {r.trial for r in rows if r.rung == 1}
    assert len(last) == 2 and len(rows) == 3 * (4 + 2)
    assert all(r.rounds == (r.trees if r.rung else -(-r.trees // 2)) for r in rows)
    assert {r.trees for r in rows if r.trial == 0} == {211}
    mean = {t: np.mean([r.accuracy for r in rows if r.trial == t and r.rung == 1]) for t in last}
    assert best_trial(trials).trees in {r.trees for r in rows if r.trial in last and mean[r.trial] == max(mean.values())}


def test_no_labels_no_training(points):
    with pytest.raises(ValueError):
        class_total(points.filter("id < 0"), "y")


@pytest.mark.parametrize("width", [10, 70])
def test_vectors_of_any_width_are_reduced_whole(spark, tmp_path, width):
    """Only the last component tells the classes apart."""
    source = random.Random(width)
    rows = [
        (i, i % 8, [source.random() for _ in range(width - 1)] + [100.0 * (i % 8) + source.random()]) for i in range(400)
    ]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    train, test = reduced_split(spark, str(tmp_path))
    spread = train.groupBy("label").agg(F.avg("c0").alias("m"), F.stddev("c0").alias("s")).orderBy("m").collect()
    assert all(b.m - a.m > 4 * (a.s + b.s) for a, b in zip(spread, spread[1:])) and test.count() > 0
