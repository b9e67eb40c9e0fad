"""Classifiers trained on Spark: boosted trees, feed-forward nets, search by successive halving, batch scoring.

Quality, not bit equality, is what these promise against other trainers.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, replace
from multiprocessing.pool import ThreadPool

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.operators.boosting import BoostedData, BoostedParams, BoostedTrees, Trees, fit_rounds
from flowlab.operators.nets import ACTIVATIONS, HIDDEN_LAYERS, FeedForwardNet
from flowlab.storage import scratch_path

# Ranges of the random search, ends included.
SEARCH_RANGES: dict[str, tuple[float, float]] = {
    "learning_rate": (0.01, 0.3),
    "depth": (3, 9),
    "min_child": (1, 7),
    "subsample": (0.6, 1.0),
    "colsample": (0.6, 1.0),
    "trees": (50, 400),
}


def class_total(df: DataFrame, label: str) -> int:
    """Number of classes of a 0-based integer label."""
    top = df.agg(F.max(quoted(label))).first()[0]
    if top is None:
        raise ValueError("no labelled rows to train on")
    return int(top) + 1


def boosted_pipeline(
    features: Sequence[str], label: str, classes: int, params: BoostedParams = BoostedParams(), seed: int = 2
) -> Pipeline:
    """Unfitted boosted trees, one ensemble for all classes."""
    return Pipeline(stages=[BoostedTrees(features, label, classes, params, seed)])


def train_boosted(
    df: DataFrame, features: Sequence[str], label: str, params: BoostedParams = BoostedParams(), seed: int = 2
) -> PipelineModel:
    return boosted_pipeline(features, label, class_total(df, label), params, seed).fit(df)


def train_mlp(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    hidden: str | Sequence[int] = "NN_02",
    max_iter: int = 100,
    seed: int = 2,
    activation: str | None = None,
) -> PipelineModel:
    """Feed-forward net; ``hidden`` is a shape name or layer sizes, the ends come from the data. A named shape has its
    own activation, others are exponential rectifiers unless ``activation`` says otherwise."""
    inner = HIDDEN_LAYERS[hidden] if isinstance(hidden, str) else list(hidden)
    kind = activation or (ACTIVATIONS[hidden] if isinstance(hidden, str) else "elu")
    net = FeedForwardNet(features, label, class_total(df, label), inner, kind, max_iter, seed=seed)
    return Pipeline(stages=[net]).fit(df)


def score(model: Model, df: DataFrame) -> DataFrame:
    """``df`` with an integer ``prediction`` column; labels are not needed."""
    helper = [c for c in ("rawPrediction", "probability") if c not in df.columns]
    return (
        model.transform(df).drop(*helper)
        .withColumn("prediction", F.col("prediction").cast("int"))
    )


def cross_val_accuracy(
    pipeline: Pipeline, df: DataFrame, label: str, fold: str, k: int, parallelism: int = 3,
    prepare: Callable[[DataFrame], Callable[[DataFrame], DataFrame]] | None = None,
) -> list[float]:
    """Accuracy on each fold of a model fitted afresh on the other folds.

    ``prepare`` learns from the training rows of a fold how to turn rows into features, so that
    scalers and reducers do not see the rows they are judged on.
    """
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")

    def one(i: int) -> float:
        train, test = df.filter(quoted(fold) != i), df.filter(quoted(fold) == i)
        if prepare is not None:
            change = prepare(train)
            train, test = change(train), change(test)
        return judge.evaluate(pipeline.fit(train).transform(test))

    with ThreadPool(min(k, parallelism)) as pool:
        return pool.map(one, range(k))


def draw_params(
    source: random.Random, ranges: Mapping[str, tuple[float, float]] = SEARCH_RANGES
) -> BoostedParams:
    """One random point; whole-number ranges give whole numbers."""
    picked = {
        name: source.randint(int(lo), int(hi)) if isinstance(lo, int) and isinstance(hi, int)
        else source.uniform(lo, hi)
        for name, (lo, hi) in ranges.items()
    }
    return replace(BoostedParams(), **picked)


def tune_boosted(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    fold: str,
    k: int = 3,
    trials: int = 9,
    cut: int = 3,
    rungs: int = 3,
    ranges: Mapping[str, tuple[float, float]] = SEARCH_RANGES,
    seed: int = 2,
    prepare: Callable[[DataFrame], Callable[[DataFrame], DataFrame]] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """``(trial, rung, rounds, fold, accuracy, <params>)``: search by successive halving, scored by k-fold accuracy.

    Trial 0 has the default settings, the others are drawn from ``ranges``. In each rung the trials that are left grow
    to a larger share of their trees, going on from the trees they have; only one in ``cut`` goes on to the next rung,
    and the last rung grows all trees. Trials and folds run side by side. ``fold`` holds 0..k-1, see ``stratified_kfold``;
    ``prepare`` (see ``cross_val_accuracy``) is learnt once for each fold.
    """
    spark = df.sparkSession
    classes = class_total(df, label)
    source = random.Random(seed)
    drawn = [BoostedParams(), *(draw_params(source, ranges) for _ in range(trials - 1))]
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")

    def sides(i: int) -> tuple[BoostedData, DataFrame]:
        train, test = df.filter(quoted(fold) != i), df.filter(quoted(fold) == i)
        if prepare is not None:
            change = prepare(train)
            train, test = change(train), change(test)
        path = scratch_path(spark, "fold")
        test.select(*[quoted(c) for c in [*features, label]]).write.parquet(path)
        return BoostedData.of(train, features, label, side_by_side=parallelism), spark.read.parquet(path)

    with ThreadPool(parallelism) as pool:
        folds = pool.map(sides, range(k))
        grown: dict[tuple[int, int], list[Trees]] = {}
        left, rows = list(range(len(drawn))), []
        for rung in range(rungs):
            share = cut ** (rungs - 1 - rung)

            def one(task: tuple[int, int]) -> float:
                trial, i = task
                data, test = folds[i]
                params = replace(drawn[trial], trees=-(-drawn[trial].trees // share))
                grown[task] = fit_rounds(data.blocks, data.edges, classes, params, seed, grown.get(task, ()))
                return 100.0 * judge.evaluate(data.model(grown[task]).transform(test))

            tasks = [(trial, i) for trial in left for i in range(k)]
            accuracy = dict(zip(tasks, pool.map(one, tasks, chunksize=1)))
            rows += [(t, rung, len(grown[t, i]), i, accuracy[t, i], *asdict(drawn[t]).values()) for t, i in tasks]
            best = sorted(left, key=lambda t: (-sum(accuracy[t, i] for i in range(k)), t))
            left = sorted(best[: -(-len(left) // cut)])
    schema = (
        "trial int, rung int, rounds int, fold int, accuracy double, learning_rate double, trees int, depth int, "
        "min_child double, subsample double, colsample double"
    )
    return spark.createDataFrame([(*r[:8], float(r[8]), *r[9:]) for r in rows], schema)


def best_trial(trials: DataFrame) -> BoostedParams:
    """Parameters of the trial with the highest mean accuracy among those of the last rung, the earliest on a tie."""
    names = list(BoostedParams.__dataclass_fields__)
    means = trials.groupBy("rung", "trial", *names).agg(F.avg("accuracy").alias("mean"))
    row = means.orderBy(F.desc("rung"), F.desc("mean"), "trial").first()
    return BoostedParams(**{n: row[n] for n in names})
