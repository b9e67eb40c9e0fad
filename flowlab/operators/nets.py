"""Feed-forward nets trained by back-propagation over all rows.

Loss and gradient of the whole table are one job: each task sums those of its rows and cuts the sums into slices, which
are added up slice by slice in as many tasks. The driver, which holds the weights and a short history of them, receives
one sum whatever the number of tasks, and takes L-BFGS steps. What travels depends on the size of the net, never on the
rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.operators.blocks import ArrayModelReader, ArrayModelWriter, Block, scored_columns, training_blocks
from flowlab.operators.boosting import softmax
from flowlab.storage import scratch_root

# Hidden layer sizes of the four feed-forward shapes.
HIDDEN_LAYERS: dict[str, list[int]] = {
    "NN_01": [32, 64, 128, 256, 256, 128, 64],
    "NN_02": [32, 64, 32],
    "NN_03": [32, 64, 128, 256, 128, 64],
    "NN_04": [32, 64, 128, 256, 512, 256, 128, 64],
}

# The activations of the four shapes, and the slope of the leaky rectifier.
ACTIVATIONS: dict[str, str] = {"NN_01": "leaky", "NN_02": "elu", "NN_03": "relu", "NN_04": "elu"}
LEAK = 0.01

#: Pairs of steps and gradient changes that the optimiser remembers, and halvings of a step before it gives up.
HISTORY, HALVINGS = 10, 12
#: Rows whose activations are held at a time.
CHUNK_ROWS = 2048
Weights = list[np.ndarray]


def activated(kind: str, z: np.ndarray) -> np.ndarray:
    if kind == "elu":
        low = np.minimum(z, 0)
        np.exp(low, out=low)  # a few times as fast as expm1, and as good to the last bit of 1
        low -= 1
        return np.maximum(z, 0) + low
    return np.maximum(z, 0) if kind == "relu" else np.maximum(z, LEAK * z)


def slope(kind: str, z: np.ndarray) -> np.ndarray:
    if kind == "elu":
        low = np.minimum(z, 0)
        return np.exp(low, out=low)
    return np.where(z > 0, 1, LEAK if kind == "leaky" else 0).astype(z.dtype)


def start(layers: Sequence[int], seed: int) -> Weights:
    """Weights and biases in turn; weights are normal with the variance that suits rectifiers."""
    draw = np.random.default_rng(seed)
    pairs = zip(layers, layers[1:])
    return [part for a, b in pairs for part in (draw.normal(0, np.sqrt(2.0 / a), (a, b)), np.zeros(b))]


def forward(weights: Weights, kind: str, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Inputs of all layers and their sums; the last sum holds the scores of the classes."""
    inputs, sums = [x], []
    for w, b in zip(weights[::2], weights[1::2]):
        sums.append(inputs[-1] @ w + b)
        inputs.append(activated(kind, sums[-1]))
    return inputs[:-1], sums


def loss_and_gradients(weights: Weights, kind: str, x: np.ndarray, y: np.ndarray) -> tuple[float, Weights]:
    """Log loss and its gradients, both summed over the rows."""
    inputs, sums = forward(weights, kind, x)
    p = softmax(sums[-1])
    rows = np.arange(len(y))
    loss = -float(np.log(np.maximum(p[rows, y], 1e-30)).sum())
    delta = p
    delta[rows, y] -= 1
    found: Weights = []
    for i in range(len(sums) - 1, -1, -1):
        found += [delta.sum(axis=0), inputs[i].T @ delta]
        if i:
            delta = (delta @ weights[2 * i].T) * slope(kind, sums[i - 1])
    return loss, found[::-1]


def _task_sums(blocks: Iterator[Block], weights: Weights, kind: str, centre: np.ndarray, scale: np.ndarray) -> Iterator[tuple[float, Weights]]:
    """The sums over all rows of a task; products in single precision, sums in double."""
    loss, total = 0.0, [np.zeros(w.shape) for w in weights]
    small = [w.astype(np.float32) for w in weights]
    for x, y, _ in blocks:
        for at in range(0, len(y), CHUNK_ROWS):
            part = ((x[at:at + CHUNK_ROWS] - centre) / scale).astype(np.float32)
            more, found = loss_and_gradients(small, kind, part, y[at:at + CHUNK_ROWS])
            loss += more
            for t, g in zip(total, found):
                t += g
    yield loss, total


def added_slices(sums: RDD) -> RDD:
    """``slice, sum`` of the ``loss, gradients`` that every task holds: all tasks' sums as one vector, loss first, cut into
    as many slices as there are tasks. A slice is added up in the order of the tasks, so that its sum is repeatable."""
    tasks = sums.getNumPartitions()

    def cut(task: int, part: Iterator[tuple[float, Weights]]) -> Iterator[tuple[int, tuple[int, np.ndarray]]]:
        for loss, found in part:
            flat = np.concatenate([[loss], *[g.ravel() for g in found]])
            for i, values in enumerate(np.array_split(flat, tasks)):
                yield i, (task, values)

    def added(part: Iterator[tuple[int, tuple[int, np.ndarray]]]) -> Iterator[tuple[int, np.ndarray]]:
        held: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, piece in part:
            held.setdefault(i, []).append(piece)
        for i, pieces in held.items():
            total = np.zeros(len(pieces[0][1]))
            for _, values in sorted(pieces, key=lambda p: p[0]):
                total += values
            yield i, total

    cuts = sums.mapPartitionsWithIndex(cut)
    return (cuts.partitionBy(tasks, int) if tasks > 1 else cuts).mapPartitions(added)


def _require_known(x: np.ndarray) -> np.ndarray:
    if not np.isfinite(x).all():
        raise ValueError("a feature is missing or not finite")
    return x


class NetModel(Model, MLReadable, MLWritable):
    """Adds ``probability`` (by class) and ``prediction`` to a table that has the ``features``; a missing or infinite
    feature is an error."""

    def __init__(
        self, features: Sequence[str] = (), kind: str = "elu", weights: Weights | None = None,
        centre: np.ndarray | None = None, scale: np.ndarray | None = None, losses: Sequence[float] = (),
    ):
        super().__init__()
        self.features, self.kind, self.weights = list(features), kind, weights
        self.centre, self.scale, self.losses = centre, scale, list(losses)

    @property
    def layers(self) -> list[int]:
        return [len(self.weights[0]), *(len(b) for b in self.weights[1::2])]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held = dataset.sparkSession.sparkContext.broadcast((self.kind, self.weights, self.centre, self.scale))

        def scores(x: np.ndarray) -> np.ndarray:
            kind, weights, centre, scale = held.value
            parts = [
                softmax(forward(weights, kind, (_require_known(x[at:at + CHUNK_ROWS]) - centre) / scale)[1][-1])
                for at in range(0, len(x), CHUNK_ROWS)
            ]
            return np.concatenate(parts) if parts else np.empty((0, len(weights[-1])))

        return scored_columns(dataset, self.features, scores)

    def state(self) -> tuple[dict, dict[str, np.ndarray]]:
        arrays = {f"w{i}": np.ascontiguousarray(w) for i, w in enumerate(self.weights)}
        settings = {"features": self.features, "kind": self.kind, "parts": len(self.weights), "losses": self.losses}
        return settings, arrays | {"centre": self.centre, "scale": self.scale}

    @classmethod
    def from_state(cls, settings: dict, arrays: dict[str, np.ndarray]) -> NetModel:
        weights = [arrays[f"w{i}"] for i in range(settings["parts"])]
        return cls(settings["features"], settings["kind"], weights, arrays["centre"], arrays["scale"], settings["losses"])

    def write(self) -> ArrayModelWriter:
        return ArrayModelWriter(self)

    @classmethod
    def read(cls) -> ArrayModelReader:
        return ArrayModelReader(cls)


class FeedForwardNet(Estimator):
    """A net for classes 0, 1, ... of an integer label; ``hidden`` are the sizes of its hidden layers, ``kind`` is their
    activation (``relu``, ``leaky`` or ``elu``). Features are centred and scaled by their deviation; rows without a label
    are left out."""

    def __init__(
        self, features: Sequence[str], label: str, classes: int, hidden: Sequence[int], kind: str = "elu",
        steps: int = 100, seed: int = 2,
    ):
        super().__init__()
        self.features, self.label, self.layers, self.kind = list(features), label, [len(features), *hidden, classes], kind
        self.steps, self.seed = steps, seed

    def _fit(self, dataset: DataFrame) -> NetModel:
        scratch_root(dataset.sparkSession)
        labelled = dataset.filter(quoted(self.label).isNotNull())
        blocks, total = training_blocks(labelled, self.features, self.label, CHUNK_ROWS)
        if not total:
            raise ValueError("no labelled rows to train on")
        named = [quoted(c).cast("double") for c in self.features]
        row = labelled.agg(*[f(c).alias(f"{i}{n}") for i, c in enumerate(named) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        centre = _require_known(np.array([np.nan if row[f"{i}m"] is None else row[f"{i}m"] for i in range(len(named))]))
        spread = np.array([row[f"{i}s"] for i in range(len(named))], float)
        scale = np.where(spread > 0, spread, 1.0)
        known = lambda b: (_require_known(b[0]), b[1], b[2])
        blocks = blocks.map(known).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            weights, losses = self._descend(blocks, total, centre, scale)
        finally:
            blocks.unpersist()
        return NetModel(self.features, self.kind, weights, centre, scale, losses)

    def _descend(self, blocks, total: int, centre: np.ndarray, scale: np.ndarray) -> tuple[Weights, list[float]]:
        context, kind = blocks.context, self.kind
        weights = start(self.layers, self.seed)
        ends = np.cumsum([w.size for w in weights])[:-1]

        def shaped(flat: np.ndarray) -> Weights:
            return [part.reshape(w.shape) for part, w in zip(np.split(flat, ends), weights)]

        def measured(flat: np.ndarray) -> tuple[float, np.ndarray]:
            held = context.broadcast(shaped(flat))
            sums = blocks.mapPartitions(lambda part: _task_sums(part, held.value, kind, centre, scale))
            flat = np.concatenate([values for _, values in sorted(added_slices(sums).collect(), key=lambda p: p[0])])
            held.unpersist()
            return float(flat[0]) / total, flat[1:] / total

        at, losses = descended(measured, np.concatenate([w.ravel() for w in weights]), self.steps)
        return shaped(at), losses


def descended(measured: Callable[[np.ndarray], tuple[float, np.ndarray]], at: np.ndarray, steps: int) -> tuple[np.ndarray, list[float]]:
    """L-BFGS from ``at``: the place after so many steps, or where no step goes down any more, and the losses on the way."""
    loss, gradient = measured(at)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    losses = [loss]
    for _ in range(steps):
        direction, weights = gradient.copy(), []
        for move, change in reversed(moves):
            weight = (move @ direction) / (move @ change)
            direction -= weight * change
            weights.append(weight)
        if moves:
            move, change = moves[-1]
            direction *= (move @ change) / (change @ change)
        for (move, change), weight in zip(moves, reversed(weights)):
            direction += (weight - (change @ direction) / (move @ change)) * move
        downhill = -(gradient @ direction)
        if not downhill < 0:
            break
        length = 1.0 if moves else min(1.0, 1.0 / np.linalg.norm(gradient))
        for _ in range(HALVINGS):
            there = at - length * direction
            new_loss, new_gradient = measured(there)
            if new_loss <= loss + 1e-4 * length * downhill:
                break
            length /= 2
        else:
            break
        move, change = there - at, new_gradient - gradient
        if move @ change > 1e-12 * (change @ change):
            moves = [*moves, (move, change)][-HISTORY:]
        at, loss, gradient = there, new_loss, new_gradient
        losses.append(loss)
    return at, losses
