"""Multiclass gradient-boosted trees over distributed histograms.

All classes are one softmax ensemble: a round adds a tree for each class, and all trees of a round grow level by level
together. A task turns its rows into sums of gradients and hessians by node, feature and bin; Spark adds these up by
node, the tasks that hold a node's sum choose its split, and the driver sees one row a node. As soon as a node has no more
rows than one task can take, and they are fewer bytes than the sums of its subtree, the rows themselves go to one task by
node, which grows the rest of that tree: a round of a table of some size is one job, not one for each level. Gradients are
whole numbers of 2**-24, so sums are exact and a tree depends neither on the way nor on the order in which tasks end.

The scores of the rows so far stay with the rows and are handed on from round to round; every few rounds they are
written to the shared folder, so that a lost executor costs those rounds at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.util import MLReadable, MLWritable
from pyspark.sql import DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.operators.blocks import ArrayModelReader, ArrayModelWriter, Block, scored_columns, training_blocks
from flowlab.storage import scratch_root

#: Gradients and hessians are whole multiples of 2**-24: sums of 2**38 rows fit 64 bits.
UNIT = float(1 << 24)
#: Added to the hessian of a leaf.
RIDGE = 1.0
MAX_BINS = 64
CHECKPOINT_ROUNDS = 10
#: Rows of a node at most whose subtree one task grows, and the bytes of a row's gradient and hessian on their way there.
LOCAL_ROWS = 1 << 17
PAIR_BYTES = 8
#: A split that gains no more is none.
LEAST_GAIN = 1e-9


# The tuned boosted-tree settings are the defaults.
@dataclass(frozen=True)
class BoostedParams:
    learning_rate: float = 0.23962854155043442
    trees: int = 211
    depth: int = 8
    min_child: float = 7
    subsample: float = 0.6142975198934528
    colsample: float = 0.8348945145303123


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ends between bins, by feature: half way between neighbouring quantiles of all finite values, which come from one
    pass of mergeable summaries."""
    shares = [i / bins for i in range(bins + 1)]
    values = [quoted(c).cast("double") for c in features]
    known = [F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v) for v in values]
    row = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"q{i}") for i, c in enumerate(known)]).first()
    places = [np.unique(np.array(q if q is not None else [], float)) for q in row]
    return [p[:-1] / 2 + p[1:] / 2 for p in places]


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of each value; 0 holds missing ones, which go with the smallest values in every split."""
    out = np.zeros(x.shape, np.uint8)
    for i, ends in enumerate(edges):
        out[:, i] = np.where(np.isnan(x[:, i]), 0, np.searchsorted(ends, x[:, i], side="left") + 1)
    return out


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the log loss for each row and class, in whole units."""
    p = softmax(margins)
    h = np.maximum(2.0 * p * (1.0 - p), 1e-6)
    p[np.arange(len(y)), y] -= 1.0
    return np.rint(p * UNIT), np.rint(h * UNIT)


@dataclass
class Trees:
    """A tree for each class as arrays over nodes; the children of node i are 2i and 2i + 1, the root is 1.
    ``feature`` is -1 at a leaf; rows whose bin is at most ``cut`` go to the left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def bare(cls, classes: int, depth: int) -> Trees:
        shape = (classes, 2 << depth)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.uint8), np.zeros(shape))

    def nodes(self, k: int, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node that each row has reached after so many levels."""
        inner = self.feature[k] >= 0
        # A leaf goes on to itself: no bin is beyond its cut.
        column, cut = np.where(inner, self.feature[k], 0).astype(np.int64), np.where(inner, self.cut[k], 255)
        left = np.arange(len(inner)) << inner
        at, first, flat = np.ones(len(bins), np.int64), np.arange(len(bins)) * bins.shape[1], bins.ravel()
        for _ in range(min(levels, int(np.flatnonzero(inner).max(initial=0)).bit_length())):
            at = left.take(at) + (flat.take(first + column.take(at)) > cut.take(at))
        return at

    def scores(self, bins: np.ndarray) -> np.ndarray:
        depth = self.feature.shape[1].bit_length() - 2
        return np.stack([self.value[k, self.nodes(k, bins, depth)] for k in range(len(self.feature))], axis=1)


#: A block under way: its bins, classes, scores so far and checksum.
State = tuple[np.ndarray, np.ndarray, np.ndarray, int]


def sampled(state: State, turn: int, share: float, seed: int) -> np.ndarray:
    """Which rows of a block this round's trees see."""
    return np.random.default_rng((seed, turn, state[3])).random(len(state[1])) < share


Node = tuple[int, int]
Split = tuple[Node, float, int, int, list[int], int]
#: What a task knows of a node: sums of gradient and hessian by feature and bin, and the number of rows.
Sums = tuple[np.ndarray, int]


def histograms(
    states: Iterator[State], trees: Trees, level: int, open_nodes: list[list[int]], columns: list[np.ndarray], bins: int, turn: int, share: float, seed: int
) -> Iterator[tuple[Node, Sums]]:
    """For each open node (class, node) the sums of gradient and hessian by feature and bin, over all rows of a task."""
    counts = {k: np.zeros(len(nodes), np.int64) for k, nodes in enumerate(open_nodes) if nodes}
    sums = {k: np.zeros((len(nodes), len(columns[k]), bins, 2), np.int64) for k, nodes in enumerate(open_nodes) if nodes}
    for s in states:
        keep = sampled(s, turn, share, seed)
        rows = s[0][keep]
        if not len(rows):
            continue
        g, h = gradients(s[2][keep], s[1][keep])
        for k, total in sums.items():
            nodes = open_nodes[k]
            place, here = placed(nodes, trees.nodes(k, rows, level))
            picked = rows[here]
            counts[k] += np.bincount(place, minlength=len(nodes))
            for i, f in enumerate(columns[k]):
                cell = place * bins + picked[:, f]
                for j, part in enumerate((g, h)):
                    # Whole numbers below 2**53: the sums in double precision are exact.
                    total[:, i, :, j] += np.bincount(cell, part[here, k], len(nodes) * bins).astype(np.int64).reshape(-1, bins)
    for k, total in sums.items():
        for node, cells, count in zip(open_nodes[k], total, counts[k].tolist()):
            yield (k, node), (cells, count)


def placed(nodes: list[int], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are at one of the ``nodes``, given in order, and at which."""
    names = np.array(nodes)
    place = np.searchsorted(names, at)
    place[place == len(names)] = 0
    here = names[place] == at
    return place[here], here


def best_splits(parts: Iterator[tuple[Node, Sums]], columns: list[np.ndarray], min_child: float) -> Iterator[Split]:
    """``node, gain, feature, cut, [gradient and hessian of the left and of all rows], rows`` of the best split of each
    node, the lowest feature and cut on a tie; a gain of 0 means none."""
    nodes, cells, counts = [], [], []
    for node, (part, count) in parts:
        nodes.append(node)
        cells.append(part)
        counts.append(count)
    if not nodes:
        return
    left = np.array(cells).cumsum(axis=2)
    whole = left[:, 0, -1]
    right = whole[:, None, None, :] - left
    gl, hl, gr, hr = (v / UNIT for v in (left[..., 0], left[..., 1], right[..., 0], right[..., 1]))
    g, h = whole[:, 0] / UNIT, whole[:, 1] / UNIT
    fits = (hl >= min_child) & (hr >= min_child) & (left[..., 1] > 0) & (right[..., 1] > 0)
    gain = np.where(fits, gl * gl / (hl + RIDGE) + gr * gr / (hr + RIDGE) - (g * g / (h + RIDGE))[:, None, None], 0.0)
    best = gain.reshape(len(nodes), -1).argmax(axis=1)
    for i, node in enumerate(nodes):
        f, cut = divmod(int(best[i]), gain.shape[2])
        sums = [int(v) for v in (*left[i, f, cut], *whole[i])]
        yield node, float(max(gain[i, f, cut], 0.0)), int(columns[node[0]][f]), cut, sums, counts[i]


def open_children(split: Split, min_child: float, depth: int) -> list[int]:
    """The children of a node that are split in turn: both of their sides can hold the least hessian."""
    (_, node), gain, _, _, (_, lh, _, h), _ = split
    if gain <= LEAST_GAIN or node.bit_length() >= depth:
        return []
    return [child for child, ch in ((2 * node, lh), (2 * node + 1, h - lh)) if ch / UNIT >= 2 * min_child]


#: Rows on their way to the task of a node: its number in a list, bins, gradients, hessians.
Rows = tuple[int, tuple[np.ndarray, np.ndarray, np.ndarray]]


def sent_rows(states: Iterator[State], trees: Trees, nodes: list[Node], turn: int, share: float, seed: int) -> Iterator[Rows]:
    """The rows that this round's trees see, by the number of the node in ``nodes``."""
    depth = trees.feature.shape[1].bit_length() - 2
    by_class: dict[int, list[tuple[int, int]]] = {}
    for i, (k, node) in enumerate(nodes):
        by_class.setdefault(k, []).append((node, i))
    for s in states:
        keep = sampled(s, turn, share, seed)
        rows = s[0][keep]
        if not len(rows):
            continue
        g, h = gradients(s[2][keep], s[1][keep])
        for k, named in by_class.items():
            named.sort()
            place, here = placed([node for node, _ in named], trees.nodes(k, rows, depth))
            order = np.argsort(place, kind="stable")
            # No gradient or hessian is more than 2**24 units.
            parts = [v[here][order] for v in (rows, g[:, k].astype(np.int32), h[:, k].astype(np.int32))]
            ends = np.cumsum(np.bincount(place, minlength=len(named)))
            for (_, i), start, stop in zip(named, [0, *ends[:-1].tolist()], ends.tolist()):
                if stop > start:
                    yield i, tuple(p[start:stop] for p in parts)


def subtree(node: Node, rows: Sequence[tuple[np.ndarray, ...]], columns: list[np.ndarray], bins: int, depth: int, min_child: float) -> Iterator[Split]:
    """The splits of a node and of all that lie below it, level by level, from the node's rows."""
    k, first = node
    picked = np.ascontiguousarray(np.concatenate([r[0] for r in rows]).T)
    g, h = (np.concatenate([r[i] for r in rows]).astype(float) for i in (1, 2))
    nodes, place = [first], np.zeros(len(g), np.int64)
    while nodes:
        total = np.empty((len(nodes), len(columns[k]), bins, 2), np.int64)
        for i, f in enumerate(columns[k]):
            cell = place * bins + picked[f]
            for j, part in enumerate((g, h)):
                total[:, i, :, j] = np.bincount(cell, part, len(nodes) * bins).reshape(-1, bins)
        counts = np.bincount(place, minlength=len(nodes)).tolist()
        found = list(best_splits((((k, n), (cells, c)) for n, cells, c in zip(nodes, total, counts)), columns, min_child))
        yield from found
        feature, cut = (np.array([split[i] for split in found]) for i in (2, 3))
        below = [open_children(split, min_child, depth) for split in found]
        place_of = {child: i for i, child in enumerate(sorted(c for children in below for c in children))}
        after = np.array([[place_of.get(2 * n + side, -1) for side in (0, 1)] for n in nodes])
        right = picked[feature[place], np.arange(len(place))] > cut[place]
        place = after[place, right.astype(np.int64)]
        nodes = list(place_of)
        if nodes and (place < 0).any():
            stays = place >= 0
            picked, g, h, place = np.ascontiguousarray(picked[:, stays]), g[stays], h[stays], place[stays]


def subtrees(parts: Iterator[Rows], nodes: list[Node], columns: list[np.ndarray], bins: int, depth: int, min_child: float) -> Iterator[Split]:
    """The splits of all subtrees whose rows a task has been sent."""
    held: dict[int, list] = {}
    for i, rows in parts:
        held.setdefault(i, []).append(rows)
    for i in list(held):
        yield from subtree(nodes[i], held.pop(i), columns, bins, depth, min_child)


def dealt(sizes: list[int], tasks: int) -> list[int]:
    """A task for each node, so that all get about as many rows: the largest first, each to the task that has least."""
    load, out = [0] * tasks, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        out[i] = min(range(tasks), key=load.__getitem__)
        load[out[i]] += sizes[i]
    return out


def grown(states: RDD, rows: int, classes: int, width: int, bins: int, params: BoostedParams, turn: int, seed: int) -> Trees:
    """The trees of one round: one job for each level that has nodes too large for a task, and one for all others."""
    draw = np.random.default_rng((seed, turn))
    take = min(width, max(1, int(np.ceil(params.colsample * width))))
    columns = [np.sort(draw.choice(width, take, replace=False)) for _ in range(classes)]
    trees = Trees.bare(classes, params.depth)
    least, share, depth, tasks = params.min_child, params.subsample, params.depth, states.getNumPartitions()

    def leaf(k: int, node: int, g: int, h: int) -> None:
        trees.value[k, node] = -params.learning_rate * (g / UNIT) / (h / UNIT + RIDGE)

    def planted(split: Split) -> list[int]:
        (k, node), gain, feature, cut, (lg, lh, g, h), _ = split
        if node == 1:
            leaf(k, 1, g, h)
        if gain > LEAST_GAIN:
            trees.feature[k, node], trees.cut[k, node] = feature, cut
            leaf(k, 2 * node, lg, lh)
            leaf(k, 2 * node + 1, g - lg, h - lh)
        return open_children(split, least, depth)

    def fits(node: int, size: int) -> bool:
        """One task can take a node's rows, which are fewer bytes than the sums of all nodes that may lie below it."""
        sums = tasks * take * bins * 16 * ((1 << depth - node.bit_length() + 1) - 1)
        return size <= LOCAL_ROWS and (tasks == 1 or size * (width + PAIR_BYTES) <= sums)

    # An open node has as many rows at most as the one above it.
    sizes = {(k, 1): rows for k in range(classes)} if depth > 0 else {}
    small: dict[Node, int] = {}
    while sizes:
        small |= {n: size for n, size in sizes.items() if fits(n[1], size)}
        open_nodes = [sorted(node for c, node in sizes if c == k and (c, node) not in small) for k in range(classes)]
        sizes = {}
        if not any(open_nodes):
            break
        level = next(nodes[0] for nodes in open_nodes if nodes).bit_length() - 1
        job = (trees, level, open_nodes, columns, bins, turn, share, seed)
        parts = states.mapPartitions(lambda part, job=job: histograms(part, *job))
        if tasks > 1:
            parts = parts.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), min(tasks, sum(map(len, open_nodes))))
        for split in parts.mapPartitions(lambda part: best_splits(part, columns, least)).collect():
            sizes |= {(split[0][0], child): split[5] for child in planted(split)}
    if small:
        nodes = sorted(small)
        sent = states.mapPartitions(lambda part: sent_rows(part, trees, nodes, turn, share, seed))
        if tasks > 1:
            counts = [small[n] for n in nodes]
            parts = min(len(nodes), max(tasks, -(-sum(counts) // LOCAL_ROWS)))
            place = dealt(counts, parts)
            sent = sent.partitionBy(parts, lambda i: place[i])
        for split in sent.mapPartitions(lambda part: subtrees(part, nodes, columns, bins, depth, least)).collect():
            planted(split)
    return trees


def _advanced(state: State, trees: Trees) -> State:
    bins, y, margins, mark = state
    return bins, y, margins + trees.scores(bins), mark


def fit_rounds(
    blocks: RDD, edges: list[np.ndarray], classes: int, params: BoostedParams, seed: int, rounds: Sequence[Trees] = ()
) -> list[Trees]:
    """The trees of all rounds, those of ``rounds`` first: going on from them gives what one go would have given."""
    rounds = list(rounds)

    def begun(b: Block) -> State:
        x, y, mark = b
        state = binned(x, edges), y, np.zeros((len(y), classes)), mark
        for trees in done:
            state = _advanced(state, trees)
        return state

    done = list(rounds)

    bins = max((len(e) for e in edges), default=0) + 2
    level = StorageLevel.MEMORY_AND_DISK
    states = blocks.map(begun).persist(level)
    before: list[RDD] = []
    try:
        rows = states.map(lambda s: len(s[1])).sum()
        for turn in range(len(rounds), params.trees):
            rounds.append(grown(states, rows, classes, len(edges), bins, params, turn, seed))
            # That job has computed the states of this round: those it was made from are not needed any more.
            for old in before:
                old.unpersist()
            before = [states]
            states = states.map(lambda s, trees=rounds[-1]: _advanced(s, trees)).persist(level)
            if turn % CHECKPOINT_ROUNDS == CHECKPOINT_ROUNDS - 1:
                states.checkpoint()
    finally:
        for old in (*before, states):
            old.unpersist()
    return rounds


class BoostedModel(Model, MLReadable, MLWritable):
    """Adds ``probability`` (by class) and ``prediction`` to a table that has the ``features``."""

    def __init__(self, features: Sequence[str] = (), edges: Sequence[np.ndarray] = (), trees: Trees | None = None):
        """``trees`` holds arrays of rounds x classes x nodes."""
        super().__init__()
        self.features, self.edges, self.trees = list(features), list(edges), trees

    def margins(self, x: np.ndarray) -> np.ndarray:
        t = self.trees
        bins = binned(x, self.edges)
        total = np.zeros((len(x), t.feature.shape[1]))
        for turn in range(len(t.feature)):
            total += Trees(t.feature[turn], t.cut[turn], t.value[turn]).scores(bins)
        return total

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held = dataset.sparkSession.sparkContext.broadcast((self.features, self.edges, self.trees))
        return scored_columns(dataset, self.features, lambda x: softmax(BoostedModel(*held.value).margins(x)))

    def state(self) -> tuple[dict, dict[str, np.ndarray]]:
        arrays = {f"edges_{i}": e for i, e in enumerate(self.edges)}
        return {"features": self.features}, arrays | {"feature": self.trees.feature, "cut": self.trees.cut, "value": self.trees.value}

    @classmethod
    def from_state(cls, settings: dict, arrays: dict[str, np.ndarray]) -> BoostedModel:
        edges = [arrays[f"edges_{i}"] for i in range(len(settings["features"]))]
        return cls(settings["features"], edges, Trees(arrays["feature"], arrays["cut"], arrays["value"]))

    def write(self) -> ArrayModelWriter:
        return ArrayModelWriter(self)

    @classmethod
    def read(cls) -> ArrayModelReader:
        return ArrayModelReader(cls)


class BoostedTrees(Estimator):
    """Boosted trees for classes 0, 1, ... of an integer label; rows without a label are left out.

    ``min_child`` bounds the sum of hessians 2p(1 - p) on both sides of a split, ``colsample`` is the share of features a
    tree may use (rounded up), ``subsample`` the share of rows a round sees. Missing values go with the smallest.
    """

    def __init__(self, features: Sequence[str], label: str, classes: int, params: BoostedParams = BoostedParams(), seed: int = 2, bins: int = MAX_BINS):
        super().__init__()
        self.features, self.label, self.classes, self.settings, self.seed, self.bins = list(features), label, classes, params, seed, bins

    def _fit(self, dataset: DataFrame) -> BoostedModel:
        data = BoostedData.of(dataset, self.features, self.label, self.bins)
        return data.model(fit_rounds(data.blocks, data.edges, self.classes, self.settings, self.seed))


@dataclass(frozen=True)
class BoostedData:
    """Training rows cut into blocks, and the bins of their features: what fits of several settings have in common."""

    features: list[str]
    blocks: RDD
    edges: list[np.ndarray]

    @classmethod
    def of(cls, df: DataFrame, features: Sequence[str], label: str, bins: int = MAX_BINS, side_by_side: int = 1) -> BoostedData:
        """``side_by_side``: see ``training_blocks``."""
        scratch_root(df.sparkSession)
        labelled = df.filter(quoted(label).isNotNull())
        edges = quantile_edges(labelled, features, bins)
        blocks, total = training_blocks(labelled, features, label, side_by_side=side_by_side)
        if not total:
            raise ValueError("no labelled rows to train on")
        return cls(list(features), blocks, edges)

    def model(self, rounds: Sequence[Trees]) -> BoostedModel:
        stacked = [np.array([getattr(t, name) for t in rounds]) for name in ("feature", "cut", "value")]
        return BoostedModel(self.features, self.edges, Trees(*stacked))
