"""Linear discriminant reduction fitted from distributed scatter sums.

Up to ``DENSE_WIDTH`` features the driver decomposes a features x features matrix, whatever the number of classes. Wider
tables are solved by conjugate gradients, whose steps Spark sums over the rows: the driver holds classes x features numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.operators.batches import matrix, packed
from flowlab.operators.matrices import Layout, gathered, summed, upper_cells
from flowlab.storage import scratch_path

# Directions whose within-class deviation falls below this are dropped.
TOLERANCE = 1e-4
#: A matrix of this many features squared fits the driver.
DENSE_WIDTH = 4096
#: Class means of more numbers than this stay in a table.
DRIVER_CELLS = DENSE_WIDTH ** 2
#: Conjugate gradients end where the squared residual has fallen by this.
SETTLED = 1e-20


def _class_stats(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    # One vector aggregate instead of an average per feature: wide tables would leave codegen.
    # A missing value turns its mean into NaN, so the means show whether the data has gaps.
    vector = array_to_vector(packed([quoted(c) for c in features]))
    return df.groupBy(quoted(target)).agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(vector)).alias("means")
    )


def class_means(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(target, n, prior, means)``: size, share and mean vector of each class."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return _class_stats(df, features, target).select(
        quoted(target), "n", (F.col("n") / total).alias("prior"), "means"
    )


def within_scatter(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """``(i, j, v)`` for i <= j: the sums of (x - class mean)(x - class mean)'. A table without rows gives none."""
    layout = _square(len(features))
    means = _class_stats(df, features, target).select(quoted(target).alias("label"), "means")
    return upper_cells(_within(_beside_means(df, features, target, means), layout), layout, ["v"])


def _square(width: int) -> Layout:
    return Layout(1, width, width, upper=True)


def _beside_means(df: DataFrame, features: Sequence[str], target: str, means: DataFrame) -> DataFrame:
    """``x, means``: each row next to the means of its class. Spark broadcasts the means if they are few."""
    rows = df.select(quoted(target).alias("of"), packed([quoted(c) for c in features]).alias("x"))
    return rows.join(means, F.col("of").eqNullSafe(F.col("label"))).select("x", "means")


def _centred(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return matrix(batch.column("x"), width) - matrix(batch.column("means"), width)


def _within(beside: DataFrame, layout: Layout) -> DataFrame:
    def term(batch: pa.RecordBatch) -> np.ndarray:
        x = _centred(batch, layout.rows)
        return (x.T @ x)[None]

    return summed(beside, layout, term)


def _between(stats: DataFrame, centre: np.ndarray) -> DataFrame:
    """Sums over the classes of n (mean - centre)(mean - centre)'."""
    layout = _square(len(centre))

    def term(batch: pa.RecordBatch) -> np.ndarray:
        x = matrix(batch.column("means"), layout.rows) - centre
        return (x.T @ (x * batch.column("n").to_numpy()[:, None]))[None]

    return summed(stats.select("n", "means"), layout, term)


def _solved(beside: DataFrame, wanted: np.ndarray, free: float) -> np.ndarray:
    """The within-class covariance's inverse times ``wanted``, by conjugate gradients.

    Features are scaled to a spread of one, a step is one pass for all columns of ``wanted``. Dependent features do
    no harm: class means depend on each other as the rows do. Features that have no spread within the classes but tell
    them apart have no solution and raise.
    """
    width, columns = wanted.shape
    line, layout = Layout(1, width, 1), Layout(1, width, columns)
    squares = gathered(summed(beside, line, lambda b: np.square(_centred(b, width)).sum(axis=0)[None, :, None]), line)
    scale = np.sqrt(squares[0] / free)
    scale[scale == 0] = 1.0

    def times(p: np.ndarray) -> np.ndarray:
        p = p / scale

        def term(batch: pa.RecordBatch) -> np.ndarray:
            x = _centred(batch, width)
            return (x.T @ (x @ p))[None]

        return gathered(summed(beside, layout, term), layout)[0] / scale / free

    x = np.zeros_like(wanted)
    residual = wanted / scale
    p, size = residual.copy(), (residual * residual).sum(axis=0)
    start = size.copy()
    # Without rounding, as many steps as features end it; far fewer do for features that are not nearly dependent.
    for _ in range(2 * width):
        open_ = size > SETTLED * start
        if not open_.any():
            return x / scale
        q = times(p)
        length = (p * q).sum(axis=0)
        if (open_ & (length <= 0)).any():
            break
        step = np.where(open_, size / np.where(length > 0, length, 1.0), 0.0)
        x += step * p
        residual = residual - step * q
        before, size = size, np.where(open_, (residual * residual).sum(axis=0), 0.0)
        p = residual + np.where(open_, size / np.where(before > 0, before, 1.0), 0.0) * p
    raise ValueError("features without spread within the classes tell them apart, or features are nearly dependent")


def _constants(values: np.ndarray) -> Column:
    """An array of doubles written as one text literal, which the optimiser folds; thousands of literal
    nodes would be slow to plan."""
    text = ",".join(repr(float(v)) for v in values)
    return F.split(F.lit(text), ",").cast("array<double>")


def _whitening(within: np.ndarray, rows: int, classes: int) -> np.ndarray:
    """Axes in which every class has unit spread."""
    deviation = np.sqrt(np.diag(within) / rows)
    deviation[deviation == 0] = 1.0
    spread, turn = np.linalg.eigh(within / np.outer(deviation, deviation) / (rows - classes))
    size = np.sqrt(np.clip(spread, 0.0, None))
    kept = np.flatnonzero(size > TOLERANCE)[::-1]
    return (turn[:, kept] / size[kept]) / deviation[:, None]


def _spread(square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of the eigenvalues, the largest first, and their vectors."""
    values, vectors = np.linalg.eigh((square + square.T) / 2)
    return np.sqrt(np.clip(values[::-1], 0.0, None)), vectors[:, ::-1]


@dataclass(frozen=True)
class DiscriminantModel:
    """Projection onto the directions that separate the classes best."""

    features: list[str]
    target: str
    centre: np.ndarray
    axes: np.ndarray
    ratios: np.ndarray

    @classmethod
    def fit(
        cls, df: DataFrame, target: str, features: Sequence[str] | None = None, dense_width: int = DENSE_WIDTH,
        driver_cells: int = DRIVER_CELLS,
    ) -> DiscriminantModel:
        """Fit on the rows of ``df``; every other column is a feature unless listed.

        Labels and features must be known. Two passes over the data for up to ``dense_width`` features, else a pass for each
        step of conjugate gradients over a copy of the rows. Only tables with more features than that and more than
        ``driver_cells`` class means are refused: their axes would not fit either.
        """
        features = [c for c in df.columns if c != target] if features is None else list(features)
        width = len(features)
        stats = _class_stats(df, features, target).select(quoted(target).alias("label"), "n", "means")
        found = stats.limit(driver_cells // width + 1).collect()
        if many := len(found) * width > driver_cells:
            path = scratch_path(df.sparkSession, "class-means")
            stats.write.parquet(path)
            stats = df.sparkSession.read.schema(stats.schema).parquet(path)
        wild = F.exists("means", lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
        unknown = stats.filter(F.col("label").isNull() | wild).limit(1).count() if many else any(
            r.label is None or not np.isfinite(r.means).all() for r in found
        )
        if unknown:
            raise ValueError("labels and features must be known and finite")
        if many and width > dense_width:
            raise ValueError(f"the means of the classes in {width} features are more than {driver_cells} numbers")
        classes, rows = stats.agg(F.count(F.lit(1)), F.sum("n")).first() if many else (len(found), sum(r.n for r in found))
        if classes < 2 or rows <= classes:
            raise ValueError("need at least two classes and more rows than classes")
        if many:
            line = Layout(1, width, 1)
            totals = summed(
                stats.select("n", "means"), line,
                lambda b: (b.column("n").to_numpy() @ matrix(b.column("means"), width))[None, :, None],
            )
            centre = gathered(totals, line)[0, :, 0] / rows
        else:
            found.sort(key=lambda r: r.label)
            priors = np.array([r.n for r in found]) / rows
            means = np.array([r.means for r in found])
            centre = priors @ means
            # Rows whose outer products sum to the between-class covariance.
            offsets = np.sqrt(rows * priors / (classes - 1))[:, None] * (means - centre)
            stats = df.sparkSession.createDataFrame([(r.label, r.means) for r in found], stats.select("label", "means").schema)
        beside = _beside_means(df, features, target, stats.select("label", "means"))
        if width > dense_width:
            path = scratch_path(df.sparkSession, "centred")
            schema = beside.schema
            beside.write.parquet(path)
            solution = _solved(df.sparkSession.read.schema(schema).parquet(path), offsets.T, rows - classes)
            lengths, axes = _spread(offsets @ solution)
            axes = solution @ np.divide(axes, lengths, out=np.zeros_like(axes), where=lengths > 0)
        else:
            whiten = _whitening(gathered(_within(beside, _square(width)), _square(width))[0], rows, classes)
            if many:
                between = gathered(_between(stats, centre), _square(width))[0] / (classes - 1)
                lengths, directions = _spread(whiten.T @ between @ whiten)
            else:
                _, lengths, directions = np.linalg.svd(offsets @ whiten, full_matrices=False)
                directions = directions.T
            axes = whiten @ directions
        most = min(classes - 1, width)
        rank = min(most, int(np.sum(lengths > TOLERANCE * lengths[0])))
        return cls(features, target, centre, axes[:, :rank], (lengths**2 / np.sum(lengths**2))[:most])

    @property
    def max_components(self) -> int:
        return len(self.ratios)

    def component_names(self, components: int) -> list[str]:
        """Columns that ``transform`` gives: fewer than asked if the classes span fewer axes."""
        if not 1 <= components <= self.max_components:
            raise ValueError(f"components must lie in 1..{self.max_components}")
        return [f"c{k}" for k in range(min(components, self.axes.shape[1]))]

    def explained_variance(self) -> list[tuple[int, float]]:
        """Cumulative share of between-class variance for 1..max components."""
        return [(k, float(v)) for k, v in enumerate(np.cumsum(self.ratios), start=1)]

    def transform(self, df: DataFrame, components: int) -> DataFrame:
        """``c0..`` and every column of ``df`` that is not a feature.

        The features are packed into an array once and each component is one dot product, whose
        expression does not grow with the width. A NULL feature makes the components NULL.
        """
        names = self.component_names(components)
        rest = [c for c in df.columns if c not in self.features]
        row = F.struct(*[quoted(c) for c in rest]) if rest else F.lit(None)
        x = F.zip_with(
            F.array(*[quoted(c).cast("double") for c in self.features]), _constants(self.centre), lambda v, m: v - m
        )
        packed_rows = df.select(x.alias("x"), row.alias("row"))

        def dot(axis: np.ndarray) -> Column:
            parts = F.zip_with("x", _constants(axis), lambda v, a: v * a)
            return F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)

        projected = [dot(self.axes[:, k]).alias(name) for k, name in enumerate(names)]
        return packed_rows.select(*projected, *[F.col("row")[c].alias(c) for c in rest])


def lda_variance_ratio(df: DataFrame, target: str, features: Sequence[str] | None = None) -> DataFrame:
    """``(k, ratio)``: cumulative explained variance from one decomposition."""
    model = DiscriminantModel.fit(df, target, features)
    return df.sparkSession.createDataFrame(model.explained_variance(), "k int, ratio double")
