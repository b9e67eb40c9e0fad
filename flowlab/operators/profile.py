"""Data profiles: shares, value counts, histograms and correlations."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.functions.numbers import as_double, finite, is_numeric
from flowlab.operators.balance import class_counts
from flowlab.operators.batches import matrix, packed
from flowlab.operators.matrices import Layout, summed, upper_cells


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f)]


def class_share(df: DataFrame, target: str) -> DataFrame:
    """``(target, n, share)``: rows per class and their percentage of all labelled rows."""
    labelled = df.filter(quoted(target).isNotNull())
    total = labelled.agg(F.count(F.lit(1))).scalar()
    return class_counts(labelled, target).withColumn("share", F.col("n") * 100.0 / total)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, value, n)`` for each non-numeric column, NULL left out.

    The rows are turned to (column, value) pairs and counted before they are shuffled.
    """
    if columns is None:
        columns = [f.name for f in df.schema.fields if not is_numeric(f)]
    texts = df.select(*[quoted(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot([], [quoted(c) for c in columns], "column_name", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 30) -> DataFrame:
    """``(column_name, bin, lower, upper, n)``: equal-width bins from minimum to maximum.

    The last bin is closed; only finite values are counted; empty bins are listed with 0. A
    column with one value gets a range of width 1 around it.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    values = df.select(*[finite(as_double(df, c)).alias(c) for c in columns])
    ends = values.agg(
        *[F.min(quoted(c)).alias(f"lo:{c}") for c in columns],
        *[F.max(quoted(c)).alias(f"hi:{c}") for c in columns],
    ).first()
    ranges = {}
    for c in columns:
        lo, hi = ends[f"lo:{c}"], ends[f"hi:{c}"]
        if lo is not None:
            ranges[c] = (lo, hi) if hi > lo else (lo - 0.5, hi + 0.5)
    frame = [
        (c, b, lo + (hi - lo) * b / bins, lo + (hi - lo) * (b + 1) / bins)
        for c, (lo, hi) in ranges.items() for b in range(bins)
    ]
    edges = df.sparkSession.createDataFrame(frame, "column_name string, bin int, lower double, upper double")
    if not ranges:
        return edges.withColumn("n", F.lit(0).cast("long"))
    # ``least`` skips NULL, so the missing values are kept out of it.
    placed = values.select(*[
        F.when(
            quoted(c).isNotNull(), F.least(F.floor((quoted(c) - lo) / (hi - lo) * bins), F.lit(bins - 1))
        ).cast("int").alias(c)
        for c, (lo, hi) in ranges.items()
    ])
    counted = (
        placed.unpivot([], [quoted(c) for c in ranges], "column_name", "bin")
        .filter(F.col("bin").isNotNull())
        .groupBy("column_name", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    # Both sides hold columns x bins rows at most.
    return edges.join(F.broadcast(counted), ["column_name", "bin"], "left").fillna(0, ["n"])


MOMENTS = ["n", "mx", "my", "sxx", "syy", "sxy", "wild"]


def _pair_moments(values: np.ndarray) -> np.ndarray:
    """``MOMENTS`` of all column pairs over the rows in which both values are known: their number, the
    means, the centred sums of squares and products, and how many rows hold an infinity.

    Each pair is centred by its own means, taken from its first row, so neither large values in rows
    that the pair leaves out nor large means swallow a spread, and a constant has the spread 0.
    """
    width = values.shape[1]
    infinite = np.isinf(values)
    seen = ~np.isnan(values)
    values = np.where(infinite, 0.0, values)
    n, mean, square, product = (np.zeros((width, width)) for _ in range(4))
    whole = bool(seen.all())
    for j in range(width):
        rows = slice(None) if whole else seen[:, j]
        part, here = values[rows], seen[rows]
        if not len(part):
            continue
        first = part[here.argmax(axis=0), np.arange(width)]
        shifted = np.where(here, part - first, 0.0)
        count = here.sum(axis=0)
        middle = shifted.sum(axis=0) / np.maximum(count, 1)
        centred = np.where(here, shifted - middle, 0.0)
        n[:, j], mean[:, j], square[:, j] = count, np.where(count, first + middle, 0.0), (centred * centred).sum(axis=0)
        product[:, j] = centred.T @ shifted[:, j]
        if whole:
            # All pairs share their rows: one matrix product holds every column's products.
            n[:] = count[0]
            mean[:], square[:] = mean[:, j:j + 1], square[:, j:j + 1]
            product = centred.T @ centred
            break
    wild = (infinite.T.astype(float) @ seen) + (seen.T.astype(float) @ infinite)
    return np.stack([n, mean, mean.T, square, square.T, product, wild])


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two sets of rows together (pairwise update of Chan, Golub and LeVeque)."""
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1)
    dx, dy = b[1] - a[1], b[2] - a[2]
    # A side without rows has no means to differ from.
    both = a[0] * share
    return np.stack([
        n, np.where(a[0] > 0, a[1] + dx * share, b[1]), np.where(a[0] > 0, a[2] + dy * share, b[2]),
        a[3] + b[3] + dx * dx * both, a[4] + b[4] + dy * dy * both, a[5] + b[5] + dx * dy * both, a[6] + b[6],
    ])


def pair_moments(rows: DataFrame, width: int) -> DataFrame:
    """``i, j`` and ``MOMENTS`` of all pairs in a packed column.

    A task joins its batches; what tasks give is joined band by band in levels.
    """
    layout = Layout(len(MOMENTS), width, width, upper=True)
    parts = summed(rows, layout, lambda batch: _pair_moments(matrix(batch.column(0), width)), _joined)
    return upper_cells(parts, layout, MOMENTS)


def corr_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_a, column_b, corr)``: Pearson correlation of every pair, both orders.

    A pair uses the rows in which both values are known. It is NULL if either side is constant
    or infinite there. Its value does not depend on which other columns are asked for.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    values = df.select(packed([as_double(df, c) for c in columns]))
    spread = F.sqrt("sxx") * F.sqrt("syy")
    corr = F.when((F.col("n") > 1) & (F.col("wild") == 0), F.try_divide("sxy", spread))
    found = pair_moments(values, len(columns)).select("i", "j", corr.alias("corr"))
    pairs = df.sparkSession.createDataFrame(
        [(i, j) for i in range(len(columns)) for j in range(i, len(columns))], "i int, j int"
    )
    # Pairs without a row are listed too.
    upper = pairs.join(found, ["i", "j"], "left")
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    )
    names = F.array(*[F.lit(c) for c in columns])
    return upper.select(F.explode(both).alias("p"), "corr").select(
        F.get(names, F.col("p.i")).alias("column_a"),
        F.get(names, F.col("p.j")).alias("column_b"),
        "corr",
    )
