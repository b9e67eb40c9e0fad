"""Stratified hold-out split and stratified folds, exact and free of full-row shuffles."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.operators.ranking import class_sizes, hash_position, hinted, rank_thresholds


def _with_cuts(
    df: DataFrame, target: str, key: Sequence[str], seed: int, ranks: Callable[[Column], Column],
    cuts_per_class: int,
) -> DataFrame:
    sizes = class_sizes(df, target, cuts_per_class)
    cuts = rank_thresholds(df, target, key, seed, ranks, sizes).select(
        F.col("class").alias("_class"), F.col("cuts").alias("_cuts")
    )
    return df.join(
        hinted(cuts, sizes.small), quoted(target).eqNullSafe(F.col("_class")), "left"
    ).drop("_class")


def stratified_split(
    df: DataFrame, target: str, key: Sequence[str], fraction: float = 0.15, seed: int = 2
) -> DataFrame:
    """Add ``is_test``: true for ``round(fraction * size)`` rows of each class.

    The rows of a class are ordered by a digest of ``key``, which must tell the rows apart.
    """
    marked = _with_cuts(df, target, key, seed, lambda n: F.array(F.round(n * F.lit(fraction))), 1)
    last = F.get("_cuts", F.lit(0))["position"]
    inside = F.coalesce(hash_position(key, seed) <= last, F.lit(False))
    return marked.withColumn("is_test", inside).drop("_cuts")


def train_test(
    df: DataFrame, target: str, key: Sequence[str], fraction: float = 0.15, seed: int = 2
) -> tuple[DataFrame, DataFrame]:
    """The two sides of ``stratified_split``."""
    marked = stratified_split(df, target, key, fraction, seed)
    return (
        marked.filter(~F.col("is_test")).drop("is_test"),
        marked.filter("is_test").drop("is_test"),
    )


def stratified_kfold(
    df: DataFrame, target: str, key: Sequence[str], k: int = 5, seed: int = 2
) -> DataFrame:
    """Add ``fold`` in 0..k-1; within a class the folds differ by one row at most.

    Folds are consecutive stretches of the digest order, so a row's fold is the number of the
    k-1 fold ends that lie before it.
    """
    if k < 2:
        raise ValueError("at least two folds are needed")

    def fold_ends(n: Column) -> Column:
        base, extra = F.floor(n / k), n % k
        return F.array(*[base * j + F.least(F.lit(j), extra) for j in range(1, k)])

    marked = _with_cuts(df, target, key, seed, fold_ends, k - 1)
    here = hash_position(key, seed)
    # Ends at rank 0 (classes smaller than k never have one) are absent from the cut list.
    passed = F.size(F.filter(F.coalesce("_cuts", F.array()), lambda c: c["position"] < here))
    return marked.withColumn("fold", passed.cast("int")).drop("_cuts")
