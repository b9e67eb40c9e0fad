"""Class balancing: every kept class is brought down to the size of the smallest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.operators.clean import exclude_labels
from flowlab.operators.ranking import class_sizes, digest, hash_position, hinted, rank_thresholds


def class_counts(df: DataFrame, target: str) -> DataFrame:
    """``(target, n)``: rows per class."""
    return df.groupBy(quoted(target)).agg(F.count(F.lit(1)).alias("n"))


def class_number(df: DataFrame, target: str) -> DataFrame:
    """One row: how many distinct labels there are."""
    return df.agg(F.count_distinct(quoted(target)).alias("n_classes"))


def balance_exact(
    df: DataFrame, target: str, key: Sequence[str], ignore: Sequence = (), seed: int = 2
) -> DataFrame:
    """Exactly as many rows of each kept class as the smallest one has.

    The rows of a class are taken in the order of a digest of ``key``, which must tell the rows
    apart. Rows without a label and the ``ignore`` classes leave.
    """
    labelled = exclude_labels(df, target, ignore)
    sizes = class_sizes(labelled, target)
    cuts = rank_thresholds(
        labelled, target, key, seed, lambda n: F.array(F.lit(sizes.smallest)), sizes
    ).select(F.col("class").alias("_class"), F.get("cuts", F.lit(0))["position"].alias("_last"))
    return (
        labelled.join(hinted(cuts, sizes.small), quoted(target) == F.col("_class"))
        .filter(hash_position(key, seed) <= F.col("_last"))
        .drop("_class", "_last")
    )


def balance_bernoulli(
    df: DataFrame,
    target: str,
    ignore: Sequence = (),
    seed: int = 2,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Each row of a kept class stays with probability smallest / size of its class.

    With ``key`` the draw is a digest of the row, the same on every run and partitioning.
    Without it the draw is Spark's seeded ``rand``, taken before any shuffle, so that a repeated
    task over the same file split draws the same numbers. A table that itself comes out of a
    shuffle has no such fixed row order: give a key for it.
    """
    labelled = exclude_labels(df, target, ignore)
    sizes = class_sizes(labelled, target)
    if key is None:
        draw = F.rand(seed)
    else:
        # The first 52 bits of the digest as a number in [0, 1).
        draw = F.conv(F.substring(digest(key, seed), 1, 13), 16, 10).cast("double") / float(1 << 52)
    shares = class_counts(labelled, target).select(
        quoted(target).alias("_class"), (F.lit(float(sizes.smallest)) / F.col("n")).alias("_share")
    )
    return (
        labelled.withColumn("_draw", draw)
        .join(hinted(shares, sizes.small), quoted(target) == F.col("_class"))
        .filter(F.col("_draw") < F.col("_share"))
        .drop("_class", "_share", "_draw")
    )
