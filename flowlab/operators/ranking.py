"""Exact ranks and running totals that never put a whole class into one task.

A plain ``row_number() over (partition by class)`` sends every row of a class to one task, and
one class may hold a third of the table. Two remedies:

``rank_thresholds``  finds, per class, the row that sits at a given rank of a hash order. Buckets
    of the hash prefix are counted first; only the bucket that holds the rank is sorted. The
    caller then compares each row with the threshold: a filter, with no shuffle of full rows.

``running_totals``  range-partitions the rows by their sort order, fixes that layout with a
    checkpoint, and lets each partition count on from the totals of the earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from flowlab.functions.names import quoted
from flowlab.storage import checkpointed, small_copy

# Tables of at most this many rows are broadcast or ranked by a single task.
SMALL_TABLE_ROWS = 100_000
# Hash buckets are sized to hold about this many rows each.
BUCKET_ROWS = 1 << 20


@dataclass(frozen=True)
class ClassSizes:
    classes: int
    smallest: int
    largest: int
    cuts: int

    @property
    def small(self) -> bool:
        """Whether a table with ``cuts`` entries per class may be held by the driver."""
        return self.classes * self.cuts <= SMALL_TABLE_ROWS


def class_sizes(df: DataFrame, target: str, cuts: int = 1) -> ClassSizes:
    """How many classes there are and how large the extremes are, read from the label alone."""
    sizes = df.groupBy(quoted(target)).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.count("n"), F.min("n"), F.max("n")).first()
    return ClassSizes(row[0], row[1] or 0, row[2] or 0, cuts)


def hinted(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast hint for a table whose row count was checked; otherwise AQE decides."""
    return F.broadcast(df) if small else df


def digest(key: Sequence[str], seed: int) -> Column:
    """Hex digest of the row key and seed: the same on any engine and any partitioning."""
    parts = [quoted(c).cast("string") for c in key]
    return F.md5(F.concat_ws(":", *parts, F.lit(str(seed))))


def hash_position(key: Sequence[str], seed: int) -> Column:
    """Sort position of a row: digest first, key columns to settle equal digests."""
    parts = [quoted(c).alias(f"k{i}") for i, c in enumerate(key)]
    return F.struct(digest(key, seed).alias("h"), *parts)


def rank_thresholds(
    df: DataFrame,
    target: str,
    key: Sequence[str],
    seed: int,
    ranks: Callable[[Column], Column],
    sizes: ClassSizes,
) -> DataFrame:
    """Per class (NULL is one), the hash positions found at the given ranks.

    ``key`` must tell the rows apart; the job fails if two rows at a threshold are equal in it.
    ``ranks`` maps the class size to an array of ranks (1 = first); ranks below 1 or beyond the
    class find nothing. Returns ``(class, cuts)`` where ``cuts`` lists ``(cut, position)`` with
    ``cut`` the index in the rank array. Class and key columns alone are read.
    """
    keyed = df.select(quoted(target).alias("class"), hash_position(key, seed).alias("position"))

    def wanted(size: Column) -> Column:
        return F.transform(
            ranks(size), lambda r, i: F.struct(i.alias("cut"), r.cast("long").alias("rank"))
        )

    if sizes.largest <= BUCKET_ROWS:
        # Every class is known to fit one sort.
        of_class = Window.partitionBy("class")
        in_order = of_class.orderBy("position")
        placed = keyed.select(
            "class", "position",
            F.row_number().over(in_order).alias("rank"),
            F.lead("position").over(in_order).alias("next"),
            wanted(F.count(F.lit(1)).over(of_class)).alias("wanted"),
        )
    else:
        placed = _placed_in_buckets(keyed, wanted, sizes)
    # Rows equal to a threshold would all fall on the same side of it.
    twin = F.coalesce(F.col("next") == F.col("position"), F.lit(False))
    unlike = F.assert_true(~twin, f"columns {list(key)} do not tell the rows apart")
    found = (
        placed.withColumn("hit", F.explode(F.filter("wanted", lambda w: w["rank"] == F.col("rank"))))
        .filter(unlike.isNull())
        .groupBy("class")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("hit.cut").alias("cut"), "position"))).alias("cuts"))
    )
    return small_copy(found) if sizes.small else found


def _placed_in_buckets(
    keyed: DataFrame, wanted: Callable[[Column], Column], sizes: ClassSizes
) -> DataFrame:
    """Rows of those hash buckets that hold a wanted rank, with their rank in the class."""
    digits = ceil(log(sizes.largest / BUCKET_ROWS, 16))
    keyed = keyed.withColumn("bucket", F.substring("position.h", 1, digits))
    of_class = Window.partitionBy("class")
    upto = of_class.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (
        keyed.groupBy("class", "bucket").agg(F.count(F.lit(1)).alias("n"))
        .select(
            "class", "bucket",
            F.sum("n").over(upto).alias("upper"),
            (F.sum("n").over(upto) - F.col("n")).alias("lower"),
            F.sum("n").over(of_class).alias("size"),
        )
    )
    inside = F.filter(
        wanted(F.col("size")), lambda w: (w["rank"] > F.col("lower")) & (w["rank"] <= F.col("upper"))
    )
    cuts = counted.select(
        F.col("class").alias("cut_class"), F.col("bucket").alias("cut_bucket"), "lower",
        inside.alias("wanted"),
    ).filter(F.size("wanted") > 0)
    in_bucket = Window.partitionBy("class", "bucket").orderBy("position")
    same_bucket = F.col("class").eqNullSafe(F.col("cut_class")) & (F.col("bucket") == F.col("cut_bucket"))
    return keyed.join(hinted(cuts, sizes.small), same_bucket).withColumns({
        "rank": F.row_number().over(in_bucket) + F.col("lower"),
        "next": F.lead("position").over(in_bucket),
    })


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Add running sums inside each group, in the given order, the current row included.

    Rows must differ in ``group`` plus ``order``. Each name in ``totals`` becomes a long column,
    with the sum over the whole group next to it as ``<name>_total``; NULL adds nothing, and rows
    whose group is NULL are a group.

    Two phases: rows are sorted by ranges once and fixed; each partition and group is summed; then
    every partition counts on from what the earlier ones hold. The sums, a row for each partition
    and one more for each group, are broadcast while they are few.
    """
    values = df.withColumns({f"_{n}": F.coalesce(c.cast("long"), F.lit(0)) for n, c in totals.items()})
    laid_out = checkpointed(
        values.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    by_part = laid_out.groupBy("_part", *group).agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in totals])
    earlier = (
        Window.partitionBy(*group).orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = by_part.select(
        F.col("_part").alias("_p"), *[quoted(g).alias(f"_g{i}") for i, g in enumerate(group)],
        *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}_before") for n in totals],
        *[F.sum(f"_{n}").over(Window.partitionBy(*group)).alias(f"{n}_total") for n in totals],
    )
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & quoted(g).eqNullSafe(F.col(f"_g{i}"))
    few = offsets.limit(SMALL_TABLE_ROWS + 1).collect()
    if len(few) <= SMALL_TABLE_ROWS:
        numbered = [(*r, i) for i, r in enumerate(few)]
        sums = df.sparkSession.createDataFrame(numbered, T.StructType([*offsets.schema, T.StructField("_run", T.LongType())]))
        # Such a join leaves rows where they are, and in order.
        return _counted_on(laid_out.join(F.broadcast(sums), same), df.schema, list(totals))
    so_far = (
        Window.partitionBy("_part", *group).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = laid_out.join(offsets, same)
    return summed.select(
        *[quoted(c) for c in df.columns], *[(F.sum(f"_{n}").over(so_far) + F.col(f"_{n}_before")).alias(n) for n in totals],
        *[f"{n}_total" for n in totals],
    )


def _counted_on(rows: DataFrame, kept: T.StructType, totals: list[str]) -> DataFrame:
    """Running sums of rows that stand in order; ``_run`` tells the groups of a partition apart."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, dict.fromkeys(totals, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            run = batch.column("_run").to_numpy()
            starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
            lengths = np.diff(np.r_[starts, len(run)])
            found = []
            for n in totals:
                value = batch.column(f"_{n}").to_numpy()
                upto = np.cumsum(value)
                inside = upto - np.repeat((upto - value)[starts], lengths)
                if run[0] == last:
                    inside[:lengths[0]] += carried[n]
                carried[n] = inside[-1]
                found.append(pa.array(inside + batch.column(f"_{n}_before").to_numpy(), pa.int64()))
            last = run[-1]
            columns = [*(batch.column(c) for c in kept.names), *found, *(batch.column(f"{n}_total") for n in totals)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept.names, *totals, *(f"{n}_total" for n in totals)])

    new = [T.StructField(c, T.LongType()) for c in (*totals, *(f"{n}_total" for n in totals))]
    return rows.mapInArrow(count, T.StructType([*kept, *new]))
