"""Star schema: a fact table with digest keys and the dimensions they point to."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.storage import scratch_path

#: Dimensions of up to so many rows are stored plainly and left to a broadcast; larger ones are stored in buckets.
PLAIN_ROWS = 1_000_000
#: Rows of a bucket on average.
BUCKET_ROWS = 2_000_000


def date_parts(df: DataFrame, column: str) -> DataFrame:
    """Add the year, month and day of a timestamp column."""
    ts = quoted(column)
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def surrogate_key(columns: Sequence[str]) -> Column:
    """Digest of the natural key. Every part carries its length, and NULL has none, so that no two
    different keys are written alike."""
    texts = [quoted(c).cast("string") for c in columns]
    parts = [
        F.when(t.isNull(), "-").otherwise(F.concat(F.char_length(t).cast("string"), F.lit(":"), t)) for t in texts
    ]
    return F.md5(F.concat(*parts))


def keyed(df: DataFrame, spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """``df`` with the key of each dimension."""
    return df.withColumns({f"{name}_id": surrogate_key(columns) for name, columns in spec.items()})


def _dimension(rows: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Rows that have their keys: each key once. The key stands for all its columns, so they need no comparison (grouping
    by them would turn -0.0 into 0.0, which has another key)."""
    key = f"{name}_id"
    return rows.select(key, *[quoted(c) for c in columns]).dropDuplicates([key])


def star_dimensions(df: DataFrame, spec: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """One table per dimension: ``<name>_id`` and its columns, each combination once.

    Keys are computed from the values, so no numbering pass over the dimension is needed.
    """
    rows = keyed(df, spec)
    return {name: _dimension(rows, name, columns) for name, columns in spec.items()}


def _without_dimensions(rows: DataFrame, spec: Mapping[str, Sequence[str]]) -> DataFrame:
    keys = [f"{name}_id" for name in spec]
    moved = {c for columns in spec.values() for c in columns} | set(keys)
    return rows.select(*keys, *[quoted(c) for c in rows.columns if c not in moved])


def star_fact(df: DataFrame, spec: Mapping[str, Sequence[str]]) -> DataFrame:
    """The table with each dimension's columns replaced by the dimension key."""
    return _without_dimensions(keyed(df, spec), spec)


@dataclass(frozen=True)
class StoredStar:
    """A star schema in tables: read again by any job of the session, joined again by ``star_join``."""

    fact: DataFrame
    dimensions: dict[str, DataFrame]
    bucketed_by: str | None


def store_star(
    df: DataFrame, spec: Mapping[str, Sequence[str]], plain_rows: int = PLAIN_ROWS, bucket_rows: int = BUCKET_ROWS
) -> StoredStar:
    """Writes fact and dimensions to the shared folder, the keys computed in a single pass over ``df``.

    The fact table and its largest dimension, unless that is small, share buckets of the dimension's key, so that joining
    them again moves no row. Other dimensions beyond ``plain_rows`` are in buckets of their own key: only the fact rows move.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "star-rows")
    keyed(df, spec).write.parquet(path)
    rows = spark.read.parquet(path)
    counts = rows.agg(F.count("*").alias("all rows"), *[F.approx_count_distinct(f"{name}_id").alias(name) for name in spec]).first()
    sizes = {name: counts[name] for name in spec}
    largest = max(sizes, key=sizes.get) if sizes else None
    shared = f"{largest}_id" if largest is not None and sizes[largest] > plain_rows else None
    buckets = max(2, -(-counts["all rows"] // bucket_rows))

    def stored(part: DataFrame, name: str, key: str | None) -> DataFrame:
        if key is None:
            place = scratch_path(spark, f"star-{name}")
            part.write.parquet(place)
            return spark.read.parquet(place)
        table = f"star_{name}_{uuid.uuid4().hex}"
        # Dealt out by the key first: a file for each bucket, however many tasks write.
        part.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", scratch_path(spark, f"star-{name}")).saveAsTable(table)
        return spark.table(table)

    dimensions = {
        name: stored(_dimension(rows, name, columns), name, f"{name}_id" if sizes[name] > plain_rows else None)
        for name, columns in spec.items()
    }
    return StoredStar(stored(_without_dimensions(rows, spec), "fact", shared), dimensions, shared)


def star_join(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows with their dimension columns again.

    Dimensions may be as large as the fact table, so none is forced to be broadcast: adaptive
    execution broadcasts those whose measured size allows it and splits hot keys otherwise.
    """
    for name, dimension in dimensions.items():
        fact = fact.join(dimension, f"{name}_id")
    return fact
