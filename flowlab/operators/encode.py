"""Frequency-ordered indexes and their lookup."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from flowlab.functions.names import quoted
from flowlab.operators.ranking import SMALL_TABLE_ROWS, hinted, running_totals


@dataclass(frozen=True)
class IndexMapping:
    """A ``(value, index)`` table; ``small`` tells that its row count was checked."""

    table: DataFrame
    small: bool


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(quoted(column)).distinct()


def index_mapping(df: DataFrame, column: str) -> IndexMapping:
    """Values of a column numbered from 0 by falling frequency, equal ones by their text.

    Few values are numbered by the driver; more than ``SMALL_TABLE_ROWS`` by a range-partitioned
    running count.
    """
    counts = (
        df.select(quoted(column).alias("value")).filter(F.col("value").isNotNull())
        .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    )
    order = [F.col("n").desc(), F.col("value").cast("string").asc()]
    schema = T.StructType([T.StructField("value", counts.schema["value"].dataType), T.StructField("index", T.IntegerType())])
    few = counts.withColumn("text", F.col("value").cast("string")).limit(SMALL_TABLE_ROWS + 1).collect()
    if len(few) <= SMALL_TABLE_ROWS:
        few.sort(key=lambda r: (-r["n"], r["text"]))
        rows = [(r["value"], i) for i, r in enumerate(few)]
        return IndexMapping(df.sparkSession.createDataFrame(rows, schema), True)
    ranked = running_totals(counts, [], order, {"rank": F.lit(1)})
    return IndexMapping(ranked.select("value", (F.col("rank") - 1).cast("int").alias("index")), False)


def index_mappings(df: DataFrame, columns: Sequence[str]) -> dict[str, IndexMapping]:
    """The mapping of each column; one pass counts the values of all of them, unless they are too many for the driver."""
    columns = list(dict.fromkeys(columns))
    if len(columns) < 2:
        return {c: index_mapping(df, c) for c in columns}
    kinds = {c: df.schema[c].dataType for c in columns}
    # The two zeros are one value.
    plain = {c: quoted(c) + F.lit(0.0) if isinstance(t, (T.FloatType, T.DoubleType)) else quoted(c) for c, t in kinds.items()}
    texts = df.select(*[v.cast("string").alias(c) for c, v in plain.items()])
    pairs = texts.unpivot([], [quoted(c) for c in columns], "name", "text").filter("text is not null")
    few = pairs.groupBy("name", "text").agg(F.count(F.lit(1)).alias("n")).limit(SMALL_TABLE_ROWS + 1).collect()
    if len(few) > SMALL_TABLE_ROWS or any(isinstance(t, T.BinaryType) for t in kinds.values()):
        return {c: index_mapping(df, c) for c in columns}
    found = {}
    for c, kind in kinds.items():
        rows = sorted((-r["n"], r["text"]) for r in few if r["name"] == c)
        table = df.sparkSession.createDataFrame([(text, i) for i, (_, text) in enumerate(rows)], "value string, index int")
        found[c] = IndexMapping(table.withColumn("value", F.col("value").cast(kind)), True)
    return found


def apply_index(
    df: DataFrame,
    column: str,
    output: str,
    mapping: IndexMapping,
    invalid: str = "error",
    drop: bool = True,
) -> DataFrame:
    """Add ``output``, the index of ``column``; NULL and unlisted values follow ``invalid``.

    ``error`` fails the job, ``keep`` gives them the next free index, ``skip`` drops the rows.
    """
    if invalid not in ("error", "keep", "skip"):
        raise ValueError(f"invalid must be error, keep or skip, not {invalid!r}")
    table = mapping.table.select(F.col("value").alias("_value"), F.col("index").alias("_index"))
    joined = df.join(
        hinted(table, mapping.small),
        quoted(column) == F.col("_value"),
        "inner" if invalid == "skip" else "left",
    )
    index = F.col("_index")
    if invalid == "error":
        text = F.concat(F.lit(f"no index for {column} = "), F.coalesce(quoted(column).cast("string"), F.lit("NULL")))
        index = F.coalesce(index, F.raise_error(text).cast("int"))
    elif invalid == "keep":
        index = F.coalesce(index, F.lit(mapping.table.count()))
    result = joined.withColumn(output, index).drop("_value", "_index")
    return result.drop(column) if drop and column != output else result


def string_index(
    df: DataFrame, pairs: Sequence[tuple[str, str]], invalid: str = "error", drop: bool = True
) -> tuple[DataFrame, dict[str, IndexMapping]]:
    """Fit and apply indexes for ``(column, output)`` pairs; also returns the mappings used."""
    mappings = index_mappings(df, [c for c, _ in pairs])
    for column, output in pairs:
        df = apply_index(df, column, output, mappings[column], invalid, drop)
    return df, mappings
