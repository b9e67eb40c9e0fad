"""Parquet layers and JSON value mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from flowlab.errors import MissingInput


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer; a missing or empty one is reported before any job runs."""
    if spark is None:
        raise MissingInput(f"no session to read {path} with")
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        raise MissingInput(f"no layer at {path}: {problem.getCondition()}") from problem


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    single_file: bool = False,
    max_records: int = 0,
) -> str:
    """Overwrite ``path`` with snappy Parquet, written by all tasks; returns the path.

    ``single_file`` is for outputs known to be small. ``max_records`` limits the rows per file.
    """
    writer = (df.coalesce(1) if single_file else df).write.mode("overwrite")
    writer = writer.option("compression", "snappy").option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def save_mapping(mapping: DataFrame, path: str) -> str:
    """Write a ``(value, index)`` or ``(k, ratio)`` table as JSON lines."""
    mapping.write.mode("overwrite").json(path)
    return path


def load_mapping(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as problem:
        raise MissingInput(f"no mapping at {path}: {problem.getCondition()}") from problem
