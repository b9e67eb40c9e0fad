"""Numeric helpers that never raise on bad rows under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowlab.functions.names import quoted

INFINITY = float("inf")


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def as_double(df: DataFrame, name: str) -> Column:
    """``name`` as double; unreadable text becomes NULL, ``Infinity`` becomes the real one."""
    field = df.schema[name]
    if isinstance(field.dataType, T.DoubleType):
        return quoted(name)
    if is_numeric(field):
        return quoted(name).cast("double")
    return quoted(name).cast("string").try_cast("double")


def finite(value: Column) -> Column:
    """The value if it is finite, else NULL. Spark sorts NaN above infinity, so one test does."""
    return F.when(F.abs(value) < F.lit(INFINITY), value)


def known(value: Column) -> Column:
    """The value, with NaN counted as missing."""
    return F.when(~F.isnan(value), value)
