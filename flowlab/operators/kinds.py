"""Types that fit columns of text, from counts that merge.

Each value is of one kind: nothing, int, long, more digits, double, date, timestamp, boolean or text. The count of every
kind by column is all that a type depends on, so the tables of several files, days or layers are summed and never read
again. One pass over the text, a few rows for each column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowlab.functions.names import quoted

NUMBERS = ("int", "long", "digits", "double")
ALONE = {"date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType()}
MOST_DIGITS = 38

_WHOLE = r"^[-+]?[0-9]+$"
_REAL = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$|^(NaN|Inf|-Inf|[-+]?Infinity)$"
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[-+][0-9]{2}:[0-9]{2})?$"


def value_kind(value: Column) -> Column:
    """The kind of a text value; an empty one counts as nothing, as the CSV reader takes it."""
    return (
        F.when(value.isNull() | (value == ""), "null")
        .when(value.rlike(_WHOLE), F.when(value.try_cast("int").isNotNull(), "int").when(value.try_cast("long").isNotNull(), "long").otherwise("digits"))
        .when(value.rlike(_REAL), "double")
        .when(value.rlike(_DATE) & value.try_cast("date").isNotNull(), "date")
        .when(value.rlike(_TIME) & value.try_cast("timestamp").isNotNull(), "timestamp")
        .when(F.lower(value).isin("true", "false"), "boolean")
        .otherwise("text")
    )


def column_kinds(text: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, kind, n, width)`` of text columns: values of each kind and the length of the longest."""
    columns = list(text.columns if columns is None else columns)
    long = text.select(*[quoted(c).cast("string").alias(c) for c in columns]).unpivot([], [quoted(c) for c in columns], "column_name", "value")
    return long.groupBy("column_name", value_kind(F.col("value")).alias("kind")).agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.length("value")), F.lit(0)).cast("long").alias("width")
    )


def merged_kinds(tables: Sequence[DataFrame]) -> DataFrame:
    """The kinds of all rows behind several tables of kinds; none of the rows is read again."""
    return reduce(DataFrame.unionByName, tables).groupBy("column_name", "kind").agg(
        F.sum("n").alias("n"), F.max("width").alias("width")
    )


def fitting_type(widths: Mapping[str, int]) -> T.DataType:
    """The type that holds every value, given the longest value of each kind.

    Whole numbers beyond 64 bits are decimals up to 38 digits. Kinds that do not mix, and columns without a value, are text.
    """
    kinds = {k for k in widths if k != "null"}
    if len(kinds) == 1 and kinds <= set(ALONE):
        return ALONE[next(iter(kinds))]
    if not kinds or not kinds <= set(NUMBERS):
        return T.StringType()
    if "double" in kinds:
        return T.DoubleType()
    if "digits" in kinds:
        width = max(widths[k] for k in kinds)
        return T.DecimalType(width, 0) if width <= MOST_DIGITS else T.DoubleType()
    return T.LongType() if "long" in kinds else T.IntegerType()


def fitting_types(kinds: DataFrame) -> dict[str, T.DataType]:
    """The type of each column in a table of kinds: at most nine rows a column reach the driver."""
    widths: dict[str, dict[str, int]] = {}
    for r in kinds.select("column_name", "kind", "width").collect():
        widths.setdefault(r["column_name"], {})[r["kind"]] = r["width"]
    return {c: fitting_type(w) for c, w in widths.items()}
