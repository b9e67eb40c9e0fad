"""Header clean-up, row filters, max-fill and constant-column removal."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from flowlab.functions.names import clean_name, quoted
from flowlab.functions.numbers import INFINITY, as_double, finite, is_numeric, known


def clean_headers(df: DataFrame) -> DataFrame:
    """Trim every column name and turn its inner blanks into underscores."""
    names = [clean_name(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"columns share a name after clean-up: {clashes}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns by name; names the table lacks are ignored."""
    return df.drop(*columns)


def filter_nonzero(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows whose listed columns are all known and not 0.

    Numeric columns stay bare references, so the test reaches the file scan.
    """
    test = nonzero_test(df, columns)
    return df if test is None else df.filter(test)


def nonzero_test(df: DataFrame, columns: Iterable[str]) -> Column | None:
    tests = [
        (quoted(c) if is_numeric(df.schema[c]) else as_double(df, c)) != 0 for c in columns
    ]
    return reduce(Column.__and__, tests) if tests else None


def exclude_labels(df: DataFrame, target: str, ignore: Sequence = ()) -> DataFrame:
    """Keep rows that have a label outside ``ignore``."""
    kept = quoted(target).isNotNull()
    return df.filter(kept & ~quoted(target).isin(list(ignore)) if ignore else kept)


def max_finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the largest finite value of each column, all in one pass."""
    return df.agg(*[F.max(finite(as_double(df, c))).alias(c) for c in columns])


def filled(df: DataFrame, name: str, value: float | None) -> Column:
    """NULL and +infinity replaced by ``value``; -infinity and NaN stay."""
    number = as_double(df, name)
    fill = F.lit(value).cast("double")
    return F.when(number.isNull() | (number == F.lit(INFINITY)), fill).otherwise(number)


def fill_with_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULL and +infinity by the column's largest finite value.

    A column without any finite value gets NULL.
    """
    if not columns:
        return df
    top = max_finite(df, columns).first()
    return df.withColumns({c: filled(df, c, top[c]) for c in columns})


def _comparable(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return known(quoted(name))
    if isinstance(kind, T.MapType):
        return F.array_sort(F.map_entries(quoted(name)))
    return quoted(name)


def constant_test(value: Column) -> Column:
    """Aggregate: exactly one distinct known value.

    Comparing two running extremes needs no distinct sets, hence no row expansion per column.
    """
    return F.coalesce(F.min(value) == F.max(value), F.lit(False))


def constant_flags(df: DataFrame) -> DataFrame:
    """One row of booleans, one per column of ``df``."""
    return df.agg(*[constant_test(_comparable(df, c)).alias(c) for c in df.columns])


def constant_profile(df: DataFrame) -> DataFrame:
    """``(column_name, is_constant)`` for every column, in one pass."""
    return constant_flags(df).unpivot(
        [], [quoted(c) for c in df.columns], "column_name", "is_constant"
    )


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """Drop columns with exactly one distinct known value; all-NULL columns stay."""
    flags = constant_flags(df).first()
    return df.drop(*[c for c in df.columns if flags[c]])


@dataclass(frozen=True)
class FillProfile:
    """What max-fill and constant removal need to know of a table, from a single pass."""

    tops: dict[str, float | None]
    constants: list[str]

    @classmethod
    def measures(
        cls, df: DataFrame, fill: Sequence[str] = (), drop_constants: bool = True, keep: Column | None = None, drop: Sequence[str] = ()
    ) -> list[Column]:
        """Aggregates from which ``of`` makes a profile of the rows that ``keep`` holds for, without the ``drop`` columns.

        All are extremes or compare extremes: a task that runs twice changes nothing, so they can also be observed while
        ``df`` is written. After the fill a column holds its finite values and maybe -infinity, so whether it is constant
        can be read off the unfilled data with +infinity left out.
        """
        held = (lambda v: v) if keep is None else (lambda v: F.when(keep, v))
        stats = [F.max(held(finite(as_double(df, c)))).alias(f"top:{c}") for c in fill]
        for c in df.columns if drop_constants else []:
            if c in drop:
                continue
            number = as_double(df, c) if c in fill else None
            value = _comparable(df, c) if number is None else F.when(number < F.lit(INFINITY), number)
            stats.append(constant_test(held(value)).alias(f"same:{c}"))
        return stats

    @classmethod
    def of(cls, found: Mapping[str, float | bool | None]) -> FillProfile:
        """The profile that measured values make, by the names of ``measures``."""
        tops = {name[4:]: v for name, v in found.items() if name.startswith("top:")}
        return cls(tops, [name[5:] for name, v in found.items() if name.startswith("same:") and v])

    @classmethod
    def fit(cls, df: DataFrame, fill: Sequence[str] = (), drop_constants: bool = True) -> FillProfile:
        stats = cls.measures(df, fill, drop_constants)
        return cls.of(df.agg(*stats).first().asDict()) if stats else cls({}, [])

    def transform(self, df: DataFrame) -> DataFrame:
        values = {c: filled(df, c, v) for c, v in self.tops.items() if c not in self.constants}
        return (df.withColumns(values) if values else df).drop(*self.constants)
