"""Min-max scaling with separate fit and transform."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import isinf

from pyspark.sql import DataFrame, functions as F

from flowlab.functions.names import quoted
from flowlab.functions.numbers import is_numeric, known


def column_ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, lower, upper)`` of the known values, in one pass."""
    values = [known(quoted(c).cast("double")) for c in columns]
    row = df.agg(*[F.struct(F.min(v).alias("lower"), F.max(v).alias("upper")).alias(c) for c, v in zip(columns, values)])
    return row.unpivot([], [quoted(c) for c in columns], "column_name", "r").select(
        "column_name", "r.lower", "r.upper"
    )


@dataclass(frozen=True)
class MinMaxModel:
    """Column ranges; ``transform`` maps each listed column's range to 0..1."""

    ranges: dict[str, tuple[float | None, float | None]]

    @classmethod
    def fit(cls, df: DataFrame, categorical: Sequence[str] = ()) -> MinMaxModel:
        """Ranges of every column outside ``categorical``."""
        columns = [c for c in df.columns if c not in categorical]
        text = [c for c in columns if not is_numeric(df.schema[c])]
        if text:
            raise ValueError(f"columns are not numeric: {text}")
        if not columns:
            return cls({})
        # One row per column.
        rows = column_ranges(df, columns).collect()
        ranges = {r["column_name"]: (r["lower"], r["upper"]) for r in rows}
        wild = [c for c, ends in ranges.items() if any(e is not None and isinf(e) for e in ends)]
        if wild:
            raise ValueError(f"columns hold infinite values: {wild}")
        return cls({c: ranges[c] for c in columns})

    def transform(self, df: DataFrame) -> DataFrame:
        """A column with a single value becomes 0; NULL and NaN stay as they are."""
        scaled = {}
        for c, (lower, upper) in self.ranges.items():
            if lower is None:
                continue
            width = (upper - lower) or 1.0
            scaled[c] = (quoted(c).cast("double") - F.lit(lower)) / F.lit(width)
        return df.withColumns(scaled) if scaled else df


def minmax_scale(df: DataFrame, categorical: Sequence[str] = (), fit_on: DataFrame | None = None) -> DataFrame:
    """Scale ``df`` by the ranges of ``fit_on``, which is ``df`` itself unless given."""
    return MinMaxModel.fit(df if fit_on is None else fit_on, categorical).transform(df)
