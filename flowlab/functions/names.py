"""Column names: flow captures carry blanks, slashes and dots in their headers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def quoted(name: str) -> Column:
    """A column reference that takes ``name`` literally, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def clean_name(name: str) -> str:
    return "_".join(name.strip().split(" "))
