"""Expressions over an array of class scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def _with_one(scores: Column, value: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Combine every score with one value, which is thereby worked out once per row."""
    return F.zip_with(scores, F.array_repeat(value, F.size(scores)), combine)


def _shifted_exp(scores: Column) -> Column:
    return _with_one(scores, F.array_max(scores), lambda s, top: F.exp(s - top))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def softmax(scores: Column) -> Column:
    """Class probabilities; shifting by the largest score keeps ``exp`` from overflowing."""
    powers = _shifted_exp(scores)
    return _with_one(powers, _total(powers), lambda e, total: e / total)


def argmax_class(scores: Column) -> Column:
    """Position of the largest score, the lowest one on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def log_softmax_loss(label: Column, scores: Column) -> Column:
    """Cross entropy of one row: log-sum-exp of the scores minus the true class's score."""
    top = F.array_max(scores)
    return top + F.ln(_total(_shifted_exp(scores))) - F.get(scores, label.cast("int"))
