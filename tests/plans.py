"""Helpers that look at physical plans."""

from __future__ import annotations


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def assert_absent(df, *operators: str) -> None:
    text = plan_text(df)
    for name in operators:
        assert name not in text, f"{name} in\n{text}"
