"""Looking at frames in tests."""

from __future__ import annotations


def tuples(df, *order):
    """Rows as tuples, sorted by all columns unless told otherwise."""
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
