"""Small helpers for hand-made frames."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as sorted tuples of the given (or all) columns."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
