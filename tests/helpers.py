"""What the tests of all modules share."""

from __future__ import annotations


def rows(df):
    """Rows as plain tuples, in the frame's order."""
    return [tuple(row) for row in df.collect()]


def unordered(df):
    return sorted(rows(df), key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
