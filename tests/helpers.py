"""Small shapes and plans for the tests."""

from __future__ import annotations


def ring(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


def box(x, y, w, h):
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
