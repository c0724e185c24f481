"""Distances between two array columns as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted metric names and the metric each one means.
METRIC_NAMES = {
    "euclidean": "euclidean",
    "l2": "euclidean",
    "manhattan": "manhattan",
    "cityblock": "manhattan",
    "l1": "manhattan",
    "chebyshev": "chebyshev",
    "infinity": "chebyshev",
    "minkowski": "minkowski",
    "cosine": "cosine",
}


def metric_name(metric: str) -> str:
    try:
        return METRIC_NAMES[metric]
    except KeyError:
        raise ValueError(f"unknown metric {metric!r}; use one of {sorted(METRIC_NAMES)}") from None


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x * y))


def distance(a: Column, b: Column, metric: str = "euclidean", p: float = 2.0) -> Column:
    """Distance between two ``ARRAY<DOUBLE>`` columns of the same width."""
    name = metric_name(metric)
    if name == "cosine":
        norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
        return F.when(norms == 0, 1.0).otherwise(1.0 - dot(a, b) / norms)
    gaps = F.zip_with(a, b, lambda x, y: F.abs(x - y))
    if name == "manhattan":
        return _sum(gaps)
    if name == "chebyshev":
        return F.array_max(gaps)
    if name == "minkowski" and p != 2.0:
        return F.pow(_sum(F.transform(gaps, lambda g: F.pow(g, F.lit(p)))), F.lit(1.0 / p))
    return F.sqrt(_sum(F.transform(gaps, lambda g: g * g)))
