"""Votes of one annotation row to one score: higher-order functions, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.schemas import LABELS

STRATEGIES = ("min", "max", "mean", "majority")


def valid_votes(scores: Column, labels: Sequence[float] = LABELS) -> Column:
    """Votes that are one of the labels; NULL, NaN and others drop out."""
    allowed = F.array(*[F.lit(float(x)) for x in labels])
    return F.filter(scores, lambda x: x.isNotNull() & F.array_contains(allowed, x))


def _mean(v: Column) -> Column:
    return F.try_divide(F.aggregate(v, F.lit(0.0), lambda a, x: a + x), F.size(v).cast("double"))


def majority(v: Column) -> Column:
    """Mean of all values that share the top frequency; NULL without votes."""
    n = lambda x: F.size(F.filter(v, lambda y: y == x))
    top = F.array_max(F.transform(v, n))
    return _mean(F.filter(F.array_distinct(v), lambda m: n(m) == top))


def most_common(v: Column) -> Column:
    """Most frequent value, the first seen among equals; NULL without votes."""
    n = lambda x: F.size(F.filter(v, lambda y: y == x))
    top = F.array_max(F.transform(v, n))
    return F.try_element_at(F.filter(v, lambda x: n(x) == top), F.lit(1))


def aggregate(scores: Column, strategy: str, labels: Sequence[float] = LABELS) -> Column:
    v = valid_votes(scores, labels)
    if strategy == "min":
        return F.array_min(v)
    if strategy == "max":
        return F.array_max(v)
    if strategy == "mean":
        return _mean(v)
    if strategy == "majority":
        return majority(v)
    raise NotImplementedError(strategy)
