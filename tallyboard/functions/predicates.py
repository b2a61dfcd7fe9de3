"""Predicates that treat null and NaN the way the season jobs need."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, functions as F


def not_in(c: Column, values: Iterable) -> Column:
    """NOT IN that keeps null rows."""
    return c.isNull() | ~c.isin(list(values))


def differs(c: Column, value) -> Column:
    """Not-equal that keeps null rows."""
    return ~c.eqNullSafe(F.lit(value))


def above(c: Column, bound: float, floating: bool = True) -> Column:
    """``c > bound`` with NaN failing the test.

    The plain comparison stays a conjunct of its own so that the Parquet scan can
    still use it to skip row groups.
    """
    return (c > F.lit(bound)) & ~F.isnan(c) if floating else c > F.lit(bound)


def all_equal(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Equality of two column lists; a null key matches nothing."""
    return reduce(and_, (a == b for a, b in zip(left, right, strict=True)))


def all_null_safe_equal(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Null-safe equality of two column lists: null keys match null keys."""
    return reduce(and_, (a.eqNullSafe(b) for a, b in zip(left, right, strict=True)))
