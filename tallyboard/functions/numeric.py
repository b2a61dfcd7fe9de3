"""Numeric column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def np_round(c: Column, digits: int = 0) -> Column:
    """Half-even rounding of the scaled double; the added zero turns -0.0 into 0.0.

    Spark's own ``round`` is half-up and ``bround`` rounds the decimal expansion,
    so both differ from array-library rounding on some values.
    """
    scale = F.lit(float(10 ** digits))
    return F.rint(c.cast("double") * scale) / scale + F.lit(0.0)


def nan_to_null(c: Column) -> Column:
    """Treat NaN as missing. Without it ``NaN > x`` is true in Spark."""
    return F.when(~F.isnan(c), c)


def required(c: Column, message: str) -> Column:
    """The value, or a run-time error where it is null."""
    return F.when(c.isNull(), F.raise_error(F.lit(message))).otherwise(c)
