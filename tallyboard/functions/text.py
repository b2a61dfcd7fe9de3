"""Text column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def strip_marker(c: Column, marker: str = "*") -> Column:
    """Remove every occurrence of a literal marker character."""
    return F.translate(c, marker, "")


def rank_text(c: Column) -> Column:
    """Rank as text without its tie marker: ``10T`` gives ``10``."""
    return F.substring_index(c.cast("string"), "T", 1)


def season_label(year: Column) -> Column:
    """Closing year to season label: 2007 gives ``2006-07``, 2000 gives ``1999-00``."""
    year = year.cast("int")
    return F.concat((year - 1).cast("string"), F.lit("-"), F.substring(year.cast("string"), 3, 2))
