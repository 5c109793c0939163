"""Small scalar expressions shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def level(path: Column, index: int) -> Column:
    """Element ``index`` (from 0) of an array, NULL beyond its end."""
    return F.get(path, F.lit(index))


def midpoint(low: Column, high: Column) -> Column:
    """Mean of both bounds, the one that is known, or NULL."""
    return F.coalesce((low + high) / 2, low, high)


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, NULL when ``whole`` is zero or NULL."""
    return F.try_divide(part, whole)


def share(predicate: Column) -> Column:
    """Aggregate: fraction of rows where ``predicate`` holds; NULL counts as not holding."""
    return F.avg(F.when(predicate, 1.0).otherwise(0.0))


def array_length(values: Column) -> Column:
    """Length of an array, 0 for NULL."""
    return F.coalesce(F.size(values), F.lit(0))


def is_filled(column: Column) -> Column:
    """A text that is neither NULL nor empty."""
    return column.isNotNull() & (column != "")
