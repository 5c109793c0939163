"""Left enrichment and pending rows.

No join here carries a broadcast hint: Catalyst and AQE broadcast a side only when its known
size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffle it otherwise, and AQE splits
skewed partitions of the larger side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    right_filter: Column | None = None,
    flag: str = "has_match",
) -> DataFrame:
    """Left join on ``keys`` with a presence flag; ``right_filter`` applies before the join."""
    if right_filter is not None:
        right = right.where(right_filter)
    right = right.withColumn(flag, F.lit(True))
    return left.join(right, list(keys), "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def pending_rows(
    rows: DataFrame,
    done: DataFrame,
    keys: Sequence[str],
    text: str,
    min_length: int,
    restrict: Column | None = None,
) -> DataFrame:
    """Rows with a long enough text that ``done`` does not hold yet."""
    todo = rows.where(F.length(text) >= min_length)
    if restrict is not None:
        todo = todo.where(restrict)
    return todo.join(done.select(*keys), list(keys), "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL value has no parent."""
    known = parent.select(F.col(parent_column).alias(column)).where(F.col(column).isNotNull())
    return child.where(F.col(column).isNotNull()).join(known, column, "left_anti")
