"""Keep-first, top-k and ordered picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignals.session import scratch_path


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of every group.

    Catalyst turns the rank filter into a group limit on both sides of the shuffle, so a hot
    key sends at most ``k`` rows per map task instead of its whole group.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the one that sorts first. ``order`` should be total within a key."""
    return top_k_per_group(df, keys, order, 1)


def first_value_by(value: Column, order: Sequence[Column]) -> Column:
    """Aggregate: ``value`` of the row that sorts first (a partial aggregate, no window sort)."""
    return F.min_by(value, F.struct(*order))


# Rows that one task may put in order for a limit.
LIMIT_ROWS = 100_000


def top_rows(df: DataFrame, order: Sequence[Column], n: int, limit_rows: int = LIMIT_ROWS) -> DataFrame:
    """The ``n`` first rows; ``n = 0`` means all, unordered, so no global sort is paid for.

    A limit of up to ``limit_rows`` is Spark's own, which ends in one task. Beyond it rows are sorted
    by range into a scratch table; counts of the ranges tell in which one row n lies, so all earlier
    ranges stay whole, in their tasks, and only that one is cut.
    """
    if not n or n <= limit_rows:
        return df.orderBy(*order).limit(n) if n else df
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ranges")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    below = 0
    for part, size in sorted(map(tuple, stored.groupBy("_range").agg(F.count(F.lit(1))).collect())):
        if below + size > n:
            rank = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
            last = stored.where(F.col("_range") == part).withColumn("_rank", rank).where(F.col("_rank") <= n - below)
            return stored.where(F.col("_range") < part).select(*df.columns).unionByName(last.select(*df.columns))
        below += size
    return stored.select(*df.columns)
