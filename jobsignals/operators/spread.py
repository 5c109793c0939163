"""Deal rows out to tasks that call something slow."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt evenly to ``partitions`` tasks, by default as many as the cluster runs at once.

    A repartition by number is left as it is by AQE, which joins small partitions otherwise, and a
    limit leaves one.
    """
    return df.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)
