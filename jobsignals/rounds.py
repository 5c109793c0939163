"""Work in rounds: each handles a bounded share of the rows and leaves no shuffle behind."""

from __future__ import annotations

import gc
from collections.abc import Hashable, Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Rows whose shuffles may lie on the disks at once: of postings with short texts about 2 GB.
ROUND_ROWS = 2**24


def plan_rounds[K: Hashable](per_day: Mapping[K, int], round_rows: int) -> list[tuple[list[K], int, int]]:
    """Rounds of about ``round_rows`` rows as (days, part, parts), newest days first: small days share
    a round, so that few partitions are rewritten twice, and a large one is cut into parts."""
    rounds, days, held = [], [], 0
    for day, n in sorted(per_day.items(), key=lambda x: x[0], reverse=True):
        if days and held + n > round_rows:
            rounds.append((days, 0, 1))
            days, held = [], 0
        parts = -(-n // round_rows)
        if parts > 1:
            rounds.extend(([day], part, parts) for part in range(parts))
        else:
            days, held = [*days, day], held + n
    return [*rounds, (days, 0, 1)] if days else rounds


def in_part(hashed: Column, part: int, parts: int) -> Column:
    """Whether a 64-bit hash lies in one of ``parts`` equal ranges; of sorted files a scan reads its pages only."""
    low, high = (-(2**63) + 2**64 * p // parts for p in (part, part + 1))
    found = F.lit(True)
    if part:
        found = found & (hashed >= F.lit(low))
    if part + 1 < parts:
        found = found & (hashed < F.lit(high))
    return found


def free_rounds(spark: SparkSession) -> None:
    """Between the rounds of an iteration: Spark removes the shuffles of finished rounds when the
    driver collects its garbage, which a small driver would else put off until its heap is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
