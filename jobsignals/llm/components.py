"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.llm.common import discard, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum((F.xxhash64("u", "v") / 1024).cast("long").cast("decimal(38,0)"))).first())


def _joined(links: DataFrame, least: DataFrame) -> DataFrame:
    """Links with their node's minimum. The hash as a second key gives both sides a shuffle for this
    join alone, so that AQE can split the links of a node that many others link to."""
    digest = F.xxhash64("u")
    return links.withColumn("digest", digest).join(least.withColumn("digest", digest), ["u", "digest"])


def roots(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that can be reached, for every node of ``edges`` (two long
    columns) that is not a root itself.

    Each round links neighbours to the smallest of them, first upwards, then downwards, so paths
    shrink by more than half. Minima are aggregated and joined back, no node's neighbours are
    gathered in one task; every round is a written table. Null ends are dropped.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    now = stored(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = stored(_joined(both, least).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large_star")
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = _joined(large, small_least).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, now = now, stored(moved.unionByName(small_least.select("u", F.col("m").alias("v"))).distinct(), "small_star")
        discard(last, large)
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
