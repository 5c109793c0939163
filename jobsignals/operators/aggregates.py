"""Group counts, rates, and counts over exploded arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignals.functions.text import utrim
from jobsignals.functions.values import ratio

# Buckets that a median is looked for in: of each power of e first, then twice of what is left.
LOG_BUCKETS, EVEN_BUCKETS, EVEN_ROUNDS = 512, 1 << 14, 2


def _log_bucket(value: Column) -> Column:
    """A whole number that never falls as the value grows; a bucket spans 0.2% of its values."""
    size = F.floor((F.ln(F.abs(value)) + 746) * LOG_BUCKETS)
    return F.when(value == 0, F.lit(0)).otherwise((F.signum(value) * size).cast("long"))


def _even_bucket(value: Column) -> Column:
    """The place of a value between the smallest and the largest one that are left."""
    share = F.try_divide(value - F.col("_low"), F.col("_high") - F.col("_low"))
    return F.coalesce(F.least(F.floor(share * EVEN_BUCKETS), F.lit(EVEN_BUCKETS - 1)), F.lit(0)).cast("long")


def _narrowed(values: DataFrame, keys: Sequence[str], column: str, bucket: Column) -> DataFrame:
    """Of counted values those in the bucket that holds the value of rank ``_rank`` (the middle one,
    in the first round), with the rank among them and their range."""
    values = values.withColumn("_bucket", bucket)
    group = Window.partitionBy(*keys)
    rank = F.min("_rank") if "_rank" in values.columns else F.lit(None).cast("long")
    buckets = values.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_in"), F.min(column).alias("_low"), F.max(column).alias("_high"), rank.alias("_rank"))
    buckets = buckets.withColumns({"_upto": F.sum("_in").over(group.orderBy("_bucket")), "_rank": F.coalesce("_rank", F.ceil(F.sum("_in").over(group) / 2))})
    held = buckets.where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_in") < F.col("_rank")))
    held = held.select(*keys, "_bucket", "_low", "_high", (F.col("_rank") - F.col("_upto") + F.col("_in")).alias("_rank"))
    left = values.drop("_rank", "_low", "_high").join(held, [*keys, "_bucket"]).drop("_bucket")
    # The next round reads what is left twice; behind an exchange Spark works it out once.
    return left.repartition(*keys, column)


def median_candidates(df: DataFrame, keys: Sequence[str], column: str, weight: str | None = None) -> DataFrame:
    """Counted values of every group among which its median has rank ``_rank``: at most 2^15 of them,
    as many doubles as lie in one of EVEN_BUCKETS^EVEN_ROUNDS parts of a bucket of 0.2%."""
    value, n = F.col(column), F.count(F.lit(1)) if weight is None else F.sum(weight)
    values = df.where(value.isNotNull() & ~F.isnan(value)).groupBy(*keys, column).agg(n.alias("_n"))
    values = _narrowed(values, keys, column, _log_bucket(value))
    for _ in range(EVEN_ROUNDS):
        values = _narrowed(values, keys, column, _even_bucket(value))
    return values


def discrete_medians(df: DataFrame, keys: Sequence[str], column: str, output: str, weight: str | None = None) -> DataFrame:
    """The exact median of every group as an actual value: the smallest one that at least half of
    the group's values do not exceed; ``weight`` names a column that says how often a row's value
    occurs. NULL and NaN count as no value; groups without values, or with a NULL key, have no row.

    Values are counted first, with map-side combine, so a hot group shrinks to its distinct values.
    Then rounds of counting buckets narrow each group down to the bucket that holds its median; only
    what the last one leaves, a bounded number for any data, is put in order. The rounds exchange
    counts of buckets, and read values where the first shuffle left them.
    """
    inside = median_candidates(df, keys, column, weight)
    reached = F.sum("_n").over(Window.partitionBy(*keys).orderBy(column)) >= F.col("_rank")
    return inside.withColumn("_reached", reached).where("_reached").groupBy(*keys).agg(F.min(column).alias(output))


def sorted_names(column: Column) -> Column:
    """Aggregate: distinct non-NULL values in order, joined by commas; NULL when there are none."""
    names = F.collect_set(column)
    return F.when(F.size(names) > 0, F.array_join(F.array_sort(names), ","))


def flag_counts(
    df: DataFrame, keys: Sequence[str], total: str, flags: Mapping[str, Column], *more: Column
) -> DataFrame:
    """Rows per group and, for every flag, the rows where it is true."""
    counts = [F.count_if(flag).alias(name) for name, flag in flags.items()]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(total), *counts, *more)


def with_rates(df: DataFrame, total: str, rates: Mapping[str, str]) -> DataFrame:
    """Add ``rate = count / total`` for every ``{rate: count}``."""
    return df.withColumns({rate: ratio(F.col(n), F.col(total)) for rate, n in rates.items()})


def group_rates(
    df: DataFrame,
    keys: Sequence[str],
    total: str,
    flags: Mapping[str, Column],
    rates: Mapping[str, str],
    min_rows: int = 0,
) -> DataFrame:
    """Flag counts and rates per group, small groups left out."""
    counted = flag_counts(df, keys, total, flags)
    return with_rates(counted.where(F.col(total) >= min_rows), total, rates)


def item_mentions(df: DataFrame, group: str, items: str, spread: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, group, spelling, spread, n): mentions of array elements as they are written, a state that
    adds up over any parts of the rows.

    A NULL or empty array counts nothing: the outer explode gives it a NULL that is filtered out,
    while the plain one would first evaluate the array again just to drop such rows. All texts are
    grouping keys and only counted, which stays a hash aggregate with map-side combine.
    """
    exploded = df.where(F.col(group).isNotNull()).select(
        *by, group, F.col(spread).alias("spread"), F.explode_outer(items).alias("spelling")
    )
    return exploded.groupBy(*by, group, "spelling", "spread").agg(F.count(F.lit(1)).alias("n"))


def merge_mentions(
    mentioned: DataFrame,
    group: str,
    item: str = "skill",
    display: str = "skill_display",
    mentions: str = "mention_count",
    spread_count: str = "cities_mentioned_in",
    min_mentions: int = 0,
) -> DataFrame:
    """Items per group from ``item_mentions``, normalised to lower case and trimmed: the smallest
    spelling and the distinct spread are taken from the counts, not from single mentions."""
    result = (
        mentioned.withColumn(item, F.lower(utrim(F.col("spelling"))))
        .groupBy(group, item)
        .agg(
            F.min("spelling").alias(display),
            F.sum("n").alias(mentions),
            F.count_distinct("spread").alias(spread_count),
        )
    )
    # Blank items leave together with rare ones: a filter on the item alone would be pushed below
    # the first aggregate and clean the text of every single mention.
    kept = F.when(F.length(item) > 0, F.col(mentions)) >= max(min_mentions, 1)
    return result.where(kept)


def item_counts(df: DataFrame, group: str, items: str, spread: str, min_mentions: int = 0, **names: str) -> DataFrame:
    """Mentions of every array element per group; ``names`` are those of ``merge_mentions``."""
    return merge_mentions(item_mentions(df, group, items, spread), group, min_mentions=min_mentions, **names)


def fill_rates(df: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    """One row per field: share of rows where its predicate holds, all fields in one pass."""
    if not fields:
        raise ValueError("no fields given")
    names = list(fields)
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(p).alias(f"_f{i}") for i, p in enumerate(fields.values())],
    )
    pairs = [
        F.struct(
            F.lit(name).alias("field"),
            F.col("_rows").alias("row_count"),
            F.coalesce(ratio(F.col(f"_f{i}"), F.col("_rows")), F.lit(0.0)).alias("fill_rate"),
        )
        for i, name in enumerate(names)
    ]
    return wide.select(F.inline(F.array(*pairs)))
