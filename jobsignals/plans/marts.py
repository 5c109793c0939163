"""Occupation dimension, the three facts, and the reports drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignals.functions.values import ratio
from jobsignals.operators.aggregates import (
    discrete_medians,
    flag_counts,
    item_mentions,
    merge_mentions,
    sorted_names,
    with_rates,
)
from jobsignals.operators.ranking import first_value_by, top_k_per_group

# Lists with a membership flag, suppression limits, unit-group digits.
LISTS = ("MLTSSL", "STSOL", "CSOL")
MIN_BARRIER_JOBS = 5
MIN_SKILL_MENTIONS = 3
UNIT_GROUP_DIGITS = 4

# When a posting counts for a flag, as SQL; columns are made when a plan is built.
SUPPLY_FLAGS = {
    "sponsorship_yes_count": "sponsorship_signal = 'explicit_yes'",
    "sponsorship_no_count": "sponsorship_signal = 'explicit_no'",
    "remote_count": "remote_friendly = 'remote'",
    "hybrid_count": "remote_friendly = 'hybrid'",
    "onsite_count": "remote_friendly = 'onsite'",
    "local_experience_count": "local_experience_required",
}
BARRIER_FLAGS = {n: SUPPLY_FLAGS[n] for n in ("local_experience_count", "sponsorship_yes_count", "sponsorship_no_count")}
JOB_COUNTS = ["jobs_count_30d", *SUPPLY_FLAGS]


def _flags(expressions: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(e) for name, e in expressions.items()}


def occupation_dim(lists: DataFrame, patterns: DataFrame) -> DataFrame:
    """One row per code known to the lists or the patterns.

    Both inputs are stacked and grouped once: list rows give membership, pattern rows give the
    name of the best-ranked pattern. When the names disagree the smaller one is taken.
    """
    listed = F.col("anzsco_code").isNotNull()
    from_lists = lists.select(
        "anzsco_code",
        F.col("occupation_name").alias("list_title"),
        F.when(listed, F.col("list_name")).alias("list_name"),
        F.when(listed, F.col("effective_date")).alias("effective_date"),
    )
    from_patterns = patterns.select(
        "anzsco_code",
        F.struct(
            F.col("occupation_name").alias("title"), "priority", F.col("title_pattern").alias("pattern")
        ).alias("named"),
    )
    stacked = from_lists.unionByName(from_patterns, allowMissingColumns=True)
    rank = [F.col("named.priority"), F.col("named.pattern")]
    pattern_title = first_value_by(F.col("named.title"), [F.col("named").isNull(), *rank])
    return (
        stacked.groupBy("anzsco_code")
        .agg(
            F.least(F.min("list_title"), pattern_title).alias("occupation_name"),
            *[
                F.coalesce(F.bool_or(F.col("list_name") == n), F.lit(False)).alias(f"is_{n.lower()}")
                for n in LISTS
            ],
            sorted_names(F.col("list_name")).alias("list_membership"),
            F.max("effective_date").alias("effective_date"),
        )
    )


def supply_states(mapped: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts per occupation and salary: what ``supply_demand`` needs of the postings, and what adds
    up over any parts of them. Postings without a code are left out."""
    coded = mapped.where(F.col("anzsco_code").isNotNull())
    return flag_counts(coded, [*by, "anzsco_code", "salary_avg"], "jobs_count_30d", _flags(SUPPLY_FLAGS))


def barrier_states(mapped: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts per occupation and state, of postings that have both."""
    located = mapped.where(F.col("anzsco_code").isNotNull() & F.col("state").isNotNull())
    return flag_counts(located, [*by, "anzsco_code", "state"], "total_jobs", _flags(BARRIER_FLAGS))


def skill_states(mapped: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mentions per state, spelling and city, postings without an occupation code included."""
    return item_mentions(mapped, "state", "required_skills", "source_city", by)


def job_aggregates(states: DataFrame) -> DataFrame:
    """Counts and salaries per occupation from ``supply_states``; mean and median are those of the
    single postings, as each salary comes with the number of postings that have it."""
    paid = F.col("salary_avg").isNotNull()
    counted = states.groupBy("anzsco_code").agg(
        *(F.sum(n).alias(n) for n in JOB_COUNTS),
        ratio(F.sum(F.col("salary_avg") * F.col("jobs_count_30d")), F.sum(F.when(paid, F.col("jobs_count_30d")))).alias("avg_salary"),
    )
    medians = discrete_medians(states, ["anzsco_code"], "salary_avg", "median_salary", "jobs_count_30d")
    return counted.join(medians, "anzsco_code", "left")


def supply_demand(
    mapped: DataFrame, dim: DataFrame, ceilings: DataFrame, unit_digits: int = UNIT_GROUP_DIGITS
) -> DataFrame:
    """Advertised jobs against ceilings and grants, one row per occupation (zero jobs included).

    Several occupations can share one unit group and so one ceiling: do not add ceilings up.
    """
    return supply_demand_of(supply_states(mapped), dim, ceilings, unit_digits)


def supply_demand_of(
    states: DataFrame, dim: DataFrame, ceilings: DataFrame, unit_digits: int = UNIT_GROUP_DIGITS
) -> DataFrame:
    """``supply_demand`` from ``supply_states``."""
    counts = JOB_COUNTS
    groups = ceilings.select(
        "anzsco_unit_group",
        "unit_group_name",
        "tier",
        "annual_ceiling",
        "grants_py24_25",
        "remaining_py25_26",
        F.col("program_year").alias("ceiling_program_year"),
    )
    joined = (
        dim.join(job_aggregates(states), "anzsco_code", "left")
        .na.fill(0, counts)
        .withColumn("anzsco_unit_group", F.substring("anzsco_code", 1, unit_digits))
        .join(groups, "anzsco_unit_group", "left")
    )
    return joined.select(
        "anzsco_code",
        "occupation_name",
        *[f"is_{n.lower()}" for n in LISTS],
        "list_membership",
        "anzsco_unit_group",
        "unit_group_name",
        "tier",
        *counts,
        "avg_salary",
        "median_salary",
        "annual_ceiling",
        "grants_py24_25",
        "remaining_py25_26",
        "ceiling_program_year",
        ratio(F.col("jobs_count_30d"), F.col("annual_ceiling")).alias("jobs_to_ceiling_ratio"),
        ratio(F.col("grants_py24_25"), F.col("jobs_count_30d")).alias("grants_to_jobs_ratio"),
    )


def experience_barrier(
    mapped: DataFrame, dim: DataFrame, min_jobs: int = MIN_BARRIER_JOBS
) -> DataFrame:
    """Shares of local-experience and sponsorship wording per occupation and state."""
    return experience_barrier_of(barrier_states(mapped), dim, min_jobs)


def experience_barrier_of(states: DataFrame, dim: DataFrame, min_jobs: int = MIN_BARRIER_JOBS) -> DataFrame:
    """``experience_barrier`` from ``barrier_states``."""
    counts = ["total_jobs", *BARRIER_FLAGS]
    merged = states.groupBy("anzsco_code", "state").agg(*(F.sum(n).alias(n) for n in counts))
    rates = with_rates(
        merged.where(F.col("total_jobs") >= min_jobs),
        "total_jobs",
        {
            "local_experience_pct": "local_experience_count",
            "sponsorship_yes_pct": "sponsorship_yes_count",
            "sponsorship_no_pct": "sponsorship_no_count",
        },
    )
    names = dim.select("anzsco_code", "occupation_name", "list_membership")
    return rates.join(names, "anzsco_code", "left").select(
        "anzsco_code",
        "occupation_name",
        "list_membership",
        "state",
        "total_jobs",
        "local_experience_count",
        "sponsorship_yes_count",
        "sponsorship_no_count",
        "local_experience_pct",
        "sponsorship_yes_pct",
        "sponsorship_no_pct",
    )


def skills_demand(mapped: DataFrame, min_mentions: int = MIN_SKILL_MENTIONS) -> DataFrame:
    """Mentions of every skill per state, postings without an occupation code included."""
    return skills_demand_of(skill_states(mapped), min_mentions)


def skills_demand_of(states: DataFrame, min_mentions: int = MIN_SKILL_MENTIONS) -> DataFrame:
    """``skills_demand`` from ``skill_states``."""
    return merge_mentions(states, "state", min_mentions=min_mentions)


def skills_top_k(skills: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most mentioned skills of every state."""
    order = [F.col("mention_count").desc(), F.col("skill")]
    return top_k_per_group(skills.select("state", "skill", "mention_count"), ["state"], order, k)


def occupation_barrier(q1: DataFrame) -> DataFrame:
    """Share of postings asking for local experience, per occupation with postings."""
    return q1.where(F.col("jobs_count_30d") > 0).select(
        "anzsco_code",
        "occupation_name",
        "jobs_count_30d",
        "local_experience_count",
        ratio(F.col("local_experience_count"), F.col("jobs_count_30d")).alias("local_experience_pct"),
    )


def top_supply(q1: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` occupations with most postings."""
    return (
        q1.where(F.col("jobs_count_30d") > 0)
        .orderBy(F.col("jobs_count_30d").desc(), "anzsco_code")
        .limit(n)
        .select(
            "anzsco_code",
            "occupation_name",
            "anzsco_unit_group",
            "list_membership",
            "jobs_count_30d",
            "annual_ceiling",
            "grants_py24_25",
            F.round("jobs_to_ceiling_ratio", 3).alias("jobs_to_ceiling_ratio"),
            F.round("grants_to_jobs_ratio", 3).alias("grants_to_jobs_ratio"),
        )
    )


def top_barriers(q2: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` largest occupation and state groups with their shares."""
    return (
        q2.orderBy(F.col("total_jobs").desc(), "anzsco_code", "state")
        .limit(n)
        .select(
            "anzsco_code",
            "state",
            "total_jobs",
            F.round("local_experience_pct", 3).alias("local_exp_pct"),
            F.round("sponsorship_yes_pct", 3).alias("sponsor_yes_pct"),
        )
    )


def dim_health(dim: DataFrame) -> DataFrame:
    """Codes, members per list and missing names."""
    return dim.agg(
        F.count(F.lit(1)).alias("total_anzsco_codes"),
        *[F.count_if(F.col(f"is_{n.lower()}")).alias(f"{n.lower()}_count") for n in LISTS],
        F.count_if(F.col("occupation_name").isNull()).alias("missing_name_count"),
    )
