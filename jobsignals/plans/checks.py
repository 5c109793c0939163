"""The data checks declared on the layers of a build, and the fields of the source gate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsignals.functions.signals import REMOTE_VALUES, SPONSORSHIP_VALUES
from jobsignals.functions.values import is_filled
from jobsignals.operators.quality import (
    Check,
    accepted_values,
    coverage,
    expression_is_true,
    not_null,
    relationship,
    unique,
    unique_combination,
)

# Accepted cities, states, lists and the coverage floor.
CITIES = ["Melbourne", "Sydney", "Brisbane"]
STATES = [
    "Victoria",
    "New South Wales",
    "Queensland",
    "Australian Capital Territory",
    "Tasmania",
    "South Australia",
    "Western Australia",
    "Northern Territory",
]
LIST_NAMES = ["MLTSSL", "STSOL", "CSOL"]
MIN_COVERAGE = 0.90


def staging_checks() -> list[Check]:
    jobs, lists, rounds = "staged_postings", "staged_occupation_lists", "staged_invitation_rounds"
    return [
        not_null(jobs, "job_id"),
        not_null(jobs, "snapshot_date"),
        accepted_values(jobs, "state", STATES, severity="warn"),
        not_null(jobs, "source_city"),
        accepted_values(jobs, "source_city", CITIES),
        expression_is_true(jobs, "salary_min", "salary_min >= 0 OR salary_min IS NULL"),
        unique_combination(jobs, "job_id", "snapshot_date"),
        unique(lists, "anzsco_code"),
        not_null(lists, "anzsco_code"),
        not_null(lists, "occupation_name"),
        not_null(lists, "list_name"),
        accepted_values(lists, "list_name", LIST_NAMES),
        not_null(rounds, "round_date"),
        not_null(rounds, "visa_subclass"),
        not_null(rounds, "invitations_issued"),
        expression_is_true(rounds, "invitations_issued", "invitations_issued >= 0"),
        unique_combination(rounds, "round_date", "visa_subclass", "anzsco_code"),
    ]


def enrichment_checks() -> list[Check]:
    jobs, mapped = "enriched_postings", "mapped_postings"
    return [
        not_null(jobs, "job_id"),
        not_null(jobs, "snapshot_date"),
        not_null(jobs, "source_city"),
        accepted_values(jobs, "source_city", CITIES),
        accepted_values(jobs, "state", STATES, severity="warn"),
        accepted_values(jobs, "sponsorship_signal", SPONSORSHIP_VALUES),
        accepted_values(jobs, "remote_friendly", REMOTE_VALUES),
        expression_is_true(
            jobs, "years_experience", "years_experience BETWEEN 0 AND 40 OR years_experience IS NULL"
        ),
        unique_combination(jobs, "job_id", "snapshot_date"),
        coverage(jobs, "has_extraction", MIN_COVERAGE),
        not_null(mapped, "job_id"),
        not_null(mapped, "snapshot_date"),
        unique_combination(mapped, "job_id", "snapshot_date"),
    ]


def mart_checks() -> list[Check]:
    dim, q1, q2, q3 = "occupation_dim", "supply_demand", "experience_barrier", "skills_demand"
    return [
        unique(dim, "anzsco_code"),
        not_null(dim, "anzsco_code"),
        not_null(dim, "occupation_name"),
        unique(q1, "anzsco_code"),
        not_null(q1, "anzsco_code"),
        relationship(q1, "anzsco_code", dim, "anzsco_code"),
        not_null(q1, "anzsco_unit_group"),
        not_null(q1, "jobs_count_30d"),
        expression_is_true(q1, "jobs_count_30d", "jobs_count_30d >= 0"),
        not_null(q2, "anzsco_code"),
        relationship(q2, "anzsco_code", dim, "anzsco_code"),
        not_null(q2, "state"),
        expression_is_true(q2, "total_jobs", "total_jobs >= 5"),
        expression_is_true(q2, "local_experience_pct", "local_experience_pct BETWEEN 0 AND 1"),
        expression_is_true(q2, "sponsorship_yes_pct", "sponsorship_yes_pct BETWEEN 0 AND 1"),
        unique_combination(q2, "anzsco_code", "state"),
        not_null(q3, "state"),
        not_null(q3, "skill"),
        expression_is_true(q3, "mention_count", "mention_count >= 3"),
        unique_combination(q3, "state", "skill"),
    ]


def all_checks() -> list[Check]:
    return [*staging_checks(), *enrichment_checks(), *mart_checks()]


def posting_fields() -> dict[str, Column]:
    """When a field of a raw posting counts as filled; a salary of zero is a salary."""
    return {
        "title": is_filled(F.col("title")),
        "description": is_filled(F.col("description")),
        "location": is_filled(F.col("location.display_name")),
        "company": is_filled(F.col("company.display_name")),
        "created": F.col("created").isNotNull(),
        "category": is_filled(F.col("category.label")),
        "salary_min": F.col("salary_min").isNotNull(),
        "salary_max": F.col("salary_max").isNotNull(),
    }
