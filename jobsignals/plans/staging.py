"""Cleaned postings and reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.functions.text import blank_to_null, clean_html, tidy_upper
from jobsignals.functions.values import level, midpoint
from jobsignals.operators.ranking import keep_first


def staged_postings(raw: DataFrame) -> DataFrame:
    """One clean row per (job_id, snapshot_date).

    A posting found in several cities keeps the city that sorts first; within one city the latest
    ingestion wins, then the smaller link. The location fields, not the city, tell where the job is.
    Rows are reduced before any text is cleaned.
    """
    area = F.col("location.area")
    once = keep_first(
        raw,
        ["id", "snapshot_date"],
        [F.col("source_city"), F.col("ingested_at").desc(), F.col("redirect_url")],
    )
    return once.select(
        F.col("id").alias("job_id"),
        "snapshot_date",
        "ingested_at",
        "source_city",
        blank_to_null(F.col("title")).alias("job_title"),
        blank_to_null(F.col("company.display_name")).alias("company_name"),
        F.col("location.display_name").alias("location_display"),
        *[level(area, i).alias(n) for i, n in enumerate(["country", "state", "city", "suburb"])],
        F.col("category.tag").alias("category_tag"),
        F.col("category.label").alias("category_label"),
        F.col("created").cast("timestamp").alias("posted_at"),
        F.to_date("created").alias("posted_date"),
        "salary_min",
        "salary_max",
        midpoint(F.col("salary_min"), F.col("salary_max")).alias("salary_avg"),
        "salary_is_predicted",
        "contract_type",
        "contract_time",
        "latitude",
        "longitude",
        "redirect_url",
        "adref",
        clean_html(F.col("description")).alias("description_text"),
    )


def staged_occupation_lists(lists: DataFrame) -> DataFrame:
    """Occupation lists with tidy names and one flag per list."""
    tidy = lists.select(
        "anzsco_code",
        blank_to_null(F.col("occupation_name")).alias("occupation_name"),
        tidy_upper(F.col("list_name")).alias("list_name"),
        "effective_date",
    )
    return tidy.withColumns(
        {f"is_{name.lower()}": F.col("list_name") == name for name in ("MLTSSL", "STSOL", "CSOL")}
    )


def staged_invitation_rounds(rounds: DataFrame) -> DataFrame:
    """Invitation rounds with year and month of the round."""
    return rounds.select(
        "round_date",
        F.year("round_date").alias("round_year"),
        F.month("round_date").alias("round_month"),
        tidy_upper(F.col("visa_subclass")).alias("visa_subclass"),
        blank_to_null(F.col("anzsco_code")).alias("anzsco_code"),
        "points_cutoff",
        "invitations_issued",
    )
