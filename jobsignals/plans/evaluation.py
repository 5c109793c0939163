"""Choosing the postings whose extraction is judged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.functions.signals import SIGNAL_FIELDS, STATUS_OK
from jobsignals.functions.values import array_length
from jobsignals.plans.enrichment import JOB_KEY

# Words that make a description worth judging.
SIGNAL_WORDS = (
    "years|experience|sponsor|visa|remote|hybrid|wfh|python|sql|"
    "aws|gcp|azure|java|react|kubernetes|docker"
)
SAMPLE_SIZE = 50


def sample_order() -> list:
    """Most skills first, then the longest text; the key makes the order total."""
    return [
        array_length(F.col("required_skills")).desc(),
        F.length("description_text").desc(),
        F.col("job_id"),
        F.col("snapshot_date"),
    ]


def evaluation_sample(
    staged: DataFrame,
    extracts: DataFrame,
    n: int = SAMPLE_SIZE,
    only_with_signal: bool = True,
) -> DataFrame:
    """The ``n`` richest successful extractions with title and text."""
    texts = staged.where(F.col("description_text").isNotNull())
    if only_with_signal:
        texts = texts.where(F.lower("description_text").rlike(SIGNAL_WORDS))
    usable = extracts.where(F.col("extraction_status") == STATUS_OK)
    pairs = usable.select(*JOB_KEY, *SIGNAL_FIELDS).join(
        texts.select(*JOB_KEY, "job_title", "description_text"), JOB_KEY
    )
    return pairs.orderBy(*sample_order()).limit(n)
