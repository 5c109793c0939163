"""Postings with signals and occupation codes; the incremental extraction loop."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobsignals.functions.signals import MIN_DESCRIPTION_LENGTH, SIGNAL_FIELDS, STATUS_OK
from jobsignals.functions.values import array_length, ratio
from jobsignals.operators.calls import CallPolicy
from jobsignals.operators.extraction import extract_signals
from jobsignals.operators.joins import enrich, pending_rows
from jobsignals.operators.patterns import map_by_pattern
from jobsignals.operators.ranking import top_rows
from jobsignals.rounds import in_part, plan_rounds
from jobsignals.schemas import EXTRACT, optional
from jobsignals.session import scratch_path
from jobsignals.sources.files import remove
from jobsignals.sources.tables import append_snapshot, assert_unique, one_of, read_table, upsert_table

JOB_KEY = ["job_id", "snapshot_date"]

_POSTING_COLUMNS = [
    "source_city",
    "job_title",
    "company_name",
    "category_tag",
    "category_label",
    "location_display",
    "country",
    "state",
    "city",
    "suburb",
    "latitude",
    "longitude",
    "posted_at",
    "posted_date",
    "salary_min",
    "salary_max",
    "salary_avg",
    "salary_is_predicted",
    "contract_type",
    "contract_time",
]


def enriched_postings(staged: DataFrame, extracts: DataFrame) -> DataFrame:
    """Every staged posting with its signals, where an extraction succeeded.

    Both inputs are unique on the key, so the join neither multiplies nor drops postings, and the
    staged side is already partitioned by it.
    """
    usable = extracts.where(F.col("extraction_status") == STATUS_OK).select(
        *JOB_KEY,
        *SIGNAL_FIELDS,
        F.col("model_version").alias("extraction_model_version"),
        F.col("extracted_at").alias("extraction_extracted_at"),
    )
    return enrich(staged, usable, JOB_KEY, flag="has_extraction").select(
        *JOB_KEY,
        *_POSTING_COLUMNS,
        *SIGNAL_FIELDS,
        "has_extraction",
        array_length(F.col("required_skills")).alias("skills_count"),
        "description_text",
        "extraction_model_version",
        "extraction_extracted_at",
    )


def mapped_postings(enriched: DataFrame, patterns: DataFrame | Sequence[Mapping]) -> DataFrame:
    """Enriched postings with the occupation code their title stands for, NULL for none; pattern
    rows become one expression, a pattern table is joined."""
    return map_by_pattern(enriched, F.lower("job_title"), patterns)


def within_window(
    postings: DataFrame,
    snapshot_date: date | None = None,
    window_days: int | None = None,
) -> DataFrame:
    """Optional restriction to one snapshot, or to the days up to and including it.

    The marts count all snapshots together unless the caller narrows them here. The predicate is
    a literal on the partition column, so other partitions are not read.
    """
    if snapshot_date is None:
        if window_days is not None:
            raise ValueError("window_days needs snapshot_date, the last day of the window")
        return postings
    day = F.col("snapshot_date")
    last = F.lit(snapshot_date).cast("date")
    if window_days is None:
        return postings.where(day == last)
    return postings.where((day > F.date_sub(last, window_days)) & (day <= last))


def pending_extraction(
    staged: DataFrame,
    extracts: DataFrame,
    snapshot_date: date | None = None,
    sample_size: int = 0,
) -> DataFrame:
    """Postings to extract: no successful record yet, failed ones are tried again.

    ``sample_size`` > 0 takes the newest snapshots first, then the smallest job ids; 0 means all.
    """
    restrict = None if snapshot_date is None else F.col("snapshot_date") == F.lit(snapshot_date)
    todo = pending_rows(
        staged.select(*JOB_KEY, "description_text"),
        extracts.where(F.col("extraction_status") == STATUS_OK),
        JOB_KEY,
        "description_text",
        MIN_DESCRIPTION_LENGTH,
        restrict,
    )
    return top_rows(todo, [F.col("snapshot_date").desc(), F.col("job_id")], sample_size)


def mapping_coverage(mapped: DataFrame, code: str = "anzsco_code") -> DataFrame:
    """Mapped and unmapped postings and the mapped share."""
    counts = mapped.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.count(code).alias("mapped_jobs"),
    )
    return counts.select(
        "total_jobs",
        "mapped_jobs",
        (F.col("total_jobs") - F.col("mapped_jobs")).alias("unmapped_jobs"),
        ratio(F.col("mapped_jobs"), F.col("total_jobs")).alias("mapped_share"),
    )


# Rows that one committed round of extraction holds, about.
ROUND_ROWS = 100_000


def settle_answers(spark: SparkSession, table_path: str) -> None:
    """Merge the answers that rounds have left beside the extract table, if any, into it."""
    folder = answers_folder(table_path)
    answered = read_table(spark, folder, EXTRACT)
    if answered is not None:
        upsert_table(spark, table_path, answered, JOB_KEY)
        remove(spark, folder)


def answers_folder(table_path: str) -> str:
    """Where the answers of a day's rounds wait; readers of the table pass over such names."""
    return f"{table_path.rstrip('/')}/_answered/rows"


def run_extraction(
    staged: DataFrame,
    extractor: Callable[[str], dict | str],
    model: str,
    extracted_at: datetime,
    table_path: str,
    snapshot_date: date | None = None,
    sample_size: int = 0,
    parallelism: int | None = None,
    policy: CallPolicy = CallPolicy(),
    round_rows: int = ROUND_ROWS,
) -> DataFrame:
    """The whole loop: pending postings, extraction, upsert into the extract table at ``table_path``.

    Pending postings are stored once and worked off in rounds of about ``round_rows`` rows, and each
    round's answers are committed before the next round starts: a lost job repeats one round, since
    the next run finds the others no longer pending. Answers of a day that takes several rounds are
    kept beside the table and merged with its partition once, after its last round, after an error,
    or by the next run, so a day is rewritten once however many rounds it takes. Returns one row: rows
    sent to the extractor, ok_rows and error_rows. The extractor is called once per row: its answers
    are written before anything else reads them.
    """
    spark = staged.sparkSession
    settle_answers(spark, table_path)
    known = read_table(spark, table_path, optional(EXTRACT))
    if known is None:
        known = spark.createDataFrame([], optional(EXTRACT))
    pending = pending_extraction(staged, known, snapshot_date, sample_size)
    path = scratch_path(spark, "pending")
    rows = good = 0
    try:
        pending = pending.withColumn("_hash", F.xxhash64("job_id"))
        append_snapshot(pending, path, ["snapshot_date"], ["_hash"])
        stored = spark.read.schema(pending.schema).parquet(path)
        assert_unique(stored, JOB_KEY)
        per_day = {r.snapshot_date: r.n for r in stored.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n")).collect()}
        for days, part, parts in plan_rounds(per_day, round_rows):
            bucket = stored.where(one_of("snapshot_date", days) & in_part(F.col("_hash"), part, parts))
            records = extract_signals(bucket, extractor, model, extracted_at, parallelism=parallelism, policy=policy)
            seen = Observation("extraction")
            ok = F.count_if(F.col("extraction_status") == STATUS_OK).alias("ok_rows")
            records = records.observe(seen, F.count(F.lit(1)).alias("rows"), ok)
            if parts == 1:
                upsert_table(spark, table_path, records, JOB_KEY)
            else:
                records.write.mode("append").parquet(answers_folder(table_path))
                if part + 1 == parts:
                    settle_answers(spark, table_path)
            rows, good = rows + seen.get["rows"], good + seen.get["ok_rows"]
    except BaseException:
        settle_answers(spark, table_path)
        raise
    finally:
        remove(spark, path)
    return spark.createDataFrame([(rows, good, rows - good)], "rows long, ok_rows long, error_rows long")
