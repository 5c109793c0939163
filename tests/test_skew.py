from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from jobsignals.operators.joins import enrich
from jobsignals.operators.patterns import map_by_pattern
from jobsignals.operators.ranking import keep_first
from jobsignals.plans.enrichment import enriched_postings
from jobsignals.plans.staging import staged_postings
from jobsignals.sources.tables import replace_partitions
from conftest import plan_text
from postings_fixture import extract_frame, raw_frame


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


SMALL_PARTS = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "128KB",
}


def executed(df) -> tuple[int, str]:
    rows = df.collect()
    return len(rows), df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split_in_the_enrichment_join(spark, settings):
    """A third of the left rows share one key."""
    settings(**SMALL_PARTS)
    left = spark.range(0, 300_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "sha2(CAST(id AS string), 256) AS body"
    )
    right = spark.range(0, 300_000, 1, 8).selectExpr("id AS k", "sha2(CAST(id AS string), 224) AS tag")
    rows, plan = executed(enrich(left, right, ["k"]))
    assert rows == 300_000
    assert "isSkewJoin=true" in plan or "skewed" in plan


def test_a_hot_title_is_split_when_codes_are_joined_back(spark, settings):
    settings(**SMALL_PARTS)
    jobs = spark.range(0, 200_000, 1, 8).selectExpr(
        "id",
        "sha2(CAST(id AS string), 256) AS body",
        "CASE WHEN id % 3 = 0 THEN 'web developer' WHEN id % 3 = 1 THEN NULL ELSE concat('role ', id) END AS title",
    )
    patterns = spark.createDataFrame(
        [(1, "a", "web.?dev"), (2, "b", "role .*7$")], "priority long, anzsco_code string, title_pattern string"
    )
    mapped = map_by_pattern(jobs, F.lower("title"), patterns)
    rows, plan = executed(mapped)
    assert rows == 200_000
    assert "skewed" in plan
    counts = {r.anzsco_code: r["count"] for r in mapped.groupBy("anzsco_code").count().collect()}
    assert counts["a"] == 66_667 and counts["b"] == jobs.where("title RLIKE 'role .*7$'").count()


def test_a_hot_key_sends_few_rows_through_the_dedupe(spark):
    df = spark.range(0, 90_000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id")
    first = keep_first(df, ["k"], [F.col("id")])
    assert first.count() == 60_001
    first.collect()
    plan = first._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in plan.toString()


def test_a_hot_day_is_written_as_several_files(spark, settings, tmp_path):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="256KB")
    df = spark.range(0, 120_000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN DATE '2026-01-01' ELSE date_add(DATE '2026-01-02', CAST(id % 20 AS int)) END AS snapshot_date",
        "sha2(CAST(id AS string), 256) AS body",
        "'x' AS source_city",
    )
    replace_partitions(df, str(tmp_path / "t"))
    files = list((tmp_path / "t" / "snapshot_date=2026-01-01").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 120_000


def test_enrichment_reuses_the_partitioning_of_the_dedupe(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_text(enriched_postings(staged_postings(raw_frame(spark)), extract_frame(spark)))
    assert plan.count("Exchange hashpartitioning") == 2  # one per input, none for the join
