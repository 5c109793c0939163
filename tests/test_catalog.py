"""Views and tables that live in the catalog, limits over ranges, checks during writes."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from jobsignals.operators.joins import enrich, pending_rows
from jobsignals.operators.quality import WatchedWrites, run_suite
from jobsignals.operators.ranking import top_rows
from jobsignals.plans.build import build
from jobsignals.plans.checks import all_checks
from jobsignals.sources.seeds import bundled_seeds
from jobsignals.sources.tables import append_snapshot, catalog_inventory, materialise, publish_view
from postings_fixture import extract_frame, raw_frame


@pytest.fixture
def layer(spark):
    yield "marts_layer"
    spark.sql("DROP SCHEMA IF EXISTS marts_layer CASCADE")


def test_another_session_finds_a_published_view(spark, layer, tmp_path):
    append_snapshot(raw_frame(spark), str(tmp_path / "raw"))
    sql = f"SELECT source_city, count(*) AS n FROM parquet.`{tmp_path}/raw` GROUP BY source_city"
    comments = {"n": "the day's postings, \\ 'all' of them"}
    publish_view(spark, "per_city", sql, layer, comments, comment="postings by city")
    other = spark.newSession()
    view = other.table(f"{layer}.per_city")
    assert {r.source_city: r.n for r in view.collect()} == {r.source_city: r["count"] for r in raw_frame(spark).groupBy("source_city").count().collect()}
    assert view.schema["n"].metadata["comment"] == comments["n"]
    about = {r.col_name: r.data_type for r in other.sql(f"DESCRIBE TABLE EXTENDED {layer}.per_city").collect()}
    assert about["Type"] == "VIEW" and about["Comment"] == "postings by city"
    # What lands later shows; a second call replaces the view.
    append_snapshot(raw_frame(spark), str(tmp_path / "raw"))
    assert other.table(f"{layer}.per_city").agg(F.sum("n")).first()[0] == 2 * raw_frame(spark).count()
    assert publish_view(spark, "per_city", sql.replace("count(*)", "max(id)"), layer).columns == ["source_city", "n"]
    with pytest.raises(ValueError, match="does not have"):
        publish_view(spark, "per_city", sql, layer, {"x": "y"})
    with pytest.raises(ValueError, match="publish_view"):
        materialise(raw_frame(spark), "v", kind="view", layer=layer)


def shuffles(df) -> int:
    return plan_text(df).count("Exchange")


def test_bucketed_tables_join_without_a_shuffle(spark, layer):
    keys = ["job_id", "snapshot_date"]
    rows = spark.range(300).select(F.col("id").cast("string").alias("job_id"), F.lit(date(2026, 1, 1)).alias("snapshot_date"), F.concat(F.lit("a text that is long enough "), "id").alias("description_text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staged = materialise(rows, "staged", layer=layer, bucket_by=keys, buckets=4)
        known = materialise(rows.where("cast(job_id AS int) % 3 = 0").select(*keys, F.lit("ok").alias("status")), "extracts", layer=layer, bucket_by=keys, buckets=4)
        joined, pending = enrich(staged, known, keys, flag="has"), pending_rows(staged, known, keys, "description_text", 20)
        assert shuffles(joined) == 0 and shuffles(pending) == 0
        assert shuffles(enrich(rows, known, keys, flag="has")) > 0
        assert joined.where("has").count() == 100 and pending.count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    with pytest.raises(ValueError, match="catalog"):
        materialise(rows, "t", path="/nowhere", bucket_by=keys, buckets=4)


def test_inventory_from_statistics(spark, layer):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    materialise(rows, "counted", layer=layer, analyse=True)
    materialise(rows, "plain", layer=layer)
    found = {r.table_name: (r.row_count, r.size_bytes) for r in catalog_inventory(spark, [f"{layer}.counted", f"{layer}.plain"]).collect()}
    assert found[f"{layer}.counted"][0] == 1000 and found[f"{layer}.counted"][1] > 0
    assert found[f"{layer}.plain"] == (None, None)
    # The planner knows the rows: a dimension this small is broadcast, by its statistics.
    dim = spark.table(f"{layer}.counted")
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        assert "BroadcastHashJoin" in plan_text(rows.withColumnRenamed("id", "o").join(dim.where("id < 10"), F.col("o") == F.col("id")))
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")


@pytest.mark.parametrize("n", [0, 1, 99, 5_000, 9_999, 10_000, 20_000])
def test_limits_over_ranges(spark, n):
    rows = spark.range(10_000).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("day"), "id").repartition(5)
    order = [F.col("day").desc(), F.col("id")]
    many = top_rows(rows, order, n, limit_rows=50)
    expected = rows.orderBy(*order).limit(n) if n else rows
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, expected.collect()))
    if n > 50:
        assert "Limit" not in plan_text(many).replace("WindowGroupLimit", "") and "TakeOrdered" not in plan_text(many)


def test_checks_counted_by_the_writes(spark, tmp_path):
    raw = raw_frame(spark).withColumn("source_city", F.when(F.col("id") == "5", "Perth").otherwise(F.col("source_city")))
    watched = WatchedWrites(all_checks())
    layers = build(raw, extract_frame(spark), bundled_seeds(spark), storage=str(tmp_path), watched=watched)
    known = watched.failures()
    assert len(known) > 25 and sum(known.values()) > 0
    one = sorted(map(tuple, run_suite(layers, all_checks(), known).collect()))
    assert one == sorted(map(tuple, run_suite(layers, all_checks()).collect())) and len(one) == 50
    spared = [c for c in all_checks() if c not in known]
    assert {c.kind for c in spared if c.table == "supply_demand"} == {"unique", "relationship"}
