from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from jobsignals.operators.quality import run_suite, suite_result
from jobsignals.plans.build import build
from jobsignals.plans.checks import all_checks, posting_fields
from jobsignals.plans.enrichment import mapping_coverage, pending_extraction, within_window
from jobsignals.plans.evaluation import evaluation_sample
from jobsignals.plans.marts import (
    dim_health,
    occupation_barrier,
    occupation_dim,
    skills_demand,
    skills_top_k,
    supply_demand,
    top_barriers,
    top_supply,
)
from jobsignals.plans.staging import staged_invitation_rounds, staged_occupation_lists, staged_postings
from jobsignals.operators.quality import fill_gate, source_verdict
from jobsignals.sources.seeds import bundled_seed, bundled_seeds
from postings_fixture import DAY, NEXT_DAY, extract, extract_frame, posting, raw_frame, raw_rows


@pytest.fixture(scope="module")
def layers(spark):
    return build(raw_frame(spark), extract_frame(spark), bundled_seeds(spark))


@pytest.fixture(scope="module")
def staged(layers):
    return {(r.job_id, r.snapshot_date): r for r in layers["staged_postings"].collect()}


def test_one_row_per_posting_and_day(staged):
    assert len(staged) == len(raw_rows()) - 1
    assert staged["1", DAY].source_city == "Brisbane"
    assert staged["1", NEXT_DAY].source_city == "Sydney"


def test_repeat_within_one_city_is_settled_by_time_then_link(spark):
    later = datetime(2026, 5, 6, 11, 0, 0)
    rows = [
        posting("1", redirect_url="a"),
        posting("1", ingested_at=later, redirect_url="c"),
        posting("1", ingested_at=later, redirect_url="b"),
    ]
    for order in (rows, rows[::-1]):
        assert staged_postings(raw_frame(spark, order)).first().redirect_url == "b"


def test_flattening(staged):
    assert staged["2", DAY].job_title is None and staged["2", DAY].company_name is None
    empty = staged["3", DAY]
    assert empty.description_text == "" and empty.country is None and empty.category_tag is None
    assert staged["4", DAY].country is None and staged["5", DAY].country == "Australia"
    assert staged["5", DAY].state is None and staged["1", DAY].suburb == "Ultimo"
    assert staged["7", DAY].description_text == "Hi there tester"
    assert staged["1", DAY].posted_date == date(2026, 5, 1)


def test_salary(staged):
    salaries = [staged[i, DAY].salary_avg for i in ("1", "4", "5", "6")]
    assert salaries == [150.0, 100.0, 200.0, None]


def test_enrichment_keeps_every_posting(layers, staged):
    rows = {(r.job_id, r.snapshot_date): r for r in layers["enriched_postings"].collect()}
    assert rows.keys() == staged.keys()
    assert rows["1", DAY].has_extraction and rows["1", DAY].skills_count == 2
    failed = rows["7", DAY]
    assert not failed.has_extraction and failed.skills_count == 0 and failed.sponsorship_signal is None
    assert rows["10", DAY].has_extraction and rows["10", DAY].skills_count == 0


def test_mapping(layers):
    codes = {(r.job_id, r.snapshot_date): r.anzsco_code for r in layers["mapped_postings"].collect()}
    assert codes["1", DAY] == "261313"
    assert codes["7", DAY] == "261314"  # equal priorities: the smaller code
    assert codes["8", DAY] == "262112"  # priority 1 before priority 2
    assert codes["9", DAY] is None and codes["3", DAY] is None
    assert "priority" not in layers["mapped_postings"].columns


def test_dimension(layers):
    dim = {r.anzsco_code: r for r in layers["occupation_dim"].collect()}
    assert len(dim) == 10
    assert dim["261313"].occupation_name == "Software Engineer"
    assert dim["261314"].is_stsol and dim["261314"].list_membership == "STSOL"
    assert dim["261111"].effective_date == date(2024, 7, 1)
    health = dim_health(layers["occupation_dim"]).first()
    assert tuple(health) == (10, 9, 1, 0, 0)


def test_dimension_with_several_lists_and_unlisted_codes(spark):
    lists = spark.createDataFrame(
        [("1", "B", " csol ", date(2024, 1, 1)), ("1", "A", "mltssl", date(2025, 1, 1)), ("2", " ", None, None), (None, "N", "CSOL", None)],
        "anzsco_code string, occupation_name string, list_name string, effective_date date",
    )
    patterns = spark.createDataFrame(
        [(2, "3", "late", "x"), (1, "3", "early", "y"), (1, "1", "0", "z")],
        "priority long, anzsco_code string, occupation_name string, title_pattern string",
    )
    dim = {r.anzsco_code: r for r in occupation_dim(staged_occupation_lists(lists), patterns).collect()}
    assert dim["1"].list_membership == "CSOL,MLTSSL" and dim["1"].is_csol and dim["1"].is_mltssl
    assert dim["1"].occupation_name == "0" and dim["1"].effective_date == date(2025, 1, 1)
    assert dim["2"].occupation_name is None and dim["2"].list_membership is None and not dim["2"].is_csol
    assert dim["3"].occupation_name == "early" and dim["3"].list_membership is None
    assert dim[None].list_membership is None and not dim[None].is_csol


def test_supply_demand(layers):
    q1 = {r.anzsco_code: r for r in layers["supply_demand"].collect()}
    assert len(q1) == 10
    engineer = q1["261313"]
    # 1 (two days), 4, 5, 6 and six in Victoria; 2 and 3 have no title, 7 to 10 map elsewhere.
    assert engineer.jobs_count_30d == 11
    assert engineer.sponsorship_yes_count == 7 and engineer.local_experience_count == 4
    salaries = sorted([150.0, 150.0, 100.0, 200.0, *map(float, range(6))])
    assert engineer.avg_salary == pytest.approx(sum(salaries) / len(salaries))
    assert engineer.median_salary == salaries[(len(salaries) - 1) // 2]
    assert engineer.annual_ceiling == 912 and engineer.jobs_to_ceiling_ratio == 11 / 912
    assert engineer.grants_to_jobs_ratio == 3800 / 11
    idle = q1["224711"]
    assert idle.jobs_count_30d == 0 and idle.avg_salary is None
    assert idle.jobs_to_ceiling_ratio == 0.0 and idle.grants_to_jobs_ratio is None
    assert q1["263213"].unit_group_name == "ICT Support and Test Engineers"
    assert q1["263213"].annual_ceiling is None and q1["263213"].jobs_to_ceiling_ratio is None
    barrier = {r.anzsco_code: r.local_experience_pct for r in occupation_barrier(layers["supply_demand"]).collect()}
    assert barrier["261313"] == 4 / 11 and "224711" not in barrier
    assert top_supply(layers["supply_demand"], 1).first().anzsco_code == "261313"


def test_zero_ceiling_gives_no_ratio(spark, layers):
    ceilings = bundled_seed(spark, "occupation_ceilings").withColumn("annual_ceiling", F.lit(0).cast("long"))
    q1 = supply_demand(layers["mapped_postings"], layers["occupation_dim"], ceilings)
    assert q1.where("jobs_to_ceiling_ratio IS NOT NULL").count() == 0


def test_experience_barrier_leaves_out_small_groups(layers):
    rows = layers["experience_barrier"].collect()
    assert [(r.anzsco_code, r.state, r.total_jobs) for r in rows] == [("261313", "Victoria", 6)]
    assert rows[0].local_experience_pct == 2 / 6 and rows[0].sponsorship_yes_pct == 5 / 6
    assert rows[0].list_membership == "MLTSSL"
    assert top_barriers(layers["experience_barrier"]).first().local_exp_pct == 0.333


def test_skills_demand_merges_spellings_and_counts_unmapped_titles(spark, layers):
    rows = {(r.state, r.skill): r for r in layers["skills_demand"].collect()}
    assert set(rows) == {("Victoria", "sql")}
    assert rows["Victoria", "sql"].mention_count == 5 and rows["Victoria", "sql"].cities_mentioned_in == 1
    assert rows["Victoria", "sql"].skill_display == "SQL "
    unmapped = layers["mapped_postings"].withColumn("anzsco_code", F.lit(None).cast("string"))
    assert skills_demand(unmapped).count() == 1
    everything = skills_demand(layers["mapped_postings"], min_mentions=1)
    top = skills_top_k(everything, 1)
    assert {(r.state, r.skill) for r in top.collect()} == {("Victoria", "sql"), ("New South Wales", "python")}


def test_coverage_of_the_mapping(layers):
    row = mapping_coverage(layers["mapped_postings"]).first()
    assert (row.total_jobs, row.mapped_jobs, row.unmapped_jobs) == (17, 13, 4)
    assert row.mapped_share == 13 / 17


def test_pending_retries_errors_and_skips_short_texts(layers, spark):
    todo = pending_extraction(layers["staged_postings"], extract_frame(spark))
    ids = {(r.job_id, r.snapshot_date) for r in todo.collect()}
    assert ("7", DAY) not in ids  # its text is shorter than 20 characters
    assert ("9", DAY) not in ids and ("3", DAY) not in ids
    assert ("2", DAY) in ids and ("v5", DAY) in ids and ("1", DAY) not in ids
    retried = pending_extraction(layers["staged_postings"], extract_frame(spark, [extract("10", status="error")]))
    assert ("10", DAY) in {(r.job_id, r.snapshot_date) for r in retried.collect()}
    none_done = extract_frame(spark).where("false")
    first = pending_extraction(layers["staged_postings"], none_done, sample_size=3).collect()
    assert [(r.job_id, r.snapshot_date) for r in first] == [("1", NEXT_DAY), ("1", DAY), ("10", DAY)]
    one_day = pending_extraction(layers["staged_postings"], none_done, snapshot_date=NEXT_DAY)
    assert [r.job_id for r in one_day.collect()] == ["1"]


def test_window(layers):
    mapped = layers["mapped_postings"]
    assert within_window(mapped).count() == 17
    assert within_window(mapped, NEXT_DAY).count() == 1
    assert within_window(mapped, NEXT_DAY, 1).count() == 1
    assert within_window(mapped, NEXT_DAY, 2).count() == 17
    with pytest.raises(ValueError):
        within_window(mapped, window_days=3)


def test_evaluation_sample(spark, layers):
    rows = evaluation_sample(layers["staged_postings"], extract_frame(spark)).collect()
    ids = [r.job_id for r in rows]
    assert "10" not in ids and "7" not in ids
    sizes = [len(r.required_skills) for r in rows]
    assert sizes == sorted(sizes, reverse=True)
    everything = evaluation_sample(layers["staged_postings"], extract_frame(spark), only_with_signal=False)
    assert "10" in [r.job_id for r in everything.collect()]
    assert evaluation_sample(layers["staged_postings"], extract_frame(spark), n=2).count() == 2


def test_invitation_rounds(spark):
    rows = staged_invitation_rounds(bundled_seed(spark, "eoi_invitations")).collect()
    assert len(rows) == 8 and all(r.anzsco_code is None for r in rows)
    assert {(r.round_year, r.round_month) for r in rows} == {(2025, 12), (2026, 1), (2026, 2), (2026, 3)}


def test_the_fifty_checks(layers):
    assert len(all_checks()) == 50
    report = run_suite(layers, all_checks())
    failed = {r.check_name for r in report.where("status = 'fail'").collect()}
    assert failed == {"coverage_enriched_postings_has_extraction"}
    assert report.count() == 50
    result = suite_result(report).first()
    assert (result.pass_count, result.warn_count, result.fail_count, result.suite_passed) == (49, 0, 1, False)


def test_source_gate(spark):
    raw = raw_frame(spark)
    rates = {r.field: r for r in fill_gate(raw, posting_fields()).collect()}
    total = len(raw_rows())
    assert rates["title"].fill_rate == (total - 1) / total and rates["title"].status == "LOW"
    assert rates["company"].fill_rate == (total - 1) / total  # blank but not empty counts as filled
    assert rates["salary_min"].status == "OK"
    assert source_verdict(raw, posting_fields()).first().verdict == "NO-GO"
    assert source_verdict(raw, posting_fields(), min_rows=5).first().verdict == "NEEDS-REVIEW"
    good = raw.where("id LIKE 'v%'")
    assert source_verdict(good, posting_fields(), min_rows=5).first().verdict == "GO"
    announced = source_verdict(good, posting_fields(), announced=F.lit(9999)).first()
    assert (announced.total_rows, announced.verdict) == (9999, "GO")
    assert source_verdict(raw, posting_fields(), min_rows=5, volume_only=True).first().verdict == "GO"
    nothing = raw.where("false")
    assert source_verdict(nothing, posting_fields()).first().verdict == "NO-GO"
    assert {r.fill_rate for r in fill_gate(nothing, posting_fields()).collect()} == {0.0}


def test_stored_build_and_refresh_of_one_day(spark, layers, tmp_path):
    seeds, path = bundled_seeds(spark), str(tmp_path)
    marts = ["supply_demand", "experience_barrier", "skills_demand", "occupation_dim"]

    def content(built, name):
        df = built[name]
        return sorted(str(sorted(r.asDict().items())) for r in df.collect())

    stored = build(raw_frame(spark), extract_frame(spark), seeds, storage=path)
    for name in [*marts, "enriched_postings"]:
        assert content(stored, name) == content(layers, name)

    rows = raw_rows() + [posting("late", day=NEXT_DAY, title="Web Developer")]
    extracts = [extract("late", NEXT_DAY), extract("1", NEXT_DAY, skills=["Rust"])]
    both = extract_frame(spark).where(F.col("snapshot_date") != NEXT_DAY).unionByName(extract_frame(spark, extracts))
    full = build(raw_frame(spark, rows), both, seeds)
    refreshed = build(raw_frame(spark, rows), both, seeds, storage=path, days=[NEXT_DAY])
    for name in [*marts, "enriched_postings"]:
        assert content(refreshed, name) == content(full, name)
    gone = raw_frame(spark, rows).where(F.col("snapshot_date") != NEXT_DAY)
    full = build(gone, both, seeds)
    refreshed = build(gone, both, seeds, storage=path, days=[NEXT_DAY])
    for name in [*marts, "enriched_postings", "staged_postings"]:
        assert content(refreshed, name) == content(full, name)
    with pytest.raises(ValueError):
        build(raw_frame(spark), extract_frame(spark), seeds, days=[DAY])


def test_marts_from_daily_states_equal_those_from_postings(spark, layers, tmp_path):
    stored = build(raw_frame(spark), extract_frame(spark), bundled_seeds(spark), storage=str(tmp_path))
    for name in ("supply_demand", "experience_barrier", "skills_demand"):
        columns = stored[name].columns
        assert sorted(map(str, stored[name].collect())) == sorted(map(str, layers[name].select(*columns).collect())), name


def test_a_refresh_reads_postings_of_its_days_only(spark, tmp_path):
    given = {"extracts": extract_frame(spark), "seeds": bundled_seeds(spark), "storage": str(tmp_path)}
    build(raw_frame(spark), **given)
    changed = raw_frame(spark).where((F.col("snapshot_date") != F.lit(NEXT_DAY)) | (F.col("source_city") != "Sydney"))
    more = raw_frame(spark, [posting("77", snapshot_date=NEXT_DAY, title="Software Engineer", salary_min=1.0, salary_max=1.0)])
    changed = changed.unionByName(more)
    # Files of the other day that no reader can open: the refresh must not need them.
    for name in ("staged_postings", "mapped_postings"):
        for file in (tmp_path / name / f"snapshot_date={DAY}").glob("*.parquet"):
            file.write_bytes(b"damaged")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    refreshed = build(changed, **given, days=[NEXT_DAY])
    full = build(changed, extract_frame(spark), bundled_seeds(spark))
    for name in ("supply_demand", "experience_barrier", "skills_demand"):
        columns = refreshed[name].columns
        assert sorted(map(str, refreshed[name].collect())) == sorted(map(str, full[name].select(*columns).collect())), name


def test_a_store_without_states_gets_them(spark, layers, tmp_path):
    import shutil

    given = {"extracts": extract_frame(spark), "seeds": bundled_seeds(spark), "storage": str(tmp_path)}
    build(raw_frame(spark), **given)
    for name in ("supply_states", "barrier_states", "skill_states"):
        shutil.rmtree(tmp_path / name)
    again = build(raw_frame(spark), **given, days=[DAY])
    columns = again["supply_demand"].columns
    assert sorted(map(str, again["supply_demand"].collect())) == sorted(map(str, layers["supply_demand"].select(*columns).collect()))
