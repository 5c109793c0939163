from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from jobsignals.operators.extraction import DEFAULT_SKILLS, extract_signals, normalise_payload, rule_signals


def check(spark, payload):
    text = payload if payload is None or isinstance(payload, str) else json.dumps(payload)
    df = spark.createDataFrame([(text,)], "payload string")
    return normalise_payload(df, "payload").first()


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("fully remote", "remote"),
        ("WFH", "remote"),
        ("remote", "remote"),
        (" Work From Home ", "remote"),
        ("on-site", "onsite"),
        ("hybrid working", "hybrid"),
        ("not specified", "unspecified"),
    ],
)
def test_work_mode_spellings(spark, raw, expected):
    row = check(spark, {"remote_friendly": raw})
    assert (row.extraction_status, row.remote_friendly) == ("ok", expected)


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("yes", "explicit_yes"), ("available", "explicit_yes"), ("no", "explicit_no"), ("n/a", "unspecified")],
)
def test_sponsorship_spellings(spark, raw, expected):
    assert check(spark, {"sponsorship_signal": raw}).sponsorship_signal == expected


def test_defaults(spark):
    row = check(spark, {})
    assert row.extraction_status == "ok" and row.error_message is None
    assert row.required_skills == [] and row.years_experience is None
    assert row.local_experience_required is False
    assert row.sponsorship_signal == row.remote_friendly == "unspecified"


def test_skills_are_merged_after_the_length_check(spark):
    assert check(spark, {"required_skills": ["AWS", "aws", " Python ", "python", ""]}).required_skills == ["AWS", "Python"]
    assert check(spark, {"required_skills": ["a"] * 20}).required_skills == ["a"]
    assert check(spark, {"required_skills": ["a"] * 21}).extraction_status == "error"


@pytest.mark.parametrize("years", [0, 40, "5", " 7 ", "1_0", "6.0", 5.0, True, None, "+3", 1e1])
def test_years_accepted(spark, years):
    row = check(spark, {"years_experience": years})
    assert row.extraction_status == "ok"
    expected = None if years is None else int(float(str(years).replace("_", "").strip())) if not isinstance(years, bool) else 1
    assert row.years_experience == expected


@pytest.mark.parametrize("years", [99, -1, 41, 5.5, "five", "5.5", "", [], {}, "0x5", "1__0", 10**25])
def test_years_rejected(spark, years):
    row = check(spark, {"years_experience": years})
    assert row.extraction_status == "error"
    assert "years_experience" in row.error_message
    assert row.years_experience is None


@pytest.mark.parametrize("flag", [True, 1, 1.0, "true", "Yes", "ON", "t"])
def test_flag_true(spark, flag):
    assert check(spark, {"local_experience_required": flag}).local_experience_required is True


@pytest.mark.parametrize("flag", [2, "maybe", None, " true", 0.5, [], "nope"])
def test_flag_rejected(spark, flag):
    assert check(spark, {"local_experience_required": flag}).extraction_status == "error"


@pytest.mark.parametrize(
    "payload",
    [
        None,
        "junk",
        "[1]",
        "null",
        '"text"',
        {"required_skills": None},
        {"required_skills": "Python"},
        {"required_skills": ["a", 1]},
        {"required_skills": ["a", None]},
        {"sponsorship_signal": None},
        {"sponsorship_signal": "perhaps"},
        {"remote_friendly": 1},
    ],
)
def test_rejected(spark, payload):
    row = check(spark, payload)
    assert row.extraction_status == "error" and row.error_message
    assert row.required_skills == [] and row.remote_friendly == "unspecified"


def test_unknown_fields_are_ignored_and_all_faults_named(spark):
    assert check(spark, {"extra": {"a": 1}}).extraction_status == "ok"
    row = check(spark, {"years_experience": 99, "remote_friendly": "mars"})
    assert row.error_message == "invalid fields: years_experience, remote_friendly"


def test_repeated_key_keeps_its_last_value(spark):
    assert check(spark, '{"years_experience": 99, "years_experience": 4}').years_experience == 4


def test_extractor_failures_become_rows(spark):
    def extractor(text):
        if text == "boom":
            raise ValueError("x" * 2000)
        if text == "junk":
            return "not json"
        return {"required_skills": [text]}

    day = date(2026, 5, 6)
    pending = spark.createDataFrame(
        [("1", day, "Go"), ("2", day, "boom"), ("3", day, "junk")],
        "job_id string, snapshot_date date, description_text string",
    )
    at = datetime(2026, 5, 9, 1, 2, 3)
    rows = {r.job_id: r for r in extract_signals(pending, extractor, "rules", at, parallelism=2).collect()}
    assert rows["1"].required_skills == ["Go"] and rows["1"].extraction_status == "ok"
    assert rows["1"].model_version == "rules@2026-05-09" and rows["1"].extracted_at == at
    assert rows["2"].extraction_status == "error" and len(rows["2"].error_message) == 500
    assert rows["3"].error_message == "payload is not a JSON object"


EXAMPLES = [
    (
        "Platform engineer wanted in Hobart, two teams. Hybrid: 2 days from home. Bring 4+ years of Terraform, "
        "Kubernetes and Linux, some Redis. Citizens or permanent residents, please.",
        (["Terraform", "Kubernetes", "Linux", "Redis"], 4, "explicit_no", False, "hybrid"),
    ),
    (
        "We offer visa sponsorship and work from anywhere. Your day: Kafka streams, Scala, a little BigQuery.",
        (["Kafka", "Scala", "BigQuery"], None, "explicit_yes", False, "remote"),
    ),
    (
        "Florist for our market stall. Flowers, early mornings, friendly regulars.",
        ([], None, "unspecified", False, "unspecified"),
    ),
    ("25 years in business, 60 years of history; 3+ years Python, 12 yrs SQL.", (["Python", "SQL"], 3, "unspecified", False, "unspecified")),
    (", ".join(DEFAULT_SKILLS[:30]), (DEFAULT_SKILLS[:30], None, "unspecified", False, "unspecified")),
    ("Local experience required, 3-5 yrs C++ and C#, JavaScript; on-site.", (["C++", "C#", "JavaScript"], 3, "unspecified", True, "onsite")),
    ("Training sponsorship offered. 60 years of history.", ([], None, "unspecified", False, "unspecified")),
]


@pytest.mark.parametrize(("text", "expected"), EXAMPLES)
def test_rule_signals(spark, text, expected):
    row = rule_signals(spark.createDataFrame([(text,)], "body string"), "body").first()
    assert (
        row.required_skills,
        row.years_experience,
        row.sponsorship_signal,
        row.local_experience_required,
        row.remote_friendly,
    ) == expected


def test_rule_signals_on_null_text(spark):
    df = spark.createDataFrame([(None,)], "body string")
    row = rule_signals(df, "body").first()
    assert row.required_skills == [] and row.remote_friendly == "unspecified"
    assert rule_signals(df, "body").where(F.col("years_experience").isNull()).count() == 1
