"""Twenty-odd raw postings that cover the awkward cases of every layer."""

from __future__ import annotations

from datetime import date, datetime

from jobsignals.schemas import EXTRACT, RAW_POSTING, optional

DAY, NEXT_DAY = date(2026, 5, 6), date(2026, 5, 7)
AT = datetime(2026, 5, 6, 10, 0, 0)


def posting(id, city="Sydney", day=DAY, title="Software Engineer", **more) -> dict:
    row = {
        "snapshot_date": day,
        "ingested_at": AT,
        "source_city": city,
        "id": id,
        "title": title,
        "description": "Build things with Python for a living.",
        "created": datetime(2026, 5, 1, 23, 30, 0),
        "redirect_url": f"https://jobs.example.com/{id}/{city}",
        "adref": None,
        "salary_min": 100.0,
        "salary_max": 200.0,
        "salary_is_predicted": "0",
        "contract_type": "permanent",
        "contract_time": None,
        "latitude": -33.8,
        "longitude": 151.2,
        "location": {"display_name": "Sydney", "area": ["Australia", "New South Wales", "Sydney", "Ultimo"]},
        "company": {"display_name": "Acme"},
        "category": {"tag": "it-jobs", "label": "IT Jobs"},
    }
    row.update(more)
    return row


def raw_rows() -> list[dict]:
    victoria = {"display_name": "Melbourne", "area": ["Australia", "Victoria"]}
    return [
        posting("1", "Sydney"),
        posting("1", "Brisbane", title="Software Engineer (Brisbane)"),
        posting("1", "Sydney", day=NEXT_DAY),
        posting("2", title=" \t ", company={"display_name": "  "}),
        posting("3", title=None, description=None, location=None, company=None, category=None),
        posting("4", salary_max=None, location={"display_name": "x", "area": []}),
        posting("5", salary_min=None, location={"display_name": "x", "area": ["Australia"]}),
        posting("6", salary_min=None, salary_max=None),
        posting("7", title="QA Lead / Test Analyst", description="<p>Hi\n<b>there</b></p>\t tester "),
        posting("8", title="Cyber-Security Data Engineer", location={"display_name": "x", "area": None}),
        posting("9", title="Nurse", description="1234567890123456789"),
        posting("10", title="Nurse", description="12345678901234567890"),
        *[posting(f"v{i}", "Melbourne", title="Platform Engineer", location=victoria, salary_min=float(i), salary_max=float(i)) for i in range(6)],
    ]


def extract(job_id, day=DAY, status="ok", skills=("Python", "SQL"), **more) -> dict:
    row = {
        "job_id": job_id,
        "snapshot_date": day,
        "required_skills": list(skills),
        "years_experience": 3,
        "sponsorship_signal": "explicit_yes",
        "local_experience_required": True,
        "remote_friendly": "remote",
        "model_version": "m@2026-05-06",
        "extracted_at": AT,
        "extraction_status": status,
        "error_message": None if status == "ok" else "no answer",
    }
    row.update(more)
    return row


def extract_rows() -> list[dict]:
    return [
        extract("1"),
        extract("1", NEXT_DAY, skills=[" python", "Go"]),
        extract("7", status="error", skills=[]),
        extract("10", skills=[], sponsorship_signal="explicit_no", local_experience_required=False),
        *[extract(f"v{i}", skills=["SQL " if i % 2 else "sql", " "], local_experience_required=i < 2) for i in range(5)],
    ]


def raw_frame(spark, rows=None):
    return spark.createDataFrame(rows or raw_rows(), optional(RAW_POSTING))


def extract_frame(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else extract_rows(), optional(EXTRACT))
