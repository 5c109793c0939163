"""Attach structured signals to postings: user extractor, payload contract, rule extractor."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignals.functions import signals as sig
from jobsignals.functions.text import dedupe_ignoring_case
from jobsignals.operators.calls import Caller, CallPolicy
from jobsignals.operators.spread import spread


def normalise_payload(df: DataFrame, payload: str, failure: str | None = None) -> DataFrame:
    """Check a JSON payload against the five-field contract.

    Adds the signal columns, ``extraction_status`` and ``error_message``. Missing fields take
    their defaults and unknown fields are ignored; any invalid field turns the row into an error
    row holding defaults. ``failure`` names a column with the message of a call that gave no
    payload at all.
    """
    skills, skills_ok = sig.read_skills()
    years, years_ok = sig.read_years()
    values = {
        "required_skills": (skills, F.array().cast("array<string>")),
        "years_experience": (years, F.lit(None).cast("long")),
        "sponsorship_signal": (F.col("_sponsorship"), F.lit("unspecified")),
        "local_experience_required": (F.col("_flag"), F.lit(False)),
        "remote_friendly": (F.col("_remote"), F.lit("unspecified")),
    }
    valid = {
        "required_skills": skills_ok,
        "years_experience": years_ok,
        "sponsorship_signal": F.col("_sponsorship").isin(sig.SPONSORSHIP_VALUES),
        "local_experience_required": F.col("_flag").isNotNull(),
        "remote_friendly": F.col("_remote").isin(sig.REMOTE_VALUES),
    }
    faulty = F.array_compact(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in valid.items()])
    )
    probes = sig.probe(F.col("_v"))
    derived = {
        "_years": sig.years_value(),
        "_flag": sig.flag_value(),
        "_sponsorship": sig.enum_value(
            F.col("_sponsorship_signal_kind"), F.col("_sponsorship_text"), sig.SPONSORSHIP_ALIASES
        ),
        "_remote": sig.enum_value(
            F.col("_remote_friendly_kind"), F.col("_remote_text"), sig.REMOTE_ALIASES
        ),
    }
    problem = F.when(~sig.root_is_object(), F.lit("payload is not a JSON object")).when(
        F.size("_faulty") > 0, F.concat(F.lit("invalid fields: "), F.array_join("_faulty", ", "))
    )
    if failure:
        problem = F.coalesce(F.col(failure), problem)
    ok = F.col("error_message").isNull()
    return (
        df.withColumn("_v", F.try_parse_json(F.col(payload)))
        .withColumns(probes)
        .withColumns(derived)
        .withColumn("_faulty", faulty)
        .withColumn("error_message", F.substring(problem, 1, sig.MAX_ERROR_LENGTH))
        .withColumns({n: F.when(ok, v).otherwise(default) for n, (v, default) in values.items()})
        .withColumn("extraction_status", F.when(ok, sig.STATUS_OK).otherwise(sig.STATUS_ERROR))
        .drop("_v", "_faulty", *probes, *derived)
    )


def as_payload(answer: dict | str) -> tuple[str | None, str | None]:
    """(JSON text, None) of an extractor's answer, or (None, message) if it has no JSON form."""
    try:
        return (answer if isinstance(answer, str) else json.dumps(answer)), None
    except (TypeError, ValueError) as exc:
        return None, repr(exc)


def extract_signals(
    pending: DataFrame,
    extractor: Callable[[str], dict | str],
    model: str,
    extracted_at: datetime,
    keys: Sequence[str] = ("job_id", "snapshot_date"),
    text: str = "description_text",
    parallelism: int | None = None,
    policy: CallPolicy = CallPolicy(),
) -> DataFrame:
    """Call a user extractor for every pending row, one extract record per input row.

    The extractor, a function or a coroutine function, returns a dict or JSON text. It runs inside
    ``mapInArrow`` in ``parallelism`` tasks (default: what the cluster runs at once), and each task
    keeps up to ``policy.in_flight`` calls open, so the two together bound the load on a service. Calls
    that fail for a passing reason are tried again by the policy; a call that raises for good becomes
    an error record. Write the result before using it twice: reading it again calls again.
    """
    rows = spread(pending.select(*keys, text), parallelism)

    def given(part: pa.RecordBatch) -> Iterator[tuple]:
        return ((body,) for body in part.column(part.num_columns - 1).to_pylist())

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Caller(extractor, policy) as caller:
            for part, outcomes in caller.outcomes_by_slice(batches, given):
                payloads, failures = [], []
                for answer, error in outcomes:
                    payload, failure = as_payload(answer) if error is None else (None, repr(error))
                    payloads.append(payload)
                    failures.append(failure)
                kept = [part.column(i) for i in range(len(keys))]
                found = [pa.array(payloads, pa.string()), pa.array(failures, pa.string())]
                yield pa.RecordBatch.from_arrays([*kept, *found], names=[*keys, "_payload", "_failure"])

    schema = T.StructType(
        [
            *[rows.schema[k] for k in keys],
            T.StructField("_payload", T.StringType()),
            T.StructField("_failure", T.StringType()),
        ]
    )
    checked = normalise_payload(rows.mapInArrow(call, schema), "_payload", "_failure")
    return checked.select(
        *keys,
        *sig.SIGNAL_FIELDS,
        F.lit(f"{model}@{extracted_at.date().isoformat()}").alias("model_version"),
        F.lit(extracted_at).alias("extracted_at"),
        "extraction_status",
        "error_message",
    )


# Tools, languages and platforms the offline rules look for; callers may pass their own list.
DEFAULT_SKILLS = [
    "Python", "SQL", "Java", "JavaScript", "TypeScript", "Scala", "Kotlin", "Golang", "Rust",
    "Ruby", "PHP", "C#", "C++", ".NET", "React", "Angular", "Vue", "Node.js", "Django", "Flask",
    "Spring Boot", "AWS", "Azure", "GCP", "Docker", "Kubernetes", "Terraform", "Ansible",
    "Jenkins", "Git", "Linux", "Kafka", "Spark", "Hadoop", "Airflow", "dbt", "Snowflake",
    "BigQuery", "Redshift", "Databricks", "PostgreSQL", "MySQL", "MongoDB", "Redis",
    "Elasticsearch", "Tableau", "Power BI", "Excel", "Salesforce", "SAP", "ServiceNow", "Jira",
]

YEARS_PATTERN = r"(?i)\b(\d{1,2})\s*(?:\+|(?:-|–|to)\s*\d{1,2}\s*\+?)?\s*(?:years?|yrs?)\b"
SPONSOR_YES = (
    r"(?i)\bvisa sponsorship (?:is |may be |can be )?(?:available|offered|provided|considered)"
    r"|\b(?:offer|offers|offering|provide|provides|welcome|welcomes) visa sponsorship"
    r"|\bsponsor (?:your |a |the )?visas?\b"
)
SPONSOR_NO = (
    r"(?i)\bno (?:visa )?sponsorship\b"
    r"|\bsponsorship (?:is )?(?:not|unavailable)\b"
    r"|\bcitizens? (?:or|and|/) ?(?:permanent residents?|pr)\b"
    r"|\bcitizen or permanent resident\b|\baustralian citizens?(?:hip)? (?:only|required)\b"
)
LOCAL_EXPERIENCE = (
    r"(?i)\b(?:australian|local|au) (?:work |working |industry )?(?:experience|work history)"
    r"(?: is)? (?:required|essential|preferred|necessary|mandatory)\b"
    r"|\bmust have (?:prior )?(?:australian|local) (?:work |working |industry )?experience\b"
)
REMOTE = r"(?i)\bfully[ -]remote\b|\b100% remote\b|\bwork from anywhere\b|\bremote (?:position|role|first)\b"
HYBRID = r"(?i)\bhybrid\b|\b\d days? (?:in (?:the )?office|from home)\b"
ONSITE = r"(?i)\bon-?site\b|\bin[ -]office\b|\boffice[ -]based\b"


def skill_pattern(skills: Sequence[str]) -> str:
    """One alternation over all skills, longest first, not inside another word."""
    escaped = [re.escape(s) for s in sorted(skills, key=lambda s: (-len(s), s))]
    return r"(?i)(?<![A-Za-z0-9_])(" + "|".join(escaped) + r")(?![A-Za-z0-9_+#])"


def find_skills(text: Column, skills: Sequence[str] = DEFAULT_SKILLS) -> Column:
    """All skills named in the text, in order of first mention; the contract rejects too many."""
    return dedupe_ignoring_case(F.regexp_extract_all(text, F.lit(skill_pattern(skills)), F.lit(1)))


def find_years(text: Column) -> Column:
    """Smallest number of all years requirements (lower end of a range) that the contract allows,
    NULL when none is stated."""
    found = F.regexp_extract_all(text, F.lit(YEARS_PATTERN), F.lit(1))
    years = F.transform(found, lambda y: y.try_cast("long"))
    return F.array_min(F.filter(years, lambda y: y.between(sig.MIN_YEARS, sig.MAX_YEARS)))


def _mentions(lowered: Column, *words: str) -> Column:
    """Cheap substring test that spares the pattern on texts without any of its key words."""
    found = lowered.contains(words[0])
    for word in words[1:]:
        found = found | lowered.contains(word)
    return found


def rule_signals(df: DataFrame, text: str, skills: Sequence[str] = DEFAULT_SKILLS) -> DataFrame:
    """Offline extractor: the five signals from plain rules, as column expressions only."""
    body = F.coalesce(F.col(text), F.lit(""))
    low = F.col("_low")
    refusal = _mentions(
        low, "citizen", "no sponsorship", "no visa sponsorship", "sponsorship not",
        "sponsorship is", "sponsorship unavailable",
    )
    return (
        df.withColumn("_low", F.lower(body))
        .withColumns(
            {
                "required_skills": find_skills(body, skills),
                "years_experience": F.when(_mentions(low, "year", "yr"), find_years(body)),
                "sponsorship_signal": F.when(refusal & body.rlike(SPONSOR_NO), "explicit_no")
                .when(_mentions(low, "visa") & body.rlike(SPONSOR_YES), "explicit_yes")
                .otherwise("unspecified"),
                "local_experience_required": _mentions(low, "experience", "work history")
                & body.rlike(LOCAL_EXPERIENCE),
                "remote_friendly": F.when(_mentions(low, "hybrid", "day") & body.rlike(HYBRID), "hybrid")
                .when(_mentions(low, "remote", "anywhere") & body.rlike(REMOTE), "remote")
                .when(_mentions(low, "site", "office") & body.rlike(ONSITE), "onsite")
                .otherwise("unspecified"),
            }
        )
        .drop("_low")
    )
