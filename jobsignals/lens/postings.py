"""Postings derived from order lines, and the whole build run over them.

A line item is one sighting of a posting (its order) in a city; parts give titles, so several
sightings of one posting compete in the staging dedupe. Orders give the extraction records.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.lens.registry import query, sql_trim, sql_values, table
from jobsignals.operators.calls import CallPolicy
from jobsignals.operators.quality import Check, WatchedWrites, fill_gate, run_suite, source_verdict, suite_result
from jobsignals.operators.ranking import keep_first
from jobsignals.plans.build import build
from jobsignals.plans.checks import all_checks, posting_fields
from jobsignals.plans.enrichment import (
    enriched_postings,
    mapped_postings,
    mapping_coverage,
    pending_extraction,
    run_extraction,
    within_window,
)
from jobsignals.plans.evaluation import evaluation_sample
from jobsignals.plans.marts import (
    experience_barrier,
    occupation_barrier,
    occupation_dim,
    skills_demand,
    skills_top_k,
    supply_demand,
    top_barriers,
    top_supply,
)
from jobsignals.plans.staging import staged_occupation_lists, staged_postings
from jobsignals.rounds import ROUND_ROWS, in_part
from jobsignals.session import scratch_path
from jobsignals.sources.export import flat_sample
from jobsignals.sources.landing import ingest_summary, ingest_totals
from jobsignals.sources.tables import append_snapshot
from jobsignals.sources.seeds import bundled_rows, bundled_seed, bundled_seeds, title_pattern_rows

# Expressions that mean the same in Spark SQL and DuckDB.
FLAT_POSTING = {
    "snapshot_date": "CAST(date_trunc('quarter', o_orderdate) AS DATE)",
    "ingested_at": "l_shipdate",
    "source_city": "CASE l_returnflag WHEN 'A' THEN 'Melbourne' WHEN 'N' THEN 'Sydney' ELSE 'Brisbane' END",
    "id": "CAST(l_orderkey AS string)",
    "title": """CASE
        WHEN p_name LIKE '%anvil' AND p_type = 'PROMO' THEN '  '
        WHEN p_name LIKE '%anvil' AND p_type = 'ECONOMY' THEN NULL
        WHEN p_name LIKE '%anvil' THEN concat(' ', p_name, ' Cyber-Security and Data Engineer')
        WHEN p_name LIKE '%bolt' THEN concat(p_name, ' QA Lead / Test Analyst ')
        WHEN p_name LIKE '%gear' THEN concat(p_name, ' DevOps Engineer')
        WHEN p_name LIKE '%gizmo' THEN concat(p_name, ' Business Systems Analyst
')
        WHEN p_name LIKE '%plate' THEN concat(p_name, ' Registered Nurse')
        WHEN p_name LIKE '%ring' THEN concat(p_name, ' Software Engineer')
        WHEN p_name LIKE '%rod' THEN concat(p_name, ' Front-End Developer')
        ELSE concat(p_name, ' Data Analyst') END""",
    "description": """CASE
        WHEN l_linenumber = 7 THEN NULL
        WHEN l_linenumber = 6 THEN '<b>Apply now</b>'
        ELSE concat('<p class="intro">', p_name, ' position.</p>
<ul><li>', p_type, '</li></ul>', CASE l_returnflag
            WHEN 'A' THEN '  5+ years experience, fully remote, Python and SQL.'
            WHEN 'N' THEN ' Hybrid role; visa sponsorship is available.'
            ELSE ' Apply by post.' END) END""",
    "created": "l_shipdate",
    "redirect_url": """concat('https://jobs.example.com/', CAST(l_partkey AS string), '/',
        CAST(l_suppkey AS string), '/', CAST(l_linenumber AS string))""",
    "adref": "CAST(NULL AS string)",
    "salary_min": "CASE WHEN l_linenumber <= 4 THEN l_extendedprice END",
    "salary_max": "CASE WHEN l_linenumber BETWEEN 3 AND 6 THEN l_extendedprice * 1.25 END",
    "salary_is_predicted": "CASE WHEN l_tax > 0.04 THEN '1' ELSE '0' END",
    "contract_type": "CASE l_linestatus WHEN 'O' THEN 'permanent' ELSE 'contract' END",
    "contract_time": "CAST(NULL AS string)",
    "latitude": "l_discount",
    "longitude": "l_tax",
    "location_display": "CASE WHEN l_tax > 0 THEN concat('Place ', p_brand) END",
    "area_length": "CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN 0 WHEN 5 THEN 4 ELSE l_linenumber END",
    "area_state": """CASE WHEN p_size <= 10 THEN 'Victoria' WHEN p_size <= 20 THEN 'New South Wales'
        WHEN p_size <= 28 THEN 'Queensland' WHEN p_size <= 34 THEN 'Western Australia'
        WHEN p_size <= 39 THEN 'South Australia' WHEN p_size <= 43 THEN 'Tasmania'
        WHEN p_size <= 46 THEN 'Northern Territory' WHEN p_size <= 48 THEN 'Australian Capital Territory'
        ELSE 'Overseas' END""",
    "area_city": "p_brand",
    "area_suburb": "p_type",
    "company_name": "CASE WHEN l_discount = 0 THEN ' ' ELSE concat('Supplier ', CAST(l_suppkey AS string)) END",
    "category_tag": "lower(p_type)",
    "category_label": "concat(p_type, ' Jobs')",
}

EXTRACT = {
    "job_id": "CAST(o_orderkey AS string)",
    "snapshot_date": "CAST(date_trunc('quarter', o_orderdate) AS DATE)",
    "skills_kind": "o_orderpriority",
    "years_experience": "CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE CAST(floor(o_totalprice / 20000) AS bigint) END",
    "sponsorship_signal": "CASE o_orderstatus WHEN 'F' THEN 'explicit_yes' WHEN 'O' THEN 'explicit_no' ELSE 'unspecified' END",
    "local_experience_required": "o_totalprice > 400000",
    "remote_friendly": """CASE WHEN o_totalprice < 100000 THEN 'remote' WHEN o_totalprice < 200000 THEN 'hybrid'
        WHEN o_totalprice < 300000 THEN 'onsite' ELSE 'unspecified' END""",
    "model_version": "'rules@2026-01-01'",
    "extracted_at": "o_orderdate",
    "extraction_status": "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'error' ELSE 'ok' END",
    "error_message": "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'no answer' END",
}
# Orders without any extraction record yet.
NOT_EXTRACTED = "o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'"

SKILLS = {
    "1-URGENT": ["Python", "SQL", "AWS"],
    "2-HIGH": ["python ", "Docker"],
    "3-MEDIUM": [],
    "4-NOT SPECIFIED": ["Java", "  ", "sql", "Terraform"],
}


# Worked out on the smaller tables, before the order lines multiply their rows.
_FROM_PARTS = ["title", "area_state", "area_city", "area_suburb", "category_tag", "category_label"]
_FROM_ORDERS = ["snapshot_date"]


def _columns(expressions: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in expressions.items()]


def first_lines(lines: DataFrame, parts: DataFrame) -> DataFrame:
    """Of an order's lines the one whose sighting staging keeps, found before parts and orders make
    the rows wide: its order of preference needs the lines alone. A line whose part is missing is no
    sighting; such parts are looked for among the distinct keys first, and mostly there are none."""
    keys = lines.where(F.col("l_partkey").isNotNull()).select(F.col("l_partkey").alias("p_partkey")).distinct()
    lost = keys.join(parts.select("p_partkey"), "p_partkey", "left_anti")
    if lost.isEmpty():
        lines = lines.where(F.col("l_partkey").isNotNull())
    else:
        lines = lines.join(parts.select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi")
    city, ingested, link = (F.expr(FLAT_POSTING[n]) for n in ("source_city", "ingested_at", "redirect_url"))
    return keep_first(lines.where(F.col("l_orderkey").isNotNull()), ["l_orderkey"], [city, ingested.cast("timestamp").desc(), link])


def raw_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The raw postings as parts of about ``ROUND_ROWS`` order lines each, by a hash of the order, to be
    worked out one after the other."""
    parts = max(1, -(-table(spark, sf_dir, "lineitem").count() // ROUND_ROWS))
    return [raw_postings(spark, sf_dir, part=(i, parts)) for i in range(parts)]


def raw_postings(spark: SparkSession, sf_dir: str, once: bool = False, part: tuple[int, int] = (0, 1)) -> DataFrame:
    """Sightings in the nested raw shape; ``once`` leaves of each order the one that staging keeps,
    for queries that read staged postings only. ``part`` (place, number) leaves the orders of one part."""
    early = [*_FROM_PARTS, *_FROM_ORDERS]
    lines = table(spark, sf_dir, "lineitem").where(in_part(F.xxhash64("l_orderkey"), *part))
    if once:
        lines = first_lines(lines, table(spark, sf_dir, "part"))
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", *_columns({n: FLAT_POSTING[n] for n in _FROM_ORDERS})
    )
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_name", "p_type", "p_brand", *_columns({n: FLAT_POSTING[n] for n in _FROM_PARTS})
    )
    flat = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(*early, *_columns({n: e for n, e in FLAT_POSTING.items() if n not in early}))
    )
    area = F.slice(F.array(F.lit("Australia"), "area_state", "area_city", "area_suburb"), 1, F.col("area_length"))
    return flat.select(
        "snapshot_date",
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        "source_city",
        "id",
        "title",
        "description",
        F.col("created").cast("timestamp").alias("created"),
        "redirect_url",
        "adref",
        "salary_min",
        "salary_max",
        "salary_is_predicted",
        "contract_type",
        "contract_time",
        "latitude",
        "longitude",
        F.struct(F.col("location_display").alias("display_name"), area.alias("area")).alias("location"),
        F.struct(F.col("company_name").alias("display_name")).alias("company"),
        F.struct(F.col("category_tag").alias("tag"), F.col("category_label").alias("label")).alias("category"),
    )


def extract_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    skills = F.lit(None).cast("array<string>")
    for kind, names in SKILLS.items():
        words = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        skills = F.when(F.col("skills_kind") == kind, words).otherwise(skills)
    orders = table(spark, sf_dir, "orders").where(f"NOT ({NOT_EXTRACTED})")
    return (
        orders.selectExpr(*_columns(EXTRACT))
        .withColumn("required_skills", skills)
        .withColumn("extracted_at", F.col("extracted_at").cast("timestamp"))
        .drop("skills_kind")
    )


def stored_build(spark: SparkSession, sf_dir: str, label: str, watched: WatchedWrites | None = None) -> dict[str, DataFrame]:
    """Every layer, written to the shared folder and read back."""
    return build(
        raw_postings(spark, sf_dir, once=True),
        extract_records(spark, sf_dir),
        bundled_seeds(spark),
        storage=scratch_path(spark, label),
        title_patterns=title_pattern_rows(),
        watched=watched,
    )


def checked_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of all checks on a stored build; row checks are counted by its writes."""
    watched = WatchedWrites(all_checks())
    layers = stored_build(spark, sf_dir, "checked", watched)
    return run_suite(layers, all_checks(), watched.failures())


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_postings(raw_postings(spark, sf_dir, once=True))


def mapped(spark: SparkSession, sf_dir: str, patterns: DataFrame | None = None) -> DataFrame:
    enriched = enriched_postings(staged(spark, sf_dir), extract_records(spark, sf_dir))
    return mapped_postings(enriched, title_pattern_rows() if patterns is None else patterns)


def seed_dim(spark: SparkSession) -> DataFrame:
    lists = staged_occupation_lists(bundled_seed(spark, "occupation_lists"))
    return occupation_dim(lists, bundled_seed(spark, "anzsco_title_patterns"))


def q1(spark: SparkSession, sf_dir: str) -> DataFrame:
    ceilings = bundled_seed(spark, "occupation_ceilings")
    return supply_demand(mapped(spark, sf_dir), seed_dim(spark), ceilings)


def q2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experience_barrier(mapped(spark, sf_dir), seed_dim(spark))


def q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skills_demand(mapped(spark, sf_dir))


# --- oracle fragments -------------------------------------------------------------------------

_RAW = f"""raw AS (
  SELECT {", ".join(_columns(FLAT_POSTING))}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

_SKILLS = (
    "CASE o_orderpriority "
    + " ".join(
        f"WHEN '{kind}' THEN CAST([{', '.join(repr(n) for n in names)}] AS VARCHAR[])"
        for kind, names in SKILLS.items()
    )
    + " END"
)
_EXTRACTS = f"""extracts AS (
  SELECT {", ".join(_columns(EXTRACT))}, {_SKILLS} AS required_skills
  FROM orders WHERE NOT ({NOT_EXTRACTED}))"""

_CLEAN = sql_trim(
    "regexp_replace(regexp_replace(coalesce(description, ''), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')"
)
_STAGED = f"""staged AS (
  SELECT id AS job_id, snapshot_date, ingested_at, source_city,
    nullif({sql_trim("title")}, '') AS job_title,
    nullif({sql_trim("company_name")}, '') AS company_name,
    location_display,
    CASE WHEN area_length >= 1 THEN 'Australia' END AS country,
    CASE WHEN area_length >= 2 THEN area_state END AS state,
    CASE WHEN area_length >= 3 THEN area_city END AS city,
    CASE WHEN area_length >= 4 THEN area_suburb END AS suburb,
    category_tag, category_label,
    created AS posted_at, CAST(created AS DATE) AS posted_date,
    salary_min, salary_max,
    CASE WHEN salary_min IS NOT NULL AND salary_max IS NOT NULL THEN (salary_min + salary_max) / 2
         WHEN salary_min IS NOT NULL THEN salary_min ELSE salary_max END AS salary_avg,
    salary_is_predicted, contract_type, contract_time, latitude, longitude, redirect_url, adref,
    {_CLEAN} AS description_text
  FROM raw
  QUALIFY row_number() OVER (
    PARTITION BY id, snapshot_date ORDER BY source_city, ingested_at DESC, redirect_url) = 1)"""

_ENRICHED = """enriched AS (
  SELECT s.*, e.required_skills, e.years_experience, e.sponsorship_signal, e.local_experience_required,
    e.remote_friendly, e.job_id IS NOT NULL AS has_extraction,
    CAST(coalesce(len(e.required_skills), 0) AS INTEGER) AS skills_count,
    e.model_version AS extraction_model_version, e.extracted_at AS extraction_extracted_at
  FROM staged s LEFT JOIN (SELECT * FROM extracts WHERE extraction_status = 'ok') e
    ON e.job_id = s.job_id AND e.snapshot_date = s.snapshot_date)"""

_SEED_TYPES = {
    "anzsco_title_patterns": {
        "priority": "BIGINT",
        "anzsco_code": "VARCHAR",
        "occupation_name": "VARCHAR",
        "title_pattern": "VARCHAR",
    },
    "occupation_lists": {
        "anzsco_code": "VARCHAR",
        "occupation_name": "VARCHAR",
        "list_name": "VARCHAR",
        "effective_date": "DATE",
    },
    "eoi_invitations": {
        "round_date": "DATE",
        "visa_subclass": "VARCHAR",
        "anzsco_code": "VARCHAR",
        "points_cutoff": "BIGINT",
        "invitations_issued": "BIGINT",
    },
    "occupation_ceilings": {
        "anzsco_unit_group": "VARCHAR",
        "unit_group_name": "VARCHAR",
        "tier": "BIGINT",
        "annual_ceiling": "BIGINT",
        "grants_py24_25": "BIGINT",
        "remaining_py25_26": "BIGINT",
        "program_year": "VARCHAR",
    },
}
_SEEDS = ",\n".join(
    f"{name} AS ({sql_values(bundled_rows(name), types)})" for name, types in _SEED_TYPES.items()
)

_MAPPED = """mapped AS (
  SELECT e.*, p.anzsco_code
  FROM enriched e LEFT JOIN anzsco_title_patterns p ON regexp_matches(lower(e.job_title), p.title_pattern)
  QUALIFY row_number() OVER (PARTITION BY e.job_id, e.snapshot_date
    ORDER BY p.priority NULLS LAST, p.anzsco_code, p.title_pattern) = 1)"""

_LISTS = f"""lists AS (
  SELECT anzsco_code, nullif({sql_trim("occupation_name")}, '') AS occupation_name,
    upper({sql_trim("list_name")}) AS list_name, effective_date
  FROM occupation_lists)"""

_DIM = """named AS (
  SELECT anzsco_code, occupation_name FROM lists
  UNION
  SELECT DISTINCT anzsco_code, first_value(occupation_name) OVER (
    PARTITION BY anzsco_code ORDER BY priority, title_pattern) FROM anzsco_title_patterns),
membership AS (
  SELECT anzsco_code, bool_or(list_name = 'MLTSSL') AS is_mltssl, bool_or(list_name = 'STSOL') AS is_stsol,
    bool_or(list_name = 'CSOL') AS is_csol, string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS list_membership,
    max(effective_date) AS effective_date
  FROM lists GROUP BY anzsco_code),
dim AS (
  SELECT n.anzsco_code, n.occupation_name, coalesce(is_mltssl, false) AS is_mltssl,
    coalesce(is_stsol, false) AS is_stsol, coalesce(is_csol, false) AS is_csol, list_membership, effective_date
  FROM (SELECT anzsco_code, min(occupation_name) AS occupation_name FROM named GROUP BY 1) n
  LEFT JOIN membership m ON m.anzsco_code = n.anzsco_code)"""

_Q1 = """jobs AS (
  SELECT anzsco_code, count(*) AS jobs_count_30d,
    count(*) FILTER (sponsorship_signal = 'explicit_yes') AS sponsorship_yes_count,
    count(*) FILTER (sponsorship_signal = 'explicit_no') AS sponsorship_no_count,
    count(*) FILTER (remote_friendly = 'remote') AS remote_count,
    count(*) FILTER (remote_friendly = 'hybrid') AS hybrid_count,
    count(*) FILTER (remote_friendly = 'onsite') AS onsite_count,
    count(*) FILTER (local_experience_required) AS local_experience_count,
    avg(salary_avg) AS avg_salary, quantile_disc(salary_avg, 0.5) AS median_salary
  FROM mapped WHERE anzsco_code IS NOT NULL GROUP BY anzsco_code),
q1 AS (
  SELECT d.anzsco_code, d.occupation_name, d.is_mltssl, d.is_stsol, d.is_csol, d.list_membership,
    substr(d.anzsco_code, 1, 4) AS anzsco_unit_group, c.unit_group_name, c.tier,
    coalesce(jobs_count_30d, 0) AS jobs_count_30d, coalesce(sponsorship_yes_count, 0) AS sponsorship_yes_count,
    coalesce(sponsorship_no_count, 0) AS sponsorship_no_count, coalesce(remote_count, 0) AS remote_count,
    coalesce(hybrid_count, 0) AS hybrid_count, coalesce(onsite_count, 0) AS onsite_count,
    coalesce(local_experience_count, 0) AS local_experience_count, avg_salary, median_salary,
    c.annual_ceiling, c.grants_py24_25, c.remaining_py25_26, c.program_year AS ceiling_program_year,
    coalesce(jobs_count_30d, 0) / nullif(c.annual_ceiling, 0) AS jobs_to_ceiling_ratio,
    c.grants_py24_25 / nullif(coalesce(jobs_count_30d, 0), 0) AS grants_to_jobs_ratio
  FROM dim d LEFT JOIN jobs j ON j.anzsco_code = d.anzsco_code
  LEFT JOIN occupation_ceilings c ON substr(d.anzsco_code, 1, 4) = c.anzsco_unit_group)"""

_Q2 = """q2 AS (
  SELECT a.anzsco_code, d.occupation_name, d.list_membership, a.state, total_jobs, local_experience_count,
    sponsorship_yes_count, sponsorship_no_count, local_experience_count / total_jobs AS local_experience_pct,
    sponsorship_yes_count / total_jobs AS sponsorship_yes_pct, sponsorship_no_count / total_jobs AS sponsorship_no_pct
  FROM (SELECT anzsco_code, state, count(*) AS total_jobs,
      count(*) FILTER (local_experience_required) AS local_experience_count,
      count(*) FILTER (sponsorship_signal = 'explicit_yes') AS sponsorship_yes_count,
      count(*) FILTER (sponsorship_signal = 'explicit_no') AS sponsorship_no_count
    FROM mapped WHERE anzsco_code IS NOT NULL AND state IS NOT NULL GROUP BY 1, 2) a
  LEFT JOIN dim d ON d.anzsco_code = a.anzsco_code
  WHERE total_jobs >= 5)"""

_Q3 = f"""q3 AS (
  SELECT state, lower({sql_trim("spelling")}) AS skill, min(spelling) AS skill_display,
    count(*) AS mention_count, count(DISTINCT source_city) AS cities_mentioned_in
  FROM (SELECT state, source_city, unnest(required_skills) AS spelling FROM mapped WHERE state IS NOT NULL)
  WHERE length({sql_trim("spelling")}) > 0
  GROUP BY 1, 2 HAVING count(*) >= 3)"""

_TO_STAGED = [_RAW, _STAGED]
_TO_MAPPED = [_RAW, _EXTRACTS, _STAGED, _ENRICHED, _SEEDS, _MAPPED]
_TO_Q1 = [*_TO_MAPPED, _LISTS, _DIM, _Q1]
_TO_Q2 = [*_TO_MAPPED, _LISTS, _DIM, _Q2]
_TO_Q3 = [*_TO_MAPPED, _Q3]
_TO_ALL = [*_TO_MAPPED, _LISTS, _DIM, _Q1, _Q2, _Q3]


def _sql(fragments: list[str], select: str) -> str:
    return "WITH " + ",\n".join(fragments) + "\n" + select


_POSTED = "CAST(posted_at AS VARCHAR) AS posted_at, CAST(ingested_at AS VARCHAR) AS ingested_at"


def _as_text(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


@query(
    "postings_staged",
    _sql(_TO_STAGED, f"SELECT * EXCLUDE (posted_at, ingested_at), {_POSTED} FROM staged"),
)
def _staged_query(spark, sf_dir):
    return staged(spark, sf_dir).withColumns(
        {c: _as_text(c) for c in ("posted_at", "ingested_at")}
    )


_ENRICHED_SELECT = """SELECT job_id, snapshot_date, source_city, job_title, company_name, category_tag,
  category_label, location_display, country, state, city, suburb, latitude, longitude, posted_date,
  salary_min, salary_max, salary_avg, salary_is_predicted, contract_type, contract_time,
  array_to_string(required_skills, '|') AS skills, years_experience, sponsorship_signal,
  local_experience_required, remote_friendly, has_extraction, skills_count, description_text,
  extraction_model_version"""


def _flat_enriched(df: DataFrame) -> DataFrame:
    return df.withColumn("skills", F.array_join("required_skills", "|")).drop(
        "required_skills", "posted_at", "extraction_extracted_at"
    )


@query(
    "postings_enriched",
    _sql([_RAW, _EXTRACTS, _STAGED, _ENRICHED], f"{_ENRICHED_SELECT} FROM enriched"),
)
def _enriched_query(spark, sf_dir):
    return _flat_enriched(
        enriched_postings(staged(spark, sf_dir), extract_records(spark, sf_dir))
    )


@query("postings_mapped", _sql(_TO_MAPPED, f"{_ENRICHED_SELECT}, anzsco_code FROM mapped"))
def _mapped_query(spark, sf_dir):
    return _flat_enriched(mapped(spark, sf_dir))


@query(
    "postings_mapped_join",
    _sql(_TO_MAPPED, "SELECT job_id, snapshot_date, job_title, anzsco_code FROM mapped"),
)
def _mapped_join(spark, sf_dir):
    table_of_patterns = bundled_seed(spark, "anzsco_title_patterns")
    return mapped(spark, sf_dir, table_of_patterns).select("job_id", "snapshot_date", "job_title", "anzsco_code")


_ROUNDED = "SELECT * REPLACE (round(avg_salary, 4) AS avg_salary) FROM q1"


def _rounded(q1: DataFrame) -> DataFrame:
    return q1.withColumn("avg_salary", F.round("avg_salary", 4))


@query("postings_supply_demand", _sql(_TO_Q1, _ROUNDED))
def _supply_demand(spark, sf_dir):
    return _rounded(q1(spark, sf_dir))


@query("postings_experience_barrier", _sql(_TO_Q2, "SELECT * FROM q2"))
def _experience_barrier(spark, sf_dir):
    return q2(spark, sf_dir)


@query("postings_skills_demand", _sql(_TO_Q3, "SELECT * FROM q3"))
def _skills_demand(spark, sf_dir):
    return q3(spark, sf_dir)


@query(
    "postings_marts_stored",
    _sql(
        _TO_ALL,
        """SELECT 'q1' AS mart, anzsco_code AS key1, list_membership AS key2, jobs_count_30d AS n,
          median_salary AS value1, jobs_to_ceiling_ratio AS value2, occupation_name AS name FROM q1
        UNION ALL SELECT 'q2', anzsco_code, state, total_jobs, local_experience_pct, sponsorship_yes_pct, occupation_name FROM q2
        UNION ALL SELECT 'q3', state, skill, mention_count, CAST(cities_mentioned_in AS DOUBLE), NULL, skill_display FROM q3""",
    ),
)
def _marts_stored(spark, sf_dir):
    """The written build: layers stored as tables and read back."""
    layers = stored_build(spark, sf_dir, "marts")

    names = ["key1", "key2", "n", "value1", "value2", "name"]

    def rows(mart, name, *columns):
        found = [F.lit(None).cast("double") if c is None else F.col(c) for c in columns]
        found[3] = found[3].cast("double")
        return layers[name].select(F.lit(mart).alias("mart"), *[c.alias(n) for c, n in zip(found, names)])

    q1_columns = ("anzsco_code", "list_membership", "jobs_count_30d", "median_salary", "jobs_to_ceiling_ratio", "occupation_name")
    q2_columns = ("anzsco_code", "state", "total_jobs", "local_experience_pct", "sponsorship_yes_pct", "occupation_name")
    q3_columns = ("state", "skill", "mention_count", "cities_mentioned_in", None, "skill_display")
    return (
        rows("q1", "supply_demand", *q1_columns)
        .unionByName(rows("q2", "experience_barrier", *q2_columns))
        .unionByName(rows("q3", "skills_demand", *q3_columns))
    )


_CHANGED_RAW = """raw AS (
  SELECT * REPLACE (CASE WHEN snapshot_date = DATE '1995-07-01' THEN 'Web Developer' ELSE title END AS title)
  FROM first_raw WHERE snapshot_date <> DATE '1995-04-01')"""


@query(
    "postings_refresh",
    _sql(
        [_RAW.replace("raw AS", "first_raw AS", 1), _CHANGED_RAW, *_TO_Q3[1:]],
        """SELECT 'postings' AS layer, CAST(snapshot_date AS VARCHAR) AS key1, anzsco_code AS key2, count(*) AS n FROM mapped GROUP BY ALL
        UNION ALL SELECT 'skills', state, skill, mention_count FROM q3""",
    ),
)
def _refresh(spark, sf_dir):
    """A written build, then a refresh of two days: one has other titles, one has no postings left."""
    storage, raw, extracts = scratch_path(spark, "refresh"), raw_postings(spark, sf_dir, once=True), extract_records(spark, sf_dir)
    given = {"extracts": extracts, "seeds": bundled_seeds(spark), "storage": storage, "title_patterns": title_pattern_rows()}
    build(raw, **given)
    changed = F.when(F.col("snapshot_date") == F.lit(date(1995, 7, 1)), F.lit("Web Developer")).otherwise(F.col("title"))
    now = raw.where(F.col("snapshot_date") != F.lit(date(1995, 4, 1))).withColumn("title", changed)
    layers = build(now, **given, days=[date(1995, 4, 1), date(1995, 7, 1)])
    postings = layers["mapped_postings"].groupBy(F.col("snapshot_date").cast("string").alias("key1"), F.col("anzsco_code").alias("key2"))
    skills = layers["skills_demand"].select(F.lit("skills").alias("layer"), F.col("state").alias("key1"), F.col("skill").alias("key2"), F.col("mention_count").alias("n"))
    return postings.agg(F.count(F.lit(1)).alias("n")).withColumn("layer", F.lit("postings")).unionByName(skills)


@query(
    "postings_top_supply",
    _sql(
        _TO_Q1,
        """SELECT anzsco_code, occupation_name, anzsco_unit_group, list_membership, jobs_count_30d, annual_ceiling,
        grants_py24_25, round(jobs_to_ceiling_ratio, 3) AS jobs_to_ceiling_ratio,
        round(grants_to_jobs_ratio, 3) AS grants_to_jobs_ratio
        FROM q1 WHERE jobs_count_30d > 0 ORDER BY jobs_count_30d DESC, anzsco_code LIMIT 10""",
    ),
)
def _top_supply(spark, sf_dir):
    return top_supply(q1(spark, sf_dir))


@query(
    "postings_top_barriers",
    _sql(
        _TO_Q2,
        """SELECT anzsco_code, state, total_jobs, round(local_experience_pct, 3) AS local_exp_pct,
        round(sponsorship_yes_pct, 3) AS sponsor_yes_pct
        FROM q2 ORDER BY total_jobs DESC, anzsco_code, state LIMIT 10""",
    ),
)
def _top_barriers(spark, sf_dir):
    return top_barriers(q2(spark, sf_dir))


@query(
    "postings_skills_top_k",
    _sql(
        _TO_Q3,
        """SELECT state, skill, mention_count FROM q3
        QUALIFY row_number() OVER (PARTITION BY state ORDER BY mention_count DESC, skill) <= 3""",
    ),
)
def _skills_top_k(spark, sf_dir):
    return skills_top_k(q3(spark, sf_dir))


@query(
    "postings_occupation_barrier",
    _sql(
        _TO_Q1,
        """SELECT anzsco_code, occupation_name, jobs_count_30d, local_experience_count,
        local_experience_count / jobs_count_30d AS local_experience_pct FROM q1 WHERE jobs_count_30d > 0""",
    ),
)
def _occupation_barrier(spark, sf_dir):
    return occupation_barrier(q1(spark, sf_dir))


@query(
    "postings_mapping_coverage",
    _sql(
        _TO_MAPPED,
        """SELECT count(*) AS total_jobs, count(anzsco_code) AS mapped_jobs,
        count(*) - count(anzsco_code) AS unmapped_jobs, count(anzsco_code) / count(*) AS mapped_share FROM mapped""",
    ),
)
def _mapping_coverage(spark, sf_dir):
    return mapping_coverage(mapped(spark, sf_dir))


@query(
    "postings_pending",
    _sql(
        [_RAW, _EXTRACTS, _STAGED],
        """SELECT s.job_id, s.snapshot_date, s.description_text FROM staged s
        LEFT JOIN extracts e ON e.job_id = s.job_id AND e.snapshot_date = s.snapshot_date
          AND e.extraction_status = 'ok'
        WHERE e.job_id IS NULL AND length(s.description_text) >= 20""",
    ),
)
def _pending(spark, sf_dir):
    return pending_extraction(staged(spark, sf_dir), extract_records(spark, sf_dir))


@query(
    "postings_pending_sample",
    _sql(
        [_RAW, _EXTRACTS, _STAGED],
        """SELECT s.job_id, s.snapshot_date, s.description_text FROM staged s
        LEFT JOIN extracts e ON e.job_id = s.job_id AND e.snapshot_date = s.snapshot_date
          AND e.extraction_status = 'ok'
        WHERE e.job_id IS NULL AND length(s.description_text) >= 20
        ORDER BY s.snapshot_date DESC, s.job_id LIMIT 25""",
    ),
)
def _pending_sample(spark, sf_dir):
    return pending_extraction(
        staged(spark, sf_dir), extract_records(spark, sf_dir), sample_size=25
    )


@query(
    "postings_window",
    _sql(
        _TO_MAPPED,
        """SELECT snapshot_date, count(*) AS total_jobs, count(anzsco_code) AS mapped_jobs FROM mapped
        WHERE snapshot_date > DATE '1998-01-01' - 365 AND snapshot_date <= DATE '1998-01-01'
        GROUP BY snapshot_date""",
    ),
)
def _window(spark, sf_dir):
    in_window = within_window(mapped(spark, sf_dir), date(1998, 1, 1), 365)
    return in_window.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("total_jobs"), F.count("anzsco_code").alias("mapped_jobs")
    )


@query(
    "postings_eval_sample",
    _sql(
        [_RAW, _EXTRACTS, _STAGED],
        """SELECT s.job_id, s.snapshot_date, s.job_title, s.description_text,
        array_to_string(e.required_skills, '|') AS skills, e.years_experience, e.sponsorship_signal,
        e.local_experience_required, e.remote_friendly
        FROM extracts e JOIN staged s ON e.job_id = s.job_id AND e.snapshot_date = s.snapshot_date
        WHERE e.extraction_status = 'ok' AND regexp_matches(lower(s.description_text),
          'years|experience|sponsor|visa|remote|hybrid|wfh|python|sql|aws|gcp|azure|java|react|kubernetes|docker')
        ORDER BY coalesce(len(e.required_skills), 0) DESC, length(s.description_text) DESC, s.job_id, s.snapshot_date
        LIMIT 50""",
    ),
)
def _eval_sample(spark, sf_dir):
    sample = evaluation_sample(staged(spark, sf_dir), extract_records(spark, sf_dir))
    return sample.withColumn("skills", F.array_join("required_skills", "|")).drop("required_skills")


@query(
    "flat_sample",
    _sql(
        [_RAW],
        f"""SELECT id, title, company_name AS company, location_display,
        CASE WHEN area_length >= 1 THEN 'Australia' END AS country,
        CASE WHEN area_length >= 2 THEN area_state END AS state,
        CASE WHEN area_length >= 3 THEN area_city END AS city,
        CASE WHEN area_length >= 4 THEN area_suburb END AS suburb,
        category_label AS category, salary_min, salary_max, CAST(created AS VARCHAR) AS created, redirect_url,
        substr({sql_trim("replace(coalesce(description, ''), chr(10), ' ')")}, 1, 240) AS description_snippet
        FROM raw""",
    ),
)
def _flat_sample(spark, sf_dir):
    return flat_sample(raw_postings(spark, sf_dir)).withColumn("created", _as_text("created"))


_FILLED = {
    "title": "title <> ''",
    "description": "description <> ''",
    "location": "location_display <> ''",
    "company": "company_name <> ''",
    "created": "created IS NOT NULL",
    "category": "category_label <> ''",
    "salary_min": "salary_min IS NOT NULL",
    "salary_max": "salary_max IS NOT NULL",
}
_TARGET = {
    "title": 1.0, "description": 0.95, "location": 0.95, "company": 0.8, "created": 1.0,
    "category": 0.8, "salary_min": 0.08, "salary_max": 0.08,
}


@query(
    "fill_rates",
    _sql(
        [_RAW],
        "SELECT *, CASE WHEN fill_rate < target THEN 'LOW' ELSE 'OK' END AS status FROM ("
        + " UNION ALL ".join(
            f"SELECT '{f}' AS field, count(*) AS row_count, count(*) FILTER ({p}) / count(*) AS fill_rate, "
            f"CAST({_TARGET[f]} AS DOUBLE) AS target FROM raw"
            for f, p in _FILLED.items()
        )
        + ")",
    ),
)
def _fill_rates(spark, sf_dir):
    return fill_gate(raw_postings(spark, sf_dir), posting_fields())


@query(
    "source_verdict",
    _sql(
        [
            _RAW,
            "rates AS (SELECT count(*) AS total_rows, "
            + ", ".join(f"count(*) FILTER ({p}) / count(*) AS r_{f}" for f, p in _FILLED.items())
            + " FROM raw)",
            """flags AS (SELECT total_rows, total_rows >= 1500 AS volume_ok,
            r_title >= 0.99 AND r_description >= 0.95 AND r_location >= 0.95 AND r_created >= 0.99 AS core_ok,
            greatest(r_salary_min, r_salary_max) >= 0.08 AS salary_ok FROM rates)""",
        ],
        """SELECT *, CASE WHEN volume_ok AND core_ok THEN 'GO' WHEN volume_ok THEN 'NEEDS-REVIEW'
        ELSE 'NO-GO' END AS verdict FROM flags""",
    ),
)
def _source_verdict(spark, sf_dir):
    return source_verdict(raw_postings(spark, sf_dir), posting_fields())


@query(
    "source_verdict_cities",
    _sql(
        [_RAW],
        f"""SELECT count(*) AS total_rows, count(*) >= 1500 AS volume_ok,
        count(*) FILTER ({_FILLED["title"]}) / count(*) >= 0.99
          AND count(*) FILTER ({_FILLED["description"]}) / count(*) >= 0.95
          AND count(*) FILTER ({_FILLED["location"]}) / count(*) >= 0.95
          AND count(*) FILTER ({_FILLED["created"]}) / count(*) >= 0.99 AS core_ok,
        greatest(count(salary_min), count(salary_max)) / count(*) >= 0.08 AS salary_ok,
        CASE WHEN count(*) >= 1500 THEN 'GO' ELSE 'NO-GO' END AS verdict
        FROM raw""",
    ),
)
def _source_verdict_cities(spark, sf_dir):
    """Several cities together: volume alone decides."""
    return source_verdict(raw_postings(spark, sf_dir), posting_fields(), volume_only=True)


@query(
    "ingest_totals",
    _sql(
        [_RAW],
        """SELECT count(*) AS cities, CAST(sum(n) AS BIGINT) AS fetched_rows, CAST(sum(kept) AS BIGINT) AS loaded_rows,
        bool_and(n = kept) AS ok FROM (
          SELECT source_city, count(*) AS n, count(*) FILTER (contract_type = 'permanent') AS kept FROM raw GROUP BY 1)""",
    ),
)
def _ingest_totals(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    return ingest_totals(ingest_summary(raw, raw.where("contract_type = 'permanent'")))


@query(
    "ingest_summary",
    _sql(
        [_RAW],
        """SELECT source_city, count(*) AS fetched_rows,
        count(*) FILTER (contract_type = 'permanent' OR source_city <> 'Sydney') AS loaded_rows,
        count(*) = count(*) FILTER (contract_type = 'permanent' OR source_city <> 'Sydney') AS ok
        FROM raw GROUP BY source_city""",
    ),
)
def _ingest_summary(spark, sf_dir):
    raw = raw_postings(spark, sf_dir)
    return ingest_summary(raw, raw.where("contract_type = 'permanent' OR source_city <> 'Sydney'"))


# --- the declared checks over the built layers -------------------------------------------------

_LAYERS = {
    "staged_postings": "staged",
    "staged_occupation_lists": "lists",
    "staged_invitation_rounds": "rounds",
    "enriched_postings": "enriched",
    "mapped_postings": "mapped",
    "occupation_dim": "dim",
    "supply_demand": "q1",
    "experience_barrier": "q2",
    "skills_demand": "q3",
}
_ROUNDS = f"""rounds AS (SELECT round_date, upper({sql_trim("visa_subclass")}) AS visa_subclass,
  nullif({sql_trim("anzsco_code")}, '') AS anzsco_code, invitations_issued FROM eoi_invitations)"""


def check_sql(check: Check, names: dict[str, str]) -> str:
    """DuckDB: number of failures of one check."""
    source, column = names[check.table], check.columns[0]
    where = {
        "not_null": f"{column} IS NULL",
        "accepted_values": f"{column} NOT IN ({', '.join(repr(v) for v in check.values)})",
        "expression": f"NOT ({check.expression})",
    }
    if check.kind in where:
        count = f"SELECT count(*) FROM {source} WHERE {where[check.kind]}"
    elif check.kind in ("unique", "unique_combination"):
        known = f"WHERE {column} IS NOT NULL" if check.kind == "unique" else ""
        keys = ", ".join(check.columns)
        count = f"SELECT count(*) FROM (SELECT 1 FROM {source} {known} GROUP BY {keys} HAVING count(*) > 1)"
    elif check.kind == "relationship":
        count = (
            f"SELECT count(*) FROM {source} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {names[check.parent]} p WHERE p.{check.parent_column} = c.{column})"
        )
    else:
        count = (
            f"SELECT count(*) FROM (SELECT count(*) FILTER ({column}) / nullif(count(*), 0) AS r FROM {source}) "
            f"WHERE r IS NULL OR r < {check.threshold}"
        )
    return (
        f"SELECT '{check.name}' AS check_name, '{check.table}' AS table_name, "
        f"'{check.severity}' AS severity, ({count}) AS failures"
    )


def report_sql(checks: list[Check], names: dict[str, str]) -> str:
    union = "\nUNION ALL ".join(check_sql(c, names) for c in checks)
    return (
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
        f"ELSE 'fail' END AS status FROM ({union})"
    )


@query("postings_checks", _sql([*_TO_ALL, _ROUNDS], report_sql(all_checks(), _LAYERS)))
def _checks(spark, sf_dir):
    return checked_build(spark, sf_dir)


@query(
    "postings_checks_result",
    _sql(
        [*_TO_ALL, _ROUNDS, f"report AS ({report_sql(all_checks(), _LAYERS)})"],
        """SELECT count(*) FILTER (status = 'pass') AS pass_count, count(*) FILTER (status = 'warn') AS warn_count,
        count(*) FILTER (status = 'fail') AS fail_count, count(*) FILTER (status = 'fail') = 0 AS suite_passed
        FROM report""",
    ),
)
def _checks_result(spark, sf_dir):
    return suite_result(checked_build(spark, sf_dir))


_TODO = """todo AS (
  SELECT s.job_id, s.snapshot_date, length(s.description_text) AS n FROM staged s
  LEFT JOIN extracts e ON e.job_id = s.job_id AND e.snapshot_date = s.snapshot_date AND e.extraction_status = 'ok'
  WHERE e.job_id IS NULL AND length(s.description_text) >= 20)"""


@query(
    "run_extraction",
    _sql(
        [_RAW, _EXTRACTS, _STAGED, _TODO],
        """SELECT job_id, snapshot_date, extraction_status FROM extracts e
          WHERE NOT EXISTS (SELECT 1 FROM todo t WHERE t.job_id = e.job_id AND t.snapshot_date = e.snapshot_date)
        UNION ALL SELECT job_id, snapshot_date, CASE WHEN n % 3 = 0 THEN 'error' ELSE 'ok' END FROM todo""",
    ),
)
def _run_extraction(spark, sf_dir):
    """The extract table after one run of the loop, in rounds, on the records that are there already."""
    path = scratch_path(spark, "extracts")
    append_snapshot(extract_records(spark, sf_dir), path, cluster_by=["remote_friendly"])
    waits = CallPolicy(first_wait=0.0)
    run_extraction(staged(spark, sf_dir), third_fails(), "lengths", datetime(2026, 1, 2), path, policy=waits, round_rows=20_000)
    return spark.read.parquet(path).select("job_id", "snapshot_date", "extraction_status")


def third_fails():
    def extract(text: str) -> dict:
        if len(text) % 3 == 0:
            raise TimeoutError("no answer")
        return {"years_experience": 1}

    return extract
