"""Each operator on the benchmark table whose shape is closest to postings."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.functions import signals as sig
from jobsignals.functions.text import blank_to_null, clean_html, dedupe_ignoring_case, snippet
from jobsignals.functions.values import array_length, level, midpoint
from jobsignals.lens.registry import query, sql_trim, sql_values, table
from jobsignals.operators.aggregates import group_rates, item_counts
from jobsignals.operators.evaluation import (
    failure_examples,
    judge,
    judge_accuracy,
    run_evaluation,
    verdict_tallies,
)
from jobsignals.operators.extraction import extract_signals, normalise_payload, rule_signals
from jobsignals.operators.joins import enrich, pending_rows
from jobsignals.operators.patterns import map_by_pattern
from jobsignals.operators.ranking import keep_first, top_k_per_group
from jobsignals.plans.enrichment import mapping_coverage
from jobsignals.plans.evaluation import evaluation_sample
from jobsignals.plans.marts import (
    dim_health,
    experience_barrier,
    occupation_barrier,
    occupation_dim,
    skills_top_k,
    supply_demand,
    top_barriers,
    top_supply,
)
from jobsignals.plans.staging import staged_invitation_rounds, staged_occupation_lists
from jobsignals.session import scratch_path

# --- projections ------------------------------------------------------------------------------


@query(
    "dedupe_first",
    """SELECT user_id, CAST(ts AS DATE) AS day, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_type, event_id) = 1""",
)
def _dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("day"), "event_id", "event_type", "value"
    )
    return keep_first(events, ["user_id", "day"], [F.col("event_type"), F.col("event_id")])


@query(
    "flatten_levels",
    """SELECT page_id, p[1] AS level0, p[2] AS level1, p[3] AS level2, p[4] AS level3, p[5] AS level4, p[6] AS level5
    FROM (SELECT page_id, string_split(url, '/') AS p FROM pages)""",
)
def _flatten_levels(spark, sf_dir):
    path = F.split("url", "/")
    return table(spark, sf_dir, "pages").select(
        "page_id", *[level(path, i).alias(f"level{i}") for i in range(6)]
    )


_PADDED_SEGMENT = """CASE c_mktsegment WHEN 'BUILDING' THEN '   ' WHEN 'FURNITURE' THEN concat(chr(9), c_mktsegment, chr(10))
    WHEN 'HOUSEHOLD' THEN NULL WHEN 'MACHINERY' THEN concat('  ', c_mktsegment, ' ') ELSE c_mktsegment END"""


@query(
    "blank_to_null",
    f"SELECT c_custkey, nullif({sql_trim(_PADDED_SEGMENT)}, '') AS segment FROM customer",
)
def _blank_to_null(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", blank_to_null(F.expr(_PADDED_SEGMENT)).alias("segment")
    )


_LOW = "CASE WHEN l_linenumber IN (1, 2, 3, 7) THEN l_extendedprice * (1 - l_discount) END"
_HIGH = "CASE WHEN l_linenumber IN (3, 4, 5, 7) THEN l_extendedprice END"


@query(
    "range_midpoint",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, low, high,
    CASE WHEN low IS NOT NULL AND high IS NOT NULL THEN (low + high) / 2
         WHEN low IS NOT NULL THEN low WHEN high IS NOT NULL THEN high END AS mid
    FROM (SELECT *, {_LOW} AS low, {_HIGH} AS high FROM lineitem)""",
)
def _range_midpoint(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", f"{_LOW} AS low", f"{_HIGH} AS high")
        .withColumn("mid", midpoint(F.col("low"), F.col("high")))
    )


@query(
    "utc_dates",
    f"""SELECT CAST(ts AS DATE) AS round_date, CAST(year(ts) AS INTEGER) AS round_year,
    CAST(month(ts) AS INTEGER) AS round_month, upper({sql_trim("concat(' ', event_type, chr(9))")}) AS visa_subclass,
    nullif({sql_trim("CASE event_type WHEN 'error' THEN ' ' ELSE props END")}, '') AS anzsco_code,
    user_id AS points_cutoff, event_id AS invitations_issued FROM events""",
)
def _utc_dates(spark, sf_dir):
    rounds = table(spark, sf_dir, "events").selectExpr(
        "to_date(ts) AS round_date",
        "concat(' ', event_type, chr(9)) AS visa_subclass",
        "CASE event_type WHEN 'error' THEN ' ' ELSE props END AS anzsco_code",
        "user_id AS points_cutoff",
        "event_id AS invitations_issued",
    )
    return staged_invitation_rounds(rounds)


@query(
    "clean_html",
    "SELECT page_id, "
    + sql_trim("regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')")
    + " AS body FROM pages",
)
def _clean_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", clean_html(F.col("html")).alias("body"))


_LIST_NAME = """CASE c_mktsegment WHEN 'BUILDING' THEN ' mltssl' WHEN 'FURNITURE' THEN 'Stsol ' WHEN 'HOUSEHOLD' THEN 'CSOL'
    WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END"""


@query(
    "list_flags",
    f"""SELECT anzsco_code, occupation_name, list_name, effective_date, list_name = 'MLTSSL' AS is_mltssl,
    list_name = 'STSOL' AS is_stsol, list_name = 'CSOL' AS is_csol
    FROM (SELECT CAST(c_custkey AS VARCHAR) AS anzsco_code,
        nullif({sql_trim("CASE WHEN c_acctbal < 0 THEN ' ' ELSE c_name END")}, '') AS occupation_name,
        upper({sql_trim(_LIST_NAME)}) AS list_name, DATE '2024-07-01' + c_nationkey AS effective_date FROM customer)""",
)
def _list_flags(spark, sf_dir):
    lists = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS string) AS anzsco_code",
        "CASE WHEN c_acctbal < 0 THEN ' ' ELSE c_name END AS occupation_name",
        f"{_LIST_NAME} AS list_name",
        "date_add(DATE '2024-07-01', c_nationkey) AS effective_date",
    )
    return staged_occupation_lists(lists)


# --- joins ------------------------------------------------------------------------------------


@query(
    "enrich_left_join",
    """SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic, l.doc_id IS NOT NULL AS has_label,
    CAST(coalesce(len(l.tags), 0) AS INTEGER) AS tag_count
    FROM documents d LEFT JOIN (
      SELECT *, CASE toxic WHEN 1 THEN ['toxic', 'good'] ELSE ['good'] END AS tags FROM labels WHERE quality = 1) l
    ON l.doc_id = d.doc_id""",
)
def _enrich_left_join(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn(
        "tags", F.when(F.col("toxic") == 1, F.array(F.lit("toxic"), F.lit("good"))).otherwise(F.array(F.lit("good")))
    )
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    joined = enrich(documents, labels, ["doc_id"], F.col("quality") == 1, "has_label")
    return joined.withColumn("tag_count", array_length(F.col("tags"))).drop("tags")


@query(
    "pending_rows",
    """SELECT d.doc_id, d.lang, d.text FROM documents d
    WHERE length(d.text) >= 20 AND NOT EXISTS (
      SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)""",
)
def _pending_rows(spark, sf_dir):
    return pending_rows(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "text"),
        table(spark, sf_dir, "labels").where("quality = 1"),
        ["doc_id"],
        "text",
        sig.MIN_DESCRIPTION_LENGTH,
    )


# A pattern table over part names with ties, a NULL priority and a NULL code.
PART_PATTERNS = [
    {"priority": p, "anzsco_code": c, "title_pattern": t}
    for p, c, t in [
        ("1", "261111", "ring|red widget"),
        ("1", "261112", "red.?widget|bolt"),
        ("1", "261311", "^small"),
        ("2", "261312", "gear|gizmo"),
        ("2", "261313", "gi[xz]mo$"),
        ("3", None, "cold rod"),
        (None, "224711", "rod|plate"),
        ("4", "263111", "large (plate|rod)"),
    ]
]
_PATTERN_TYPES = {"priority": "BIGINT", "anzsco_code": "VARCHAR", "title_pattern": "VARCHAR"}
_PART_PATTERNS_SQL = f"patterns AS ({sql_values(PART_PATTERNS, _PATTERN_TYPES)})"
_PATTERN_RANK = "ORDER BY p.priority NULLS LAST, p.anzsco_code NULLS FIRST, p.title_pattern"


def part_pattern_rows() -> list[dict]:
    return [{**r, "priority": None if r["priority"] is None else int(r["priority"])} for r in PART_PATTERNS]


def part_patterns(spark: SparkSession) -> DataFrame:
    columns = {c: pa.array([r[c] for r in PART_PATTERNS], pa.string()) for c in _PATTERN_TYPES}
    return spark.createDataFrame(pa.table(columns)).withColumn("priority", F.col("priority").cast("long"))


_PART_MAP = f"""WITH {_PART_PATTERNS_SQL}
    SELECT p_partkey, p_name, anzsco_code FROM part LEFT JOIN patterns p ON regexp_matches(lower(p_name), p.title_pattern)
    QUALIFY row_number() OVER (PARTITION BY p_partkey {_PATTERN_RANK}) = 1"""


def _map_parts(spark, sf_dir, patterns, cells=None):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return map_by_pattern(parts, F.lower("p_name"), patterns, cells=cells)


@query("pattern_map_case", _PART_MAP)
def _pattern_map_case(spark, sf_dir):
    return _map_parts(spark, sf_dir, part_pattern_rows())


@query("pattern_map_join", _PART_MAP)
def _pattern_map_join(spark, sf_dir):
    return _map_parts(spark, sf_dir, part_patterns(spark))


@query("pattern_map_grid", _PART_MAP)
def _pattern_map_grid(spark, sf_dir):
    return _map_parts(spark, sf_dir, part_patterns(spark), cells=(3, 4))


@query(
    "mapping_coverage",
    f"""WITH {_PART_PATTERNS_SQL}, mapped AS (
      SELECT p_partkey, anzsco_code FROM part LEFT JOIN patterns p ON regexp_matches(lower(p_name), p.title_pattern)
      QUALIFY row_number() OVER (PARTITION BY p_partkey {_PATTERN_RANK}) = 1)
    SELECT count(*) AS total_jobs, count(anzsco_code) AS mapped_jobs, count(*) - count(anzsco_code) AS unmapped_jobs,
      count(anzsco_code) / count(*) AS mapped_share
    FROM lineitem JOIN mapped ON l_partkey = p_partkey""",
)
def _mapping_coverage(spark, sf_dir):
    titles = table(spark, sf_dir, "lineitem").select("l_partkey").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")
    )
    return mapping_coverage(map_by_pattern(titles, F.lower("p_name"), part_pattern_rows()))


# --- dimension and marts ----------------------------------------------------------------------

_PART_LIST = "CASE p_type WHEN 'ECONOMY' THEN 'MLTSSL' WHEN 'SMALL' THEN 'STSOL' WHEN 'PROMO' THEN 'CSOL' WHEN 'LARGE' THEN NULL ELSE p_type END"

# Brands are codes; economy parts give codes no pattern knows, promo parts codes no list knows.
_LISTED_CODE = "CASE WHEN p_type = 'ECONOMY' THEN concat(p_brand, 'e') ELSE p_brand END"
_NAMED_CODE = "CASE WHEN p_type = 'PROMO' THEN concat(p_brand, 'p') ELSE p_brand END"

_DIM_SQL = f"""part_lists AS (
  SELECT {_LISTED_CODE} AS anzsco_code, p_name AS occupation_name, {_PART_LIST} AS list_name,
    DATE '2024-01-01' + p_size AS effective_date FROM part),
part_named AS (
  SELECT {_NAMED_CODE} AS anzsco_code, CAST(p_size AS BIGINT) AS priority, concat(p_type, ' ', p_name) AS occupation_name,
    concat(p_name, CAST(p_partkey AS VARCHAR)) AS title_pattern FROM part),
names AS (
  SELECT anzsco_code, occupation_name FROM part_lists
  UNION SELECT DISTINCT anzsco_code, first_value(occupation_name) OVER (
    PARTITION BY anzsco_code ORDER BY priority, title_pattern) FROM part_named),
members AS (
  SELECT anzsco_code, coalesce(bool_or(list_name = 'MLTSSL'), false) AS is_mltssl,
    coalesce(bool_or(list_name = 'STSOL'), false) AS is_stsol, coalesce(bool_or(list_name = 'CSOL'), false) AS is_csol,
    string_agg(DISTINCT list_name, ',' ORDER BY list_name) AS list_membership, max(effective_date) AS effective_date
  FROM part_lists GROUP BY 1),
dim AS (
  SELECT n.anzsco_code, n.occupation_name, coalesce(is_mltssl, false) AS is_mltssl, coalesce(is_stsol, false) AS is_stsol,
    coalesce(is_csol, false) AS is_csol, list_membership, effective_date
  FROM (SELECT anzsco_code, min(occupation_name) AS occupation_name FROM names GROUP BY 1) n
  LEFT JOIN members m ON m.anzsco_code = n.anzsco_code)"""


def part_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as occupations: some on lists, some named by patterns, some by both."""
    part = table(spark, sf_dir, "part")
    lists = part.selectExpr(
        f"{_LISTED_CODE} AS anzsco_code",
        "p_name AS occupation_name",
        f"{_PART_LIST} AS list_name",
        "date_add(DATE '2024-01-01', p_size) AS effective_date",
    )
    patterns = part.selectExpr(
        f"{_NAMED_CODE} AS anzsco_code",
        "CAST(p_size AS bigint) AS priority",
        "concat(p_type, ' ', p_name) AS occupation_name",
        "concat(p_name, CAST(p_partkey AS string)) AS title_pattern",
    )
    return occupation_dim(lists, patterns)


@query("occupation_dim", f"WITH {_DIM_SQL} SELECT * FROM dim")
def _occupation_dim(spark, sf_dir):
    return part_dim(spark, sf_dir)


@query(
    "dim_health",
    f"""WITH {_DIM_SQL} SELECT count(*) AS total_anzsco_codes, count(*) FILTER (is_mltssl) AS mltssl_count,
    count(*) FILTER (is_stsol) AS stsol_count, count(*) FILTER (is_csol) AS csol_count,
    count(*) FILTER (occupation_name IS NULL) AS missing_name_count FROM dim""",
)
def _dim_health(spark, sf_dir):
    return dim_health(part_dim(spark, sf_dir))


_JOB = {
    "anzsco_code": "CASE WHEN p_type <> 'PROMO' THEN p_brand END",
    "state": """CASE WHEN l_linenumber = 7 THEN NULL WHEN p_size < 20 THEN 'Victoria'
        WHEN p_size < 40 THEN 'Queensland' ELSE 'Tasmania' END""",
    "sponsorship_signal": "CASE l_returnflag WHEN 'A' THEN 'explicit_yes' WHEN 'R' THEN 'explicit_no' ELSE 'unspecified' END",
    "remote_friendly": """CASE WHEN l_linenumber <= 2 THEN 'remote' WHEN l_linenumber <= 4 THEN 'hybrid'
        WHEN l_linenumber <= 6 THEN 'onsite' ELSE 'unspecified' END""",
    "local_experience_required": "CASE WHEN l_linestatus = 'O' THEN l_discount > 0.05 END",
    "salary_avg": "CASE WHEN l_linenumber < 7 THEN l_extendedprice END",
}
_JOB_COLUMNS = [f"{e} AS {n}" for n, e in _JOB.items()]
_JOBS_SQL = f"jobs AS (SELECT {', '.join(_JOB_COLUMNS)} FROM lineitem JOIN part ON l_partkey = p_partkey)"

_CEILING_SQL = """ceilings AS (
  SELECT substr(p_brand, 1, 7) AS anzsco_unit_group, min(p_name) AS unit_group_name, CAST(min(p_size) AS BIGINT) AS tier,
    CASE WHEN substr(p_brand, 1, 7) = 'Brand#3' THEN NULL WHEN substr(p_brand, 1, 7) = 'Brand#4' THEN 0
         ELSE CAST(sum(p_size) AS BIGINT) END AS annual_ceiling,
    count(*) AS grants_py24_25, CAST(max(p_size) AS BIGINT) AS remaining_py25_26, '2025-26' AS program_year
  FROM part GROUP BY 1)"""


def part_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as mapped postings, with the part's brand as occupation code."""
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .selectExpr(*_JOB_COLUMNS)
    )


def part_ceilings(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.col("anzsco_unit_group")
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.substring("p_brand", 1, 7).alias("anzsco_unit_group"))
        .agg(
            F.min("p_name").alias("unit_group_name"),
            F.min("p_size").cast("long").alias("tier"),
            F.sum("p_size").alias("annual_ceiling"),
            F.count(F.lit(1)).alias("grants_py24_25"),
            F.max("p_size").cast("long").alias("remaining_py25_26"),
        )
        .withColumn(
            "annual_ceiling",
            F.when(group == "Brand#3", None).when(group == "Brand#4", 0).otherwise(F.col("annual_ceiling")),
        )
        .withColumn("program_year", F.lit("2025-26"))
    )


_Q1_SQL = f"""{_DIM_SQL}, {_JOBS_SQL}, {_CEILING_SQL},
per_code AS (
  SELECT anzsco_code, count(*) AS jobs_count_30d,
    count(*) FILTER (sponsorship_signal = 'explicit_yes') AS sponsorship_yes_count,
    count(*) FILTER (sponsorship_signal = 'explicit_no') AS sponsorship_no_count,
    count(*) FILTER (remote_friendly = 'remote') AS remote_count, count(*) FILTER (remote_friendly = 'hybrid') AS hybrid_count,
    count(*) FILTER (remote_friendly = 'onsite') AS onsite_count,
    count(*) FILTER (local_experience_required) AS local_experience_count,
    avg(salary_avg) AS avg_salary, quantile_disc(salary_avg, 0.5) AS median_salary
  FROM jobs WHERE anzsco_code IS NOT NULL GROUP BY 1),
q1 AS (
  SELECT d.anzsco_code, occupation_name, is_mltssl, is_stsol, is_csol, list_membership,
    substr(d.anzsco_code, 1, 7) AS anzsco_unit_group, unit_group_name, tier,
    coalesce(jobs_count_30d, 0) AS jobs_count_30d, coalesce(sponsorship_yes_count, 0) AS sponsorship_yes_count,
    coalesce(sponsorship_no_count, 0) AS sponsorship_no_count, coalesce(remote_count, 0) AS remote_count,
    coalesce(hybrid_count, 0) AS hybrid_count, coalesce(onsite_count, 0) AS onsite_count,
    coalesce(local_experience_count, 0) AS local_experience_count, round(avg_salary, 4) AS avg_salary, median_salary,
    annual_ceiling, grants_py24_25, remaining_py25_26, program_year AS ceiling_program_year,
    coalesce(jobs_count_30d, 0) / nullif(annual_ceiling, 0) AS jobs_to_ceiling_ratio,
    grants_py24_25 / nullif(coalesce(jobs_count_30d, 0), 0) AS grants_to_jobs_ratio
  FROM dim d LEFT JOIN per_code j ON j.anzsco_code = d.anzsco_code
  LEFT JOIN ceilings c ON c.anzsco_unit_group = substr(d.anzsco_code, 1, 7))"""


def part_supply_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = supply_demand(
        part_jobs(spark, sf_dir), part_dim(spark, sf_dir), part_ceilings(spark, sf_dir), unit_digits=7
    )
    return facts.withColumn("avg_salary", F.round("avg_salary", 4))


@query("supply_demand", f"WITH {_Q1_SQL} SELECT * FROM q1")
def _supply_demand(spark, sf_dir):
    return part_supply_demand(spark, sf_dir)


@query(
    "top_supply",
    f"""WITH {_Q1_SQL} SELECT anzsco_code, occupation_name, anzsco_unit_group, list_membership, jobs_count_30d,
    annual_ceiling, grants_py24_25, round(jobs_to_ceiling_ratio, 3) AS jobs_to_ceiling_ratio,
    round(grants_to_jobs_ratio, 3) AS grants_to_jobs_ratio
    FROM q1 WHERE jobs_count_30d > 0 ORDER BY jobs_count_30d DESC, anzsco_code LIMIT 10""",
)
def _top_supply(spark, sf_dir):
    return top_supply(part_supply_demand(spark, sf_dir))


@query(
    "occupation_barrier",
    f"""WITH {_Q1_SQL} SELECT anzsco_code, occupation_name, jobs_count_30d, local_experience_count,
    local_experience_count / jobs_count_30d AS local_experience_pct FROM q1 WHERE jobs_count_30d > 0""",
)
def _occupation_barrier(spark, sf_dir):
    return occupation_barrier(part_supply_demand(spark, sf_dir))


_Q2_SQL = f"""{_DIM_SQL}, {_JOBS_SQL}, q2 AS (
  SELECT j.anzsco_code, occupation_name, list_membership, state, total_jobs, local_experience_count,
    sponsorship_yes_count, sponsorship_no_count, local_experience_count / total_jobs AS local_experience_pct,
    sponsorship_yes_count / total_jobs AS sponsorship_yes_pct, sponsorship_no_count / total_jobs AS sponsorship_no_pct
  FROM (SELECT anzsco_code, state, count(*) AS total_jobs,
      count(*) FILTER (local_experience_required) AS local_experience_count,
      count(*) FILTER (sponsorship_signal = 'explicit_yes') AS sponsorship_yes_count,
      count(*) FILTER (sponsorship_signal = 'explicit_no') AS sponsorship_no_count
    FROM jobs WHERE anzsco_code IS NOT NULL AND state IS NOT NULL GROUP BY 1, 2) j
  LEFT JOIN dim d ON d.anzsco_code = j.anzsco_code WHERE total_jobs >= 5)"""


@query("experience_barrier", f"WITH {_Q2_SQL} SELECT * FROM q2")
def _experience_barrier(spark, sf_dir):
    return experience_barrier(part_jobs(spark, sf_dir), part_dim(spark, sf_dir))


@query(
    "top_barrier",
    f"""WITH {_Q2_SQL} SELECT anzsco_code, state, total_jobs, round(local_experience_pct, 3) AS local_exp_pct,
    round(sponsorship_yes_pct, 3) AS sponsor_yes_pct FROM q2 ORDER BY total_jobs DESC, anzsco_code, state LIMIT 10""",
)
def _top_barrier(spark, sf_dir):
    return top_barriers(experience_barrier(part_jobs(spark, sf_dir), part_dim(spark, sf_dir)))


@query(
    "barrier_rates",
    """SELECT *, toxic_count / doc_count AS toxic_rate, good_count / doc_count AS good_rate FROM (
      SELECT source, lang, count(*) AS doc_count, count(*) FILTER (toxic = 1) AS toxic_count,
        count(*) FILTER (quality = 1) AS good_count
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
      WHERE source IS NOT NULL AND lang IS NOT NULL GROUP BY 1, 2) WHERE doc_count >= 5""",
)
def _barrier_rates(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    labelled = enrich(documents, table(spark, sf_dir, "labels"), ["doc_id"])
    return group_rates(
        labelled.where(F.col("source").isNotNull() & F.col("lang").isNotNull()),
        ["source", "lang"],
        "doc_count",
        {"toxic_count": F.col("toxic") == 1, "good_count": F.col("quality") == 1},
        {"toxic_rate": "toxic_count", "good_rate": "good_count"},
        5,
    )


_WORDS_SQL = f"""words AS (
  SELECT lang AS state, lower({sql_trim("spelling")}) AS skill, min(spelling) AS skill_display, count(*) AS mention_count,
    count(DISTINCT source) AS cities_mentioned_in
  FROM (SELECT lang, source, unnest(string_split(text, ' ')) AS spelling FROM documents)
  WHERE lang IS NOT NULL AND length({sql_trim("spelling")}) > 0 GROUP BY 1, 2 HAVING count(*) >= 3)"""


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        F.col("lang").alias("state"), F.col("source"), F.split("text", " ").alias("words")
    )
    return item_counts(documents, "state", "words", "source", min_mentions=3)


@query("skills_demand", f"WITH {_WORDS_SQL} SELECT * FROM words")
def _skills_demand(spark, sf_dir):
    return document_words(spark, sf_dir)


@query(
    "skills_top_k",
    f"""WITH {_WORDS_SQL} SELECT state, skill, mention_count FROM words
    QUALIFY row_number() OVER (PARTITION BY state ORDER BY mention_count DESC, skill) <= 3""",
)
def _skills_top_k(spark, sf_dir):
    return skills_top_k(document_words(spark, sf_dir))


@query(
    "top_k_per_group",
    """SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) <= 5""",
)
def _top_k_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return top_k_per_group(orders, ["o_orderpriority"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 5)


# --- signals ----------------------------------------------------------------------------------

_SPELLED_MODE = """CASE event_type WHEN 'click' THEN concat(' WFH', chr(9)) WHEN 'view' THEN 'Fully Remote' WHEN 'purchase' THEN 'on-site'
    WHEN 'signup' THEN 'N/A' ELSE concat(' Other ', props) END"""
_SPELLED_VISA = """CASE event_type WHEN 'click' THEN 'YES ' WHEN 'view' THEN 'Not Available' WHEN 'purchase' THEN 'explicit_no'
    WHEN 'signup' THEN NULL ELSE 'None' END"""


@query(
    "alias_normalise",
    """SELECT event_id,
    CASE event_type WHEN 'click' THEN 'remote' WHEN 'view' THEN 'remote' WHEN 'purchase' THEN 'onsite'
      WHEN 'signup' THEN 'unspecified' ELSE concat('other ', props) END AS remote_friendly,
    CASE event_type WHEN 'click' THEN 'explicit_yes' WHEN 'view' THEN 'explicit_no' WHEN 'purchase' THEN 'explicit_no'
      WHEN 'signup' THEN NULL ELSE 'unspecified' END AS sponsorship_signal FROM events""",
)
def _alias_normalise(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        sig.normalise_alias(F.expr(_SPELLED_MODE), sig.REMOTE_ALIASES).alias("remote_friendly"),
        sig.normalise_alias(F.expr(_SPELLED_VISA), sig.SPONSORSHIP_ALIASES).alias("sponsorship_signal"),
    )


# Years as number, text, whole and broken decimals, null, missing or junk, by user.
_YEARS_JSON = """CASE WHEN user_id < 10 THEN concat('"years_experience": ', CAST(user_id AS string), ', ')
    WHEN user_id < 20 THEN concat('"years_experience": " ', CAST(user_id AS string), '", ')
    WHEN user_id < 30 THEN concat('"years_experience": ', CAST(user_id AS string), '.0, ')
    WHEN user_id < 40 THEN concat('"years_experience": ', CAST(user_id AS string), '.5, ')
    WHEN user_id < 60 THEN concat('"years_experience": ', CAST(user_id AS string), ', ')
    WHEN user_id < 80 THEN '"years_experience": null, ' WHEN user_id < 100 THEN '"years_experience": "five", '
    WHEN user_id < 110 THEN '"years_experience": true, ' ELSE '' END"""
_PAYLOAD = f"""CASE WHEN value < 0.5 THEN 'no json' WHEN value < 1 THEN NULL ELSE concat('{{', {_YEARS_JSON},
    CASE event_type WHEN 'click' THEN '"remote_friendly": "WFH", "local_experience_required": "Yes"'
      WHEN 'view' THEN '"remote_friendly": "somewhere"'
      WHEN 'purchase' THEN '"sponsorship_signal": " Available ", "local_experience_required": 1, "extra": [1]'
      WHEN 'signup' THEN '"sponsorship_signal": null'
      ELSE '"required_skills": ["SQL", "sql", " Go "], "local_experience_required": false' END, '}}') END"""
_YEARS_OK = "NOT (user_id BETWEEN 30 AND 39 OR user_id BETWEEN 41 AND 59 OR user_id BETWEEN 80 AND 99)"


@query(
    "payload_contract",
    f"""SELECT event_id, CASE WHEN ok THEN 'ok' ELSE 'error' END AS extraction_status,
    CASE WHEN NOT ok THEN NULL WHEN user_id < 30 OR user_id = 40 THEN user_id
      WHEN user_id BETWEEN 100 AND 109 THEN 1 END AS years_experience,
    CASE WHEN ok AND event_type = 'purchase' THEN 'explicit_yes' ELSE 'unspecified' END AS sponsorship_signal,
    ok AND event_type IN ('click', 'purchase') AS local_experience_required,
    CASE WHEN ok AND event_type = 'click' THEN 'remote' ELSE 'unspecified' END AS remote_friendly,
    CASE WHEN ok AND event_type = 'error' THEN 'SQL|Go' ELSE '' END AS skills
    FROM (SELECT *, value >= 1 AND event_type NOT IN ('view', 'signup') AND {_YEARS_OK} AS ok FROM events)""",
)
def _payload_contract(spark, sf_dir):
    payloads = table(spark, sf_dir, "events").selectExpr("event_id", f"{_PAYLOAD} AS payload")
    checked = normalise_payload(payloads, "payload")
    return checked.select(
        "event_id",
        "extraction_status",
        "years_experience",
        "sponsorship_signal",
        "local_experience_required",
        "remote_friendly",
        F.array_join("required_skills", "|").alias("skills"),
    )


@query(
    "skills_dedupe",
    f"""SELECT conv_id, turn, role, CAST(count(*) AS INTEGER) AS word_count,
      string_agg(word, '|' ORDER BY first_at) AS words FROM (
      SELECT conv_id, turn, role, text, lower(w) AS key, min(i) AS first_at, arg_min(w, i) AS word FROM (
        SELECT conv_id, turn, role, text, i, {sql_trim("list_extract(ws, i)")} AS w
        FROM (SELECT *, string_split(text, ' ') AS ws FROM conversations), unnest(range(1, len(ws) + 1)) AS r(i))
      WHERE w <> '' GROUP BY ALL) GROUP BY conv_id, turn, role, text""",
)
def _skills_dedupe(spark, sf_dir):
    words = dedupe_ignoring_case(F.split("text", " "))
    return (
        table(spark, sf_dir, "conversations")
        .withColumn("_words", words)
        .select(
            "conv_id",
            "turn",
            "role",
            F.size("_words").alias("word_count"),
            F.array_join("_words", "|").alias("words"),
        )
    )


# Wording appended to whole document texts, so that the rules have something to find.
_PHRASE = """CASE WHEN n_chars < 300 THEN ' Hybrid role, 3-5 years of Python, SQL and python.'
    WHEN n_chars < 600 THEN ' Fully remote. Visa sponsorship is available. AWS and Docker, 7+ yrs.'
    WHEN n_chars < 1500 THEN ' Australian citizens only. Local experience required. On-site in Perth.'
    WHEN n_chars < 2500 THEN ' Training sponsorship on offer; Kafka, Spark, dbt.'
    WHEN n_chars < 4000 THEN concat(' 60 years of history, 25 years in business: excel, Tableau, Redis, Airflow, Hadoop, Linux, Jenkins,',
      ' Terraform, Azure, Flask, Django, Angular, React, Ruby, Rust, Kotlin, Scala, Python, SQL, AWS, Docker, Kafka, Spark and dbt; 7+ yrs of Excel, 4 to 6 years of Rust.')
    ELSE '' END"""
RULE_SKILLS = [
    "Python", "SQL", "AWS", "Docker", "Kafka", "Spark", "dbt", "Scala", "Kotlin", "Rust", "Ruby", "React", "Angular",
    "Django", "Flask", "Azure", "Terraform", "Jenkins", "Linux", "Hadoop", "Airflow", "Redis", "Tableau", "Excel",
]


@query(
    "rule_signals",
    f"""SELECT doc_id,
      array_to_string([found[i] for i in range(1, len(found) + 1) if list_position(found, found[i]) = i], '|') AS skills,
      list_min([CAST(y AS BIGINT) for y in regexp_extract_all(body, '\\b(\\d{{1,2}})\\s*(?:\\+|(?:-|–|to)\\s*\\d{{1,2}}\\s*\\+?)?\\s*(?:years?|yrs?)\\b', 1, 'i') if CAST(y AS BIGINT) <= 40]) AS years_experience,
      CASE WHEN regexp_matches(body, 'australian citizens only', 'i') THEN 'explicit_no'
           WHEN regexp_matches(body, 'visa sponsorship is available', 'i') THEN 'explicit_yes' ELSE 'unspecified' END AS sponsorship_signal,
      regexp_matches(body, 'local experience required', 'i') AS local_experience_required,
      CASE WHEN regexp_matches(body, '\\bhybrid\\b', 'i') THEN 'hybrid' WHEN regexp_matches(body, '\\bfully remote\\b', 'i') THEN 'remote'
           WHEN regexp_matches(body, '\\bon-site\\b', 'i') THEN 'onsite' ELSE 'unspecified' END AS remote_friendly
    FROM (SELECT doc_id, body, regexp_extract_all(lower(body), '\\b({"|".join(RULE_SKILLS).lower()})\\b', 1) AS found
      FROM (SELECT doc_id, concat(text, {_PHRASE}) AS body FROM documents))""",
)
def _rule_signals(spark, sf_dir):
    bodies = table(spark, sf_dir, "documents").selectExpr("doc_id", f"concat(text, {_PHRASE}) AS body")
    found = rule_signals(bodies, "body", RULE_SKILLS)
    return found.withColumn("skills", F.lower(F.array_join("required_skills", "|"))).drop("body", "required_skills")


EXTRACTED_AT = datetime(2026, 1, 2, 3, 4, 5)


def length_extractor() -> Callable[[str], dict]:
    """Stand-in for a remote extractor: answers from the text alone, and sometimes fails.

    A nested function travels to the workers by value, so they need not have this package.
    """

    def extract(text: str) -> dict:
        if text.count("\n") > 40:
            raise TimeoutError("too many lines")
        if len(text) > 4000:
            return {"years_experience": 99}
        answer: dict = {"required_skills": ["SQL", "sql"], "years_experience": len(text) // 100}
        if len(text) < 1000:
            answer["remote_friendly"] = "WFH"
        return answer

    return extract


@query(
    "extract_signals",
    """SELECT doc_id, CASE WHEN ok THEN 'ok' ELSE 'error' END AS extraction_status,
    CASE WHEN ok THEN 'SQL' ELSE '' END AS skills, CASE WHEN ok THEN length(text) // 100 END AS years_experience,
    CASE WHEN ok AND length(text) < 1000 THEN 'remote' ELSE 'unspecified' END AS remote_friendly,
    'lengths@2026-01-02' AS model_version,
    CASE WHEN lines > 40 THEN 'TimeoutError(''too many lines'')' WHEN NOT ok THEN 'invalid fields: years_experience' END AS error_message
    FROM (SELECT *, lines <= 40 AND length(text) <= 4000 AS ok FROM (
      SELECT *, len(string_split(text, chr(10))) - 1 AS lines FROM documents WHERE length(text) >= 20))""",
)
def _extract_signals(spark, sf_dir):
    pending = table(spark, sf_dir, "documents").select("doc_id", "text").where(F.length("text") >= 20)
    records = extract_signals(
        pending, length_extractor(), "lengths", EXTRACTED_AT, keys=["doc_id"], text="text"
    )
    return records.select(
        "doc_id",
        "extraction_status",
        F.array_join("required_skills", "|").alias("skills"),
        "years_experience",
        "remote_friendly",
        "model_version",
        "error_message",
    )


# --- evaluation -------------------------------------------------------------------------------


@query(
    "eval_sample",
    f"""SELECT CAST(d.doc_id AS VARCHAR) AS job_id, d.source AS job_title, body AS description_text,
    CASE quality WHEN 1 THEN 'good|doc' ELSE '' END AS skills, quality AS years_experience
    FROM labels l JOIN (SELECT *, concat(text, {_PHRASE}) AS body FROM documents) d ON d.doc_id = l.doc_id
    WHERE toxic = 0 AND regexp_matches(lower(body),
      'years|experience|sponsor|visa|remote|hybrid|wfh|python|sql|aws|gcp|azure|java|react|kubernetes|docker')
    ORDER BY CASE quality WHEN 1 THEN 2 ELSE 0 END DESC, length(body) DESC, CAST(d.doc_id AS VARCHAR) LIMIT 50""",
)
def _eval_sample(spark, sf_dir):
    day = F.lit("2026-01-01").cast("date")
    staged = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("job_id"),
        day.alias("snapshot_date"),
        F.col("source").alias("job_title"),
        F.expr(f"concat(text, {_PHRASE})").alias("description_text"),
    )
    extracts = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("job_id"),
        day.alias("snapshot_date"),
        F.when(F.col("quality") == 1, F.array(F.lit("good"), F.lit("doc"))).alias("required_skills"),
        F.col("quality").alias("years_experience"),
        F.lit("unspecified").alias("sponsorship_signal"),
        F.lit(False).alias("local_experience_required"),
        F.lit("unspecified").alias("remote_friendly"),
        F.when(F.col("toxic") == 0, sig.STATUS_OK).otherwise(sig.STATUS_ERROR).alias("extraction_status"),
    )
    sample = evaluation_sample(staged, extracts)
    return sample.select(
        "job_id",
        "job_title",
        "description_text",
        F.coalesce(F.array_join("required_skills", "|"), F.lit("")).alias("skills"),
        "years_experience",
    )


JUDGED = ["quality", "toxic"]


def label_judge() -> Callable[[str, dict], dict]:
    """Stand-in for a remote judge: verdicts follow the labels; unlabelled documents fail."""

    def judge_one(text: str, extraction: dict) -> dict:
        if extraction["quality"] is None:
            raise LookupError(f"no label for {len(text)} characters")
        good, toxic = extraction["quality"] == 1, extraction["toxic"] == 1
        toxic_verdict = "uncertain" if toxic and not good else "incorrect" if toxic else "correct"
        return {
            "quality": {"verdict": "correct" if good else "incorrect", "reasoning": f"length {len(text)}"},
            "toxic": {"verdict": toxic_verdict, "reasoning": "label"},
        }

    return judge_one


def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return judge(labelled, label_judge(), JUDGED, text="text")


_JUDGED_SQL = """judged AS (
  SELECT d.doc_id, d.source, d.text, quality, toxic, quality IS NULL AS failed,
    CASE quality WHEN 1 THEN 'correct' WHEN 0 THEN 'incorrect' END AS v_quality,
    CASE WHEN toxic = 0 THEN 'correct' WHEN toxic = 1 AND quality = 1 THEN 'incorrect' WHEN toxic = 1 THEN 'uncertain' END AS v_toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


@query(
    "judged_rows",
    f"""WITH {_JUDGED_SQL} SELECT doc_id, v_quality AS quality_verdict, v_toxic AS toxic_verdict,
    CASE WHEN NOT failed THEN concat('length ', length(text)) END AS reasoning,
    CASE WHEN failed THEN concat('no label for ', length(text), ' characters') END AS error FROM judged""",
)
def _judged_rows(spark, sf_dir):
    return judged_documents(spark, sf_dir).select(
        "doc_id",
        F.col("quality_judgment.verdict").alias("quality_verdict"),
        F.col("toxic_judgment.verdict").alias("toxic_verdict"),
        F.col("quality_judgment.reasoning").alias("reasoning"),
        "error",
    )


@query(
    "verdict_tallies",
    f"WITH {_JUDGED_SQL}, tallies AS ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS field, "
        + ", ".join(f"count(*) FILTER (v_{f} = '{v}') AS {v}" for v in ("correct", "incorrect", "uncertain"))
        + " FROM judged"
        for f in JUDGED
    )
    + ") SELECT *, correct / nullif(correct + incorrect, 0) AS accuracy FROM tallies",
)
def _verdict_tallies(spark, sf_dir):
    return verdict_tallies(judged_documents(spark, sf_dir), JUDGED)


@query(
    "judge_accuracy",
    f"""WITH {_JUDGED_SQL}, verdicts AS (SELECT v_quality AS v FROM judged UNION ALL SELECT v_toxic FROM judged),
    totals AS (SELECT (SELECT count(*) FROM judged WHERE NOT failed) AS judged_rows,
      (SELECT count(*) FROM judged WHERE failed) AS failed_rows,
      (SELECT count(*) FROM verdicts WHERE v = 'correct') AS correct,
      (SELECT count(*) FROM verdicts WHERE v IN ('correct', 'incorrect')) AS decided)
    SELECT *, coalesce(correct / nullif(decided, 0), 0) AS overall_accuracy,
      coalesce(correct / nullif(decided, 0), 0) >= 0.8 AS passed FROM totals""",
)
def _judge_accuracy(spark, sf_dir):
    return judge_accuracy(judged_documents(spark, sf_dir), JUDGED)


@query(
    "failure_examples",
    f"""WITH {_JUDGED_SQL} SELECT doc_id, source,
    substr({sql_trim("replace(coalesce(text, ''), chr(10), ' ')")}, 1, 240) AS snippet,
    concat_ws(' ', CASE WHEN v_quality = 'incorrect' THEN concat('quality=', quality, ':length ', length(text)) END,
      CASE WHEN v_toxic = 'incorrect' THEN concat('toxic=', toxic, ':label') END) AS faults
    FROM judged WHERE v_quality = 'incorrect' OR v_toxic = 'incorrect' ORDER BY doc_id LIMIT 5""",
)
def _failure_examples(spark, sf_dir):
    found = failure_examples(
        judged_documents(spark, sf_dir), JUDGED, [F.col("doc_id")], 5, text="text", keep=["doc_id", "source"]
    )
    as_text = F.transform(
        "faults", lambda x: F.concat(x["field"], F.lit("="), x["value"], F.lit(":"), x["reasoning"])
    )
    return found.withColumn("faults", F.array_join(as_text, " "))


@query(
    "snippets",
    f"SELECT doc_id, substr({sql_trim('replace(text, chr(10), chr(32))')}, 1, 240) AS snippet FROM documents",
)
def _snippets(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", snippet(F.col("text")).alias("snippet"))


@query(
    "run_evaluation",
    f"""WITH {_JUDGED_SQL}
    SELECT 'quality' AS field, count(*) FILTER (v_quality = 'correct') AS correct, count(*) FILTER (v_quality = 'incorrect') AS incorrect,
      count(*) FILTER (NOT failed) AS judged_rows, count(*) FILTER (failed) AS failed_rows FROM judged
    UNION ALL SELECT 'toxic', count(*) FILTER (v_toxic = 'correct'), count(*) FILTER (v_toxic = 'incorrect'),
      count(*) FILTER (NOT failed), count(*) FILTER (failed) FROM judged""",
)
def _run_evaluation(spark, sf_dir):
    """One judgement per row feeds all reports."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    reports = run_evaluation(
        labelled, label_judge(), JUDGED, [F.col("doc_id")], scratch_path(spark, "judged"), text="text", keep=["doc_id"]
    )
    rows = reports["accuracy"].select("judged_rows", "failed_rows")
    return reports["tallies"].select("field", "correct", "incorrect").crossJoin(rows)
