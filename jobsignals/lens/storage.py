"""Landing, loading, replacing, upserting, exporting and counting the benchmark tables.

Each query writes to the shared folder and returns what is read back from there.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignals.functions.text import slug
from jobsignals.lens.postings import _RAW, _sql, raw_parts, raw_postings
from jobsignals.lens.registry import query, table
from jobsignals.operators.quality import (
    accepted_values,
    coverage,
    expression_is_true,
    failing_rows,
    not_null,
    relationship,
    run_suite,
    suite_result,
    unique,
    unique_combination,
)
from jobsignals.lens.postings import report_sql
from jobsignals.operators.ranking import top_rows
from jobsignals.rounds import free_rounds
from jobsignals.schemas import RAW_POSTING
from jobsignals.session import scratch_path
from jobsignals.sources.export import (
    export_and_reconcile,
    flat_sample,
    load_copy,
    nested_to_variant,
    without_zone,
    write_flat_sample,
)
from jobsignals.sources.files import remove
from jobsignals.sources.landing import ingest, land_jsonl, read_jsonl, rows_per_folder, stamp, store_batch
from jobsignals.sources.seeds import read_typed_csv
from jobsignals.sources.tables import (
    append_snapshot,
    drop_partitions,
    inventory,
    inventory_with_size,
    materialise,
    publish_view,
    replace_partitions,
    row_count,
    upsert,
    upsert_table,
)
from jobsignals.streaming.landing import landed_stream, load_new_files

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_LANDED_SELECT = """SELECT id, snapshot_date, source_city, title, description, redirect_url, salary_min, salary_max,
  location_display, area_length, company_name, category_tag FROM raw"""


def _landed_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        "snapshot_date",
        "source_city",
        "title",
        "description",
        "redirect_url",
        "salary_min",
        "salary_max",
        F.col("location.display_name").alias("location_display"),
        F.size("location.area").alias("area_length"),
        F.col("company.display_name").alias("company_name"),
        F.col("category.tag").alias("category_tag"),
    )


def _land(raw: DataFrame, path: str) -> None:
    land_jsonl(raw, path, folders=rows_per_folder(raw))


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw postings worked out once, part by part, for queries that land them."""
    parts, path = raw_parts(spark, sf_dir), scratch_path(spark, "raw")
    for part in parts:
        store_batch(part, path)
        if len(parts) > 1:
            free_rounds(spark)
    fetched = spark.read.schema(parts[0].schema).parquet(path)
    fetched.scratch = path
    return fetched


@query("land_jsonl", _sql([_RAW], _LANDED_SELECT))
def _land_jsonl(spark, sf_dir):
    raw, path = _fetched(spark, sf_dir), scratch_path(spark, "landing")
    _land(raw, path)
    remove(spark, raw.scratch)
    return _landed_columns(read_jsonl(spark, path))


@query(
    "reland_city",
    _sql(
        [_RAW],
        """SELECT id, snapshot_date, source_city, redirect_url,
        CASE source_city WHEN 'Sydney' THEN 'again ' || title ELSE title END AS title FROM raw""",
    ),
)
def _reland_city(spark, sf_dir):
    """Landing one city again replaces that city's files and leaves the others alone."""
    raw, path = _fetched(spark, sf_dir), scratch_path(spark, "landing")
    _land(raw, path)
    again = raw.where("source_city = 'Sydney'")
    _land(again.withColumn("title", F.concat(F.lit("again "), "title")), path)
    remove(spark, raw.scratch)
    return read_jsonl(spark, path).select("id", "snapshot_date", "source_city", "redirect_url", "title")


@query(
    "stream_landed",
    _sql([_RAW], f"""SELECT * REPLACE (CASE source_city WHEN 'Sydney' THEN 'again ' || title ELSE title END AS title)
    FROM ({_LANDED_SELECT})"""),
)
def _stream_landed(spark, sf_dir):
    """The landed files loaded in three runs of one stream; one city lands twice, with new titles."""
    landing, loaded, state = (scratch_path(spark, x) for x in ("landing", "loaded", "state"))
    raw = _fetched(spark, sf_dir)
    again = raw.where("source_city = 'Sydney'").withColumn("title", F.concat(F.lit("again "), "title"))
    for part in (raw.where("source_city = 'Sydney'"), raw.where("source_city <> 'Sydney'"), again):
        _land(part, landing)
        load_new_files(landed_stream(spark, landing), landing, loaded, state).awaitTermination()
    return _landed_columns(spark.read.schema(RAW_POSTING).parquet(loaded))


@query(
    "ingest",
    _sql([_RAW], """SELECT source_city, count(*) AS fetched_rows, count(*) AS loaded_rows, true AS ok,
    2 * count(*) AS table_rows FROM raw GROUP BY 1"""),
)
def _ingest(spark, sf_dir):
    """Landed, loaded and reported twice: the first replaces its days, the second appends."""
    landing, loaded = scratch_path(spark, "landing"), scratch_path(spark, "loaded")
    raw = _fetched(spark, sf_dir)
    for replace in (True, True, False):
        report = ingest(spark, raw, landing, loaded, replace, stored=True)
    remove(spark, raw.scratch)
    held = spark.read.schema(RAW_POSTING).parquet(loaded).groupBy("source_city").agg(F.count(F.lit(1)).alias("table_rows"))
    return report.join(held, "source_city")


_STAMPED_AT = datetime(2026, 5, 6, 7, 8, 9)


@query(
    "stamp_batch",
    """SELECT c_custkey, DATE '2026-05-06' AS snapshot_date, '2026-05-06 07:08:09' AS ingested_at,
    'Brisbane Region' AS source_city, 'brisbane-region' AS label FROM customer""",
)
def _stamp_batch(spark, sf_dir):
    batch = table(spark, sf_dir, "customer").select("c_custkey")
    stamped = stamp(batch, date(2026, 5, 6), _STAMPED_AT, "Brisbane Region")
    return stamped.withColumns(
        {
            "ingested_at": F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"),
            "label": slug(F.col("source_city")),
        }
    )


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("snapshot_date"), "user_id", "event_type", "value"
    )


_EVENTS = "SELECT event_id, CAST(ts AS DATE) AS snapshot_date, user_id, event_type, value FROM events"


@query("append_snapshot", _EVENTS)
def _append_snapshot(spark, sf_dir):
    path = scratch_path(spark, "appended")
    events = _daily_events(spark, sf_dir)
    for part in ("event_type IN ('view', 'click')", "event_type NOT IN ('view', 'click')"):
        append_snapshot(events.where(part), path, cluster_by=["event_type"])
    return spark.read.schema(events.schema).parquet(path)


@query(
    "replace_partition",
    f"""SELECT * FROM ({_EVENTS}) WHERE snapshot_date < DATE '2024-01-10'
    UNION ALL SELECT event_id, snapshot_date, user_id, event_type, value * 2 FROM ({_EVENTS})
    WHERE snapshot_date >= DATE '2024-01-10' AND event_type = 'purchase'""",
)
def _replace_partition(spark, sf_dir):
    path = scratch_path(spark, "replaced")
    events = _daily_events(spark, sf_dir)
    replace_partitions(events, path, cluster_by=["event_type"])
    newer = events.where("snapshot_date >= DATE '2024-01-10' AND event_type = 'purchase'")
    for _ in range(2):  # a re-run must not change the table
        replace_partitions(newer.withColumn("value", F.col("value") * 2), path, cluster_by=["event_type"])
    return spark.read.schema(events.schema).parquet(path)


@query(
    "replace_with_nothing",
    f"""SELECT * FROM ({_EVENTS}) WHERE snapshot_date < DATE '2024-01-10' AND snapshot_date <> DATE '2024-01-03'
    UNION ALL SELECT event_id, snapshot_date, user_id, event_type, value * 2 FROM ({_EVENTS})
    WHERE snapshot_date >= DATE '2024-01-10' AND event_type = 'purchase' AND snapshot_date <> DATE '2024-01-12'""",
)
def _replace_with_nothing(spark, sf_dir):
    """Days replaced by rows for all of them but one, and a day that is deleted."""
    path = scratch_path(spark, "replaced")
    events = _daily_events(spark, sf_dir)
    replace_partitions(events, path, cluster_by=["event_type"])
    days = [r[0] for r in events.where("snapshot_date >= DATE '2024-01-10'").select("snapshot_date").distinct().collect()]
    newer = events.where("event_type = 'purchase' AND snapshot_date <> DATE '2024-01-12'").withColumn("value", F.col("value") * 2)
    replace_partitions(newer.where(F.col("snapshot_date").isin(days)), path, cluster_by=["event_type"], covered=days)
    drop_partitions(spark, path, "snapshot_date", [date(2024, 1, 3)])
    return spark.read.schema(events.schema).parquet(path)


@query(
    "upsert_rows",
    """SELECT * FROM labels l WHERE toxic <> 1
    UNION ALL SELECT doc_id, 1 - quality, toxic FROM labels WHERE toxic = 1
    UNION ALL SELECT doc_id, CAST(0 AS INTEGER), CAST(0 AS INTEGER) FROM documents d
      WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def _upsert_rows(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    changed = labels.where("toxic = 1").withColumn("quality", 1 - F.col("quality"))
    new = table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left_anti")
    new = new.withColumns({"quality": F.lit(0), "toxic": F.lit(0)})
    return upsert(labels, changed.unionByName(new), ["doc_id"])


@query(
    "upsert_table",
    f"""SELECT event_id, snapshot_date, user_id, event_type,
      CASE WHEN event_type = 'error' AND snapshot_date >= DATE '2024-01-05' THEN -value ELSE value END AS value FROM ({_EVENTS})
    UNION ALL SELECT event_id + 1000000000, snapshot_date + 400, user_id, event_type, value FROM ({_EVENTS})
      WHERE event_type = 'signup'""",
)
def _upsert_table(spark, sf_dir):
    """Changed rows, rows on new days, and days the batch never touches."""
    path = scratch_path(spark, "upserted")
    events = _daily_events(spark, sf_dir)
    keys, order = ["event_id", "snapshot_date"], ["event_type"]
    upsert_table(spark, path, events, keys, cluster_by=order)
    changed = events.where("event_type = 'error' AND snapshot_date >= DATE '2024-01-05'")
    new = events.where("event_type = 'signup'").withColumns(
        {
            "event_id": F.col("event_id") + 1000000000,
            "snapshot_date": F.date_add("snapshot_date", 400),
        }
    )
    batch = changed.withColumn("value", -F.col("value")).unionByName(new)
    upsert_table(spark, path, batch, keys, cluster_by=order)
    return spark.read.schema(events.schema).parquet(path)


CUSTOMER_CSV = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
        T.StructField("effective_date", T.DateType()),
    ]
)


@query(
    "read_seed_csv",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
    CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS c_mktsegment,
    DATE '2024-07-01' + c_nationkey AS effective_date FROM customer""",
)
def _read_seed_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_acctbal",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS c_mktsegment",
        "date_add(DATE '2024-07-01', c_nationkey) AS effective_date",
    )
    customers.write.option("header", True).option("emptyValue", "").option("escape", '"').csv(path)
    return read_typed_csv(spark, path, CUSTOMER_CSV)


_FLAT_TITLE = """concat('#  "', coalesce(title, ''), '", ok', chr(10), 'new line  ')"""
_FLAT_COLUMNS = ["id", "title", "company", "state", "salary_min", "redirect_url"]


@query(
    "flat_csv",
    _sql([_RAW], f"""SELECT id, {_FLAT_TITLE} AS title, company_name AS company,
    CASE WHEN area_length >= 2 THEN area_state END AS state, salary_min, redirect_url FROM raw"""),
)
def _flat_csv(spark, sf_dir):
    """The flat file written and read back; titles begin with '#' and hold quotes, commas, blanks at
    both ends and line breaks."""
    path = scratch_path(spark, "flat")
    write_flat_sample(raw_postings(spark, sf_dir).withColumn("title", F.expr(_FLAT_TITLE)), path, compression="gzip")
    header = T.StructType([T.StructField(f.name, f.dataType) for f in flat_sample(raw_postings(spark, sf_dir)).schema.fields])
    return read_typed_csv(spark, path, header).select(*_FLAT_COLUMNS)


@query(
    "materialise_layers",
    f"SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM ({_EVENTS}) GROUP BY event_type",
)
def _materialise_layers(spark, sf_dir):
    """A partitioned, clustered, documented table under a view."""
    stored = materialise(
        _daily_events(spark, sf_dir),
        "daily_events",
        path=scratch_path(spark, "layers"),
        partition_by=["snapshot_date"],
        cluster_by=["event_type"],
        comments={"event_type": "what happened", "snapshot_date": "UTC day"},
    )
    view = materialise(
        stored.groupBy("snapshot_date", "event_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users")
        ),
        "events_per_day",
        kind="view",
    )
    return view.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("users").alias("users"))


@query(
    "published_views",
    f"""SELECT event_type, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users, 'events of a day' AS comment
    FROM ({_EVENTS}) GROUP BY event_type""",
)
def _published_views(spark, sf_dir):
    """A view over stored events in a schema of its own, found and read by another session."""
    path, layer = scratch_path(spark, "layers"), f"layer_{uuid.uuid4().hex}"
    materialise(_daily_events(spark, sf_dir), "daily_events", path=path, partition_by=["snapshot_date"])
    publish_view(
        spark,
        "events_per_day",
        f"SELECT snapshot_date, event_type, count(*) AS n, sum(user_id) AS users FROM parquet.`{path}/daily_events` GROUP BY ALL",
        layer=layer,
        comments={"n": "events of a day"},
    )
    other = spark.newSession()
    comment = other.table(f"{layer}.events_per_day").schema["n"].metadata["comment"]
    view = spark.table(f"{layer}.events_per_day")
    return view.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("users").alias("users"), F.lit(comment).alias("comment"))


@query("limit_of_many", f"SELECT * FROM ({_EVENTS}) ORDER BY snapshot_date DESC, event_id LIMIT (SELECT count(*) // 3 FROM events)")
def _limit_of_many(spark, sf_dir):
    """The newest third of all events, by ranges instead of one task."""
    events = _daily_events(spark, sf_dir)
    return top_rows(events, [F.col("snapshot_date").desc(), F.col("event_id")], events.count() // 3, limit_rows=100)


_EXPORTED = ["orders", "customer", "documents", "events", "labels"]


@query(
    "export_reconcile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS source_rows, count(*) AS target_rows, true AS ok FROM {t}"
        for t in _EXPORTED
    ),
)
def _export_reconcile(spark, sf_dir):
    tables = {name: table(spark, sf_dir, name) for name in _EXPORTED}
    return export_and_reconcile(spark, tables, scratch_path(spark, "export"))


TARGET_POSTING = T.StructType(
    [
        T.StructField("ID", T.StringType()),
        T.StructField("CREATED", T.TimestampNTZType()),
        T.StructField("SALARY_MIN", T.DoubleType()),
        T.StructField("LOCATION", T.VariantType()),
        T.StructField("COMPANY", T.VariantType()),
        T.StructField("LOADED_BY", T.StringType()),
    ]
)


@query(
    "export_loaded",
    _sql(
        [_RAW],
        """SELECT id, strftime(created, '%Y-%m-%d %H:%M:%S') AS created, salary_min, location_display AS place,
        CASE WHEN area_length >= 2 THEN area_state END AS state, company_name AS company, CAST(NULL AS VARCHAR) AS loaded_by FROM raw""",
    ),
)
def _export_loaded(spark, sf_dir):
    """A copy read back in the target's schema: names in other case, structs as variants, a column
    the copy lacks."""
    path = scratch_path(spark, "export")
    export_and_reconcile(spark, {"postings": raw_postings(spark, sf_dir)}, path)
    return load_copy(spark, path, "postings", TARGET_POSTING).select(
        F.col("ID").alias("id"),
        F.date_format("CREATED", "yyyy-MM-dd HH:mm:ss").alias("created"),
        F.col("SALARY_MIN").alias("salary_min"),
        F.try_variant_get("LOCATION", "$.display_name", "string").alias("place"),
        F.try_variant_get("LOCATION", "$.area[1]", "string").alias("state"),
        F.try_variant_get("COMPANY", "$.display_name", "string").alias("company"),
        F.col("LOADED_BY").alias("loaded_by"),
    )


@query(
    "export_variant",
    _sql(
        [_RAW],
        """SELECT id, redirect_url, strftime(created, '%Y-%m-%d %H:%M:%S') AS created, location_display AS place,
        CASE WHEN area_length >= 2 THEN area_state END AS state, company_name AS company FROM raw""",
    ),
)
def _export_variant(spark, sf_dir):
    """Nested columns as variants and instants without a zone, as the copy target keeps them."""
    copy = nested_to_variant(without_zone(raw_postings(spark, sf_dir)))
    return copy.select(
        "id",
        "redirect_url",
        F.date_format("created", "yyyy-MM-dd HH:mm:ss").alias("created"),
        F.try_variant_get("location", "$.display_name", "string").alias("place"),
        F.try_variant_get("location", "$.area[1]", "string").alias("state"),
        F.try_variant_get("company", "$.display_name", "string").alias("company"),
    )


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def _row_count(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query(
    "table_inventory",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES),
)
def _table_inventory(spark, sf_dir):
    return inventory({name: table(spark, sf_dir, name) for name in TABLES})


@query(
    "table_sizes",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count, true AS has_size FROM {t}" for t in TABLES),
)
def _table_sizes(spark, sf_dir):
    sizes = inventory_with_size(spark, {name: f"{sf_dir.rstrip('/')}/{name}.parquet" for name in TABLES})
    return sizes.select("table_name", "row_count", (F.col("size_bytes") > 0).alias("has_size"))


@query(
    "union_all_cities",
    "SELECT c_nationkey AS nationkey, c_name AS name FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier",
)
def _union_all(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_nationkey AS nationkey", "c_name AS name")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_name AS name", "s_nationkey AS nationkey")
    return customers.unionByName(suppliers)


@query(
    "union_distinct",
    "SELECT p_brand AS code, p_type AS name FROM part UNION SELECT p_brand, CASE WHEN p_size > 25 THEN p_type ELSE p_name END FROM part",
)
def _union_distinct(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    types = part.selectExpr("p_brand AS code", "p_type AS name")
    mixed = part.selectExpr("CASE WHEN p_size > 25 THEN p_type ELSE p_name END AS name", "p_brand AS code")
    return types.unionByName(mixed).distinct()


# --- data checks ------------------------------------------------------------------------------

_CHECKED = ["events", "documents", "labels", "orders", "lineitem", "customer", "conversations"]

DQ = {
    "dq_not_null": not_null("labelled", "quality"),
    "dq_unique": unique("lineitem", "l_orderkey"),
    "dq_accepted_values": accepted_values("customer", "c_mktsegment", ["BUILDING", "MACHINERY"], severity="warn"),
    "dq_relationship": relationship("documents", "doc_id", "labels", "doc_id"),
    "dq_expression": expression_is_true("labels", "toxic", "toxic = 0 OR quality = 1"),
    "dq_unique_combination": unique_combination("lineitem", "l_orderkey", "l_linenumber"),
}
ALL_DQ = [
    *DQ.values(),
    not_null("documents", "text"),
    not_null("orders", "o_orderkey"),
    unique("orders", "o_orderkey"),
    unique("documents", "text"),
    accepted_values("events", "event_type", ["view", "signup", "purchase", "click", "error"]),
    expression_is_true("lineitem", "l_discount", "l_discount BETWEEN 0 AND 0.05"),
    expression_is_true("customer", "c_acctbal", "c_acctbal >= 0", severity="warn"),
    relationship("labels", "doc_id", "documents", "doc_id"),
    relationship("orders", "o_custkey", "customer", "c_custkey"),
    unique_combination("conversations", "conv_id", "turn"),
    unique_combination("events", "user_id", "event_type"),
]


def _checked(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = {name: table(spark, sf_dir, name) for name in _CHECKED}
    documents = tables["documents"].select("doc_id", "lang", "source")
    return {**tables, "labelled": documents.join(tables["labels"], "doc_id", "left")}


_LABELLED = "(SELECT d.doc_id, lang, source, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"
_DQ_NAMES = {**{t: t for t in _CHECKED}, "labelled": _LABELLED}
_DQ_SQL = {
    "dq_not_null": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "dq_unique": "SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "dq_accepted_values": "SELECT c_custkey FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')",
    "dq_relationship": "SELECT doc_id FROM documents WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels)",
    "dq_expression": "SELECT doc_id FROM labels WHERE NOT (toxic = 0 OR quality = 1)",
    "dq_unique_combination": "SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
}
_DQ_KEEP = {"dq_not_null": ["doc_id"], "dq_accepted_values": ["c_custkey"], "dq_relationship": ["doc_id"], "dq_expression": ["doc_id"]}


def _register_checks() -> None:
    for key, check in DQ.items():

        def run(spark: SparkSession, sf_dir: str, key=key, check=check) -> DataFrame:
            found = failing_rows(check, _checked(spark, sf_dir))
            return found.select(*_DQ_KEEP[key]) if key in _DQ_KEEP else found

        query(key, _DQ_SQL[key])(run)


_register_checks()


@query(
    "dq_coverage",
    """SELECT * FROM (SELECT count(*) FILTER (l.doc_id IS NOT NULL) AS covered_rows, count(*) AS total_rows,
      count(*) FILTER (l.doc_id IS NOT NULL) / nullif(count(*), 0) AS coverage_ratio
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) WHERE coverage_ratio IS NULL OR coverage_ratio < 0.9""",
)
def _dq_coverage(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id").withColumn("has_label", F.lit(True))
    joined = documents.join(labels, "doc_id", "left")
    return failing_rows(coverage("joined", "has_label", 0.9), {"joined": joined})


@query("dq_report", report_sql(ALL_DQ, _DQ_NAMES))
def _dq_report(spark, sf_dir):
    return run_suite(_checked(spark, sf_dir), ALL_DQ)


@query(
    "dq_suite_result",
    f"""SELECT count(*) FILTER (status = 'pass') AS pass_count, count(*) FILTER (status = 'warn') AS warn_count,
    count(*) FILTER (status = 'fail') AS fail_count, count(*) FILTER (status = 'fail') = 0 AS suite_passed
    FROM ({report_sql(ALL_DQ, _DQ_NAMES)})""",
)
def _dq_suite_result(spark, sf_dir):
    return suite_result(run_suite(_checked(spark, sf_dir), ALL_DQ))
