"""Register a query under a key together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Result columns that are dates. Both sides show them as ISO text, because the two engines hand
# dates to Python in different types.
DATE_COLUMNS = {
    "postings_staged": ["snapshot_date", "posted_date"],
    "postings_enriched": ["snapshot_date", "posted_date"],
    "postings_mapped": ["snapshot_date", "posted_date"],
    "postings_mapped_join": ["snapshot_date"],
    "postings_pending": ["snapshot_date"],
    "postings_pending_sample": ["snapshot_date"],
    "postings_window": ["snapshot_date"],
    "postings_eval_sample": ["snapshot_date"],
    "dedupe_first": ["day"],
    "utc_dates": ["round_date"],
    "list_flags": ["effective_date"],
    "occupation_dim": ["effective_date"],
    "land_jsonl": ["snapshot_date"],
    "reland_city": ["snapshot_date"],
    "stream_landed": ["snapshot_date"],
    "stamp_batch": ["snapshot_date"],
    "append_snapshot": ["snapshot_date"],
    "limit_of_many": ["snapshot_date"],
    "replace_partition": ["snapshot_date"],
    "replace_with_nothing": ["snapshot_date"],
    "run_extraction": ["snapshot_date"],
    "upsert_table": ["snapshot_date"],
    "read_seed_csv": ["effective_date"],
}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """``oracle`` is DuckDB SQL over views named like the tables; None means rows only."""

    def register(function: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        dates = DATE_COLUMNS.get(key, [])

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = function(apply_settings(spark), sf_dir)
            return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df

        QUERIES[key] = run
        if oracle is not None:
            texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in dates)
            ORACLES[key] = f"SELECT * REPLACE ({texts}) FROM ({oracle}) AS q" if dates else oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sql_trim(text: str) -> str:
    """DuckDB's trim removes blanks only, so the oracles spell white space out as well."""
    return f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"


def sql_values(rows: list[dict], types: dict[str, str]) -> str:
    """A VALUES list with typed columns, for small reference tables inside an oracle."""

    def cell(value: str | None, kind: str) -> str:
        if value is None:
            return f"CAST(NULL AS {kind})"
        return f"CAST('{str(value).replace(chr(39), chr(39) * 2)}' AS {kind})"

    body = ",\n".join("(" + ", ".join(cell(r[c], k) for c, k in types.items()) + ")" for r in rows)
    return f"SELECT * FROM (VALUES\n{body}\n) AS v({', '.join(types)})"
