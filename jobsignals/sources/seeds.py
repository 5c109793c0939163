"""Reference tables with pinned types; empty cells are NULL."""

from __future__ import annotations

import csv
import io
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignals.schemas import SEEDS

def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with a header in shared storage, in the standard dialect: quotes are doubled, quoted
    cells may hold commas, blanks and line breaks. A cell that does not fit its type fails the read.

    Line breaks in cells mean that a file is read by one task; large tables come as many files.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def read_seed(spark: SparkSession, name: str, path: str) -> DataFrame:
    return read_typed_csv(spark, path, SEEDS[name])


def bundled_rows(name: str) -> list[dict[str, str | None]]:
    """Rows of a small table shipped with the package, empty cells as None."""
    text = resources.files("jobsignals").joinpath("seeds", f"{name}.csv").read_text("utf-8")
    return [{k: v or None for k, v in row.items()} for row in csv.DictReader(io.StringIO(text, newline=""))]


def title_pattern_rows() -> list[dict]:
    """The shipped title patterns as rows with whole-number priorities."""
    rows = bundled_rows("anzsco_title_patterns")
    return [{**r, "priority": None if r["priority"] is None else int(r["priority"])} for r in rows]


def bundled_seed(spark: SparkSession, name: str) -> DataFrame:
    """A shipped table as a local relation, whose exact size the optimizer knows."""
    schema = SEEDS[name]
    rows = bundled_rows(name)
    columns = {f.name: pa.array([r[f.name] for r in rows], pa.string()) for f in schema.fields}
    return spark.createDataFrame(pa.table(columns)).select(
        *[F.col(f.name).cast(f.dataType) for f in schema.fields]
    )


def bundled_seeds(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: bundled_seed(spark, name) for name in SEEDS}
