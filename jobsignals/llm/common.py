"""Helpers that the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

import jobsignals
from jobsignals.rounds import free_rounds  # noqa: F401 - the operators take it from here
from jobsignals.session import scratch_path
from jobsignals.sources.files import remove

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Rows that Python handles at once; bounds its memory whatever the size of an Arrow batch.
SLICE_ROWS = 256


ARCHIVE = "jobsignals-package.zip"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once in a Spark context: Python workers import the
    functions of the operators from it, wherever they run."""
    context = spark.sparkContext
    if ARCHIVE in context._python_includes:
        return
    package = Path(jobsignals.__file__).parent
    path = Path(tempfile.mkdtemp()) / ARCHIVE
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted([*package.rglob("*.py"), *package.rglob("*.csv")]):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """``oracle`` is DuckDB SQL for the same rows; None where SQL cannot express the operator."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: the lineage ends here, and a lost
    executor costs only its running tasks."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove ``stored`` tables that nothing reads any more."""
    for table in tables:
        remove(table.sparkSession, table.scratch)


def body(name: str) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def bounded_sample(df: DataFrame, key: str, rows: int, most: int) -> DataFrame:
    """The ``most`` of ``rows`` rows whose hash of ``key`` is smallest.

    A bound on the hash leaves about twice as many, however large the table, before they are sorted.
    """
    position = F.xxhash64(key)
    if rows > 2 * most:
        df = df.where(position < F.lit(int(-(2**63) + 2**64 * (2 * most / rows))))
    return df.orderBy(position, key).limit(most)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def by_slice(function: Callable[..., Iterator[tuple] | list[tuple]], schema: pa.Schema):
    """A ``mapInArrow`` function from one that turns a slice's columns (lists) into result rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = list(function(*(part.column(i).to_pylist() for i in range(part.num_columns))))
            if rows:
                columns = zip(*rows)
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def with_values(df: DataFrame, text_col: str, name: str, kind: pa.DataType, function: Callable[[str | None], object]) -> DataFrame:
    """``df`` with column ``name``, new or in place of another, worked out from each row's text; the
    other columns pass through. Python holds the texts of a slice only."""
    names = df.columns if name in df.columns else [*df.columns, name]
    spark_kind = {pa.string(): T.StringType(), pa.float64(): T.DoubleType()}[kind]
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) if c != name else T.StructField(c, spark_kind) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            values = pa.array([function(t) for t in part.column(part.schema.get_field_index(text_col)).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([values if c == name else part.column(part.schema.get_field_index(c)) for c in names], names=names)

    return df.mapInArrow(run, schema)


def arrow_type(kind: str) -> pa.DataType:
    """The Arrow type of an id column of any simple type."""
    return to_arrow_type(T.DataType.fromDDL(kind))
