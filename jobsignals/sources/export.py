"""Copies to another store with count reconciliation, and flat samples."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignals.functions.text import snippet
from jobsignals.functions.values import level


def without_zone(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps, the form the copy target stores."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def nested_to_variant(df: DataFrame) -> DataFrame:
    """Structs as variants, for a target with semi-structured columns; arrays stay arrays."""
    return df.select(
        *[
            F.to_variant_object(f.name).alias(f.name)
            if isinstance(f.dataType, T.StructType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def export_tables(tables: Mapping[str, DataFrame], path: str) -> dict[str, int]:
    """Write every table as Parquet under ``path/<name>``, replacing an earlier copy, and return the
    rows each source gave, counted while it was written."""
    counts = {}
    for name, df in tables.items():
        seen = Observation(f"export_{name}")
        counted = without_zone(df).observe(seen, F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
        counts[name] = seen.get["n"]
    return counts


def match_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Arrange loaded columns by name, ignoring case; a column the file lacks is NULL, and a struct
    becomes a variant where the schema asks for one."""
    own = {f.name.lower(): f for f in df.schema.fields}

    def loaded(field: T.StructField) -> Column:
        found = own.get(field.name.lower())
        if found is None:
            return F.lit(None).cast(field.dataType)
        if isinstance(field.dataType, T.VariantType) and isinstance(found.dataType, T.StructType):
            return F.to_variant_object(found.name)
        return F.col(found.name).cast(field.dataType)

    return df.select(*[loaded(f).alias(f.name) for f in schema.fields])


def load_copy(spark: SparkSession, path: str, name: str, schema: T.StructType) -> DataFrame:
    """A copied table in the schema of its target."""
    return match_columns(spark.read.parquet(f"{path.rstrip('/')}/{name}"), schema)


def reconcile(spark: SparkSession, source_rows: Mapping[str, int], path: str) -> DataFrame:
    """The rows the sources gave against the rows of their copies, read back from the target."""
    rows = []
    for name, source in source_rows.items():
        target = spark.read.parquet(f"{path.rstrip('/')}/{name}").count()
        rows.append((name, source, target, source == target))
    return spark.createDataFrame(rows, "table_name string, source_rows long, target_rows long, ok boolean")


def export_and_reconcile(spark: SparkSession, tables: Mapping[str, DataFrame], path: str) -> DataFrame:
    """Copy, count both sides and fail on a mismatch; returns the count report, a row per table."""
    report = reconcile(spark, export_tables(tables, path), path)
    wrong = [row["table_name"] for row in report.where("NOT ok").collect()]
    if wrong:
        raise RuntimeError(f"row counts differ after copying {wrong}")
    return report


def flat_sample(raw: DataFrame) -> DataFrame:
    """Raw postings as one flat row each, with a 240-character one-line description."""
    area = F.col("location.area")
    return raw.select(  # fixed values: the columns of the flat file
        "id",
        "title",
        F.col("company.display_name").alias("company"),
        F.col("location.display_name").alias("location_display"),
        level(area, 0).alias("country"),
        level(area, 1).alias("state"),
        level(area, 2).alias("city"),
        level(area, 3).alias("suburb"),
        F.col("category.label").alias("category"),
        "salary_min",
        "salary_max",
        "created",
        "redirect_url",
        snippet(F.col("description")).alias("description_snippet"),
    )


def write_flat_sample(raw: DataFrame, path: str, compression: str = "none") -> None:
    """The flat sample as CSV in the standard dialect; cells keep their blanks and line breaks."""
    (
        flat_sample(raw)
        .write.mode("overwrite")
        .option("header", True)
        .option("compression", compression)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
