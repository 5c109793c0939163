"""Partitioned Parquet tables: append, replace, upsert, materialise, count, inventory."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignals.session import scratch_path
from jobsignals.sources.files import remove


# Smaller than the session's default by about a third, for tables that are kept and rewritten.
CODEC = "zstd"


def _layout(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Even files per partition (AQE splits a hot day), rows sorted for row-group skipping. A frame
    marked ``grouped`` reads files that hold one partition each: its rows stay in their tasks."""
    if partition_by and not getattr(df, "grouped", False):
        df = df.hint("rebalance", *partition_by)
    order = [*partition_by, *cluster_by]
    return df.sortWithinPartitions(*order) if order else df


def append_snapshot(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("snapshot_date",),
    cluster_by: Sequence[str] = ("source_city",),
) -> None:
    """Add rows to a partitioned table, creating it on first use."""
    _layout(df, partition_by, cluster_by).write.mode("append").option("compression", CODEC).partitionBy(*partition_by).parquet(path)


def replace_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("snapshot_date",),
    cluster_by: Sequence[str] = ("source_city",),
    covered: Sequence[object] | None = None,
) -> None:
    """Overwrite the partitions that ``df`` has rows for; a re-run changes nothing.

    ``covered`` lists the values of the first partition column that ``df`` speaks for: those it has
    no rows of are deleted, so replacing a day with nothing leaves nothing. The write itself reports
    which values it had (no more than the partitions it made); ``df`` is worked out once.
    """
    first, seen = partition_by[0], Observation()
    rows = df if covered is None else df.observe(seen, F.collect_set(F.col(first).cast("string")).alias("written"))
    (
        _layout(rows, partition_by, cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy(*partition_by)
        .parquet(path)
    )
    if covered is not None:
        written = set(seen.get["written"])
        drop_partitions(df.sparkSession, path, first, [v for v in covered if str(v) not in written])


def drop_partitions(spark: SparkSession, path: str, partition: str, values: Sequence[object]) -> None:
    """Delete whole partitions, by values without characters that paths escape (dates, codes)."""
    for value in values:
        remove(spark, f"{path.rstrip('/')}/{partition}={value}")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A Parquet table with its declared schema, None when it does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a new version, plus the whole batch."""
    return target.join(batch.select(*keys), list(keys), "left_anti").unionByName(batch)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Two batch rows for one key would make an upsert ambiguous: refuse them."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
    if repeated:
        raise ValueError(f"batch holds several rows for one key of {list(keys)}")


def one_of(column: str, values: Iterable[object]) -> Column:
    """A literal predicate that a scan knows before it starts, so that partitions are pruned; None
    among the values stands for NULL."""
    values = list(values)
    found = F.col(column).isin([v for v in values if v is not None])
    return found | F.col(column).isNull() if None in values else found


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str] = ("job_id", "snapshot_date"),
    partition: str = "snapshot_date",
    cluster_by: Sequence[str] = ("sponsorship_signal", "remote_friendly"),
) -> None:
    """Insert or replace ``batch`` by ``keys`` in a table partitioned by one of them.

    The batch is written to the shared folder first, so that an expensive extractor runs once and
    a lost executor never repeats it. Its partitions (their values come to the driver) become literals
    of the scan: others are neither read nor rewritten. The merged rows are staged as well: the table
    is never read and overwritten in one plan. Both copies are removed afterwards, also when something
    fails, but for the merged rows of a commit that failed: it deletes a partition's old files before
    it moves the new ones in, and may be repeated from that copy, which the error names.
    """
    if partition not in keys:
        raise ValueError("the partition column must be part of the key")
    batch_path, merged_path = scratch_path(spark, "batch"), scratch_path(spark, "merged")
    try:
        days = Observation()
        batch.observe(days, F.collect_set(partition).alias("days"), F.count_if(F.col(partition).isNull()).alias("nulls")).write.parquet(batch_path)
        batch = spark.read.schema(batch.schema).parquet(batch_path)
        assert_unique(batch, keys)
        target = read_table(spark, path, batch.schema)
        if target is None:
            append_snapshot(batch, path, [partition], cluster_by)
            return
        touched = [*days.get["days"], *([None] if days.get["nulls"] else [])]
        target = target.where(one_of(partition, touched)).select(*batch.columns)
        try:
            upsert(target, batch, keys).write.parquet(merged_path)
        except BaseException:
            remove(spark, merged_path)
            raise
        merged = spark.read.schema(batch.schema).parquet(merged_path)
        try:
            replace_partitions(merged, path, [partition], cluster_by)
        except Exception as exc:
            exc.add_note(f"the merged rows of the partitions that were being replaced are kept in {merged_path}")
            raise
        remove(spark, merged_path)
    finally:
        remove(spark, batch_path)


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column documentation; a saved table keeps it as column comments."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
            for c in df.columns
        ]
    )


def materialise(
    df: DataFrame,
    name: str,
    kind: str = "table",
    layer: str | None = None,
    path: str | None = None,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    comments: Mapping[str, str] | None = None,
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    analyse: bool = False,
) -> DataFrame:
    """Publish a layer as a session's view or a written table and return a DataFrame that reads it;
    ``publish_view`` makes views that outlive the session.

    With ``path`` the table is Parquet files there; otherwise it is saved in the catalog under
    ``layer.name``, exactly as named, or under ``name`` in the current schema. A catalog table may be
    cut into ``buckets`` by ``bucket_by``: tables of equal buckets join on these columns without a
    shuffle. ``analyse`` stores statistics of all its columns, from which Spark plans joins and
    ``catalog_inventory`` reads sizes.
    """
    spark = df.sparkSession
    if comments:
        df = with_comments(df, comments)
    if kind == "view":
        if layer:
            raise ValueError("a view of a layer is made by publish_view, from its SQL")
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if path and (bucket_by or analyse):
        raise ValueError("buckets and statistics belong to catalog tables")
    if bucket_by and not partition_by:
        # One task per bucket writes one file, already in the order that a join needs.
        df = df.repartition(buckets, *bucket_by)
        writer = df.write.mode("overwrite")
    else:
        writer = _layout(df, partition_by, cluster_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        target = f"{path.rstrip('/')}/{name}"
        writer.parquet(target)
        return spark.read.schema(df.schema).parquet(target)
    table = _in_layer(spark, name, layer)
    writer.format("parquet").saveAsTable(table)
    if analyse:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.table(table)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _in_layer(spark: SparkSession, name: str, layer: str | None) -> str:
    """The name of a table in the schema of its layer, which is made on first use."""
    if not layer:
        return _quoted(name)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(layer)}")
    return f"{_quoted(layer)}.{_quoted(name)}"


def publish_view(
    spark: SparkSession,
    name: str,
    sql: str,
    layer: str | None = None,
    comments: Mapping[str, str] | None = None,
    comment: str | None = None,
) -> DataFrame:
    """Create or replace a view in the catalog, in the schema of its layer exactly as named: other
    sessions find it there, with its documentation, and its SQL is run anew on what the tables hold."""

    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    documented = comments or {}
    columns = spark.sql(sql).columns
    unknown = set(documented) - set(columns)
    if unknown:
        raise ValueError(f"comments on columns the view does not have: {sorted(unknown)}")
    shown = ", ".join(_quoted(c) + (f" COMMENT {text(documented[c])}" if c in documented else "") for c in columns)
    about = f" COMMENT {text(comment)}" if comment else ""
    view = _in_layer(spark, name, layer)
    spark.sql(f"CREATE OR REPLACE VIEW {view} ({shown}){about} AS {sql}")
    return spark.table(view)


def catalog_inventory(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Rows and size per analysed catalog table, from the catalog's statistics: nothing is scanned.
    A table without statistics has NULLs."""
    rows = []
    for table in tables:
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
        numbers = re.fullmatch(r"(\d+) bytes(?:, (\d+) rows)?", described.get("Statistics", ""))
        size, count = numbers.groups() if numbers else (None, None)
        rows.append((table, int(count) if count else None, int(size) if size else None))
    return spark.createDataFrame(rows, "table_name string, row_count long, size_bytes long")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    parts = [
        row_count(df).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def inventory_with_size(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows and file size per table, for tables given by their path.

    Sizes come from the file listing alone, without opening a file, so files without rows count too.
    """
    parts = []
    for name, path in paths.items():
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
        size = listed.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))
        rows = row_count(spark.read.parquet(path))
        parts.append(
            rows.crossJoin(size).select(
                F.lit(name).alias("table_name"),
                "row_count",
                "size_bytes",
                F.round(F.col("size_bytes") / F.lit(1024 * 1024), 2).alias("size_mb"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
