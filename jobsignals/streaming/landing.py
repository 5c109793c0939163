"""Keep a table equal to the landing zone, folder by folder, as files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from jobsignals.schemas import RAW_POSTING, optional
from jobsignals.sources.landing import folders_of, landed_part
from jobsignals.sources.tables import replace_partitions

TABLE_PARTITIONS = ["snapshot_date", "source_city"]


def landed_stream(spark: SparkSession, path: str) -> DataFrame:
    """The folders (snapshot_date, city_slug) of files as they land, a row per posting."""
    schema = T.StructType([*optional(RAW_POSTING).fields, T.StructField("city_slug", T.StringType())])
    stream = spark.readStream.schema(schema).option("mode", "FAILFAST").json(path)
    return stream.select("snapshot_date", "city_slug")


def load_new_files(landed: DataFrame, landing: str, table_path: str, checkpoint: str) -> StreamingQuery:
    """Load what has landed since the last call and stop.

    New files only tell which folders changed. A batch reads those folders as they are now and
    replaces the same part of the table, so a city that landed again leaves no old rows, a batch that
    is repeated changes nothing, and files of one folder may come in several batches.
    """

    def load(batch: DataFrame, _: int) -> None:
        current = landed_part(batch.sparkSession, landing, folders_of(batch))
        replace_partitions(current, table_path, TABLE_PARTITIONS, [])

    return (
        landed.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
