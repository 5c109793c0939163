"""Exact dedup: group by a 128-bit content hash and compare the bytes inside a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import body, query, stored, table


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Grouping by (hash, text) compares bytes only between rows of equal hash, and combines copies
    before the shuffle, so that of a text a third of all rows share, a map task sends one row. The
    classes then lose their text; documents find theirs by narrow columns, and AQE splits a hot
    class of that join. ``keep`` says whether the smallest or the largest id of a class stays.

    Null text counts as empty. Null ids take part; an id stays before null does, and a class of
    null ids only keeps them. Rows repeating id and text are the same document and are treated
    alike. Other columns are not read. An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    rows = docs.select(F.col(id_col).alias("id"), body(text_col).alias("body")).select("id", "body", content_hash(F.col("body").cast("binary")).alias("hash"))
    pick = F.min("id") if keep == "smallest" else F.max("id")
    classes = rows.groupBy("hash", "body").agg(pick.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Texts of one hash that differ in their bytes are classes of their own, told apart by the second digest.
    classes = stored(classes.select("hash", F.sha2("body", 256).alias("sha"), "keep_id", "group_size"), "classes")
    members = rows.select("id", "hash", F.sha2("body", 256).alias("sha"))
    return members.join(classes, ["hash", "sha"]).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash: Callable[[Column], Column] = md5_128) -> DataFrame:
    """The rows of ``docs`` that stay: of equal texts the whole row with the smallest id, from the
    same groups by hash and bytes. Null text equals the empty one; a null id stays only if its class
    has no other; of rows equal in both one stays."""
    whole, order = F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.struct(F.col(id_col).isNull(), F.col(id_col))
    rows = docs.select(whole.alias("row"), order.alias("order"), body(text_col).alias("body"))
    kept = rows.groupBy(content_hash(F.col("body").cast("binary")).alias("hash"), "body").agg(F.min_by("row", "order").alias("row"))
    return kept.select("row.*")


@query(
    "op1_exact_dedup",
    """
    SELECT doc_id,
           max(doc_id) OVER same AS keep_id,
           count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept,
           sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")
