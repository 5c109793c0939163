"""Chat formatting with column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import body, query, table

TURN, TEXT, LEARN, NEXT, END = "<|turn|>", "<|text|>", "<|learn|>", "<|next|>", "<|end|>\n"


def escape(text: Column) -> Column:
    """Every marker holds a '<', and an escaped text holds none."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The inverse of ``escape``: a doubled backslash is cut out first, so none is read twice."""
    parts = F.split(text, r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\l"), F.lit("<"))), "\\")


def format_chat(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn_role: str = "assistant") -> DataFrame:
    """One row per conversation: its id and ``formatted``.

    The turns are collected as structs, sorted, and runs of one role share a block:
    ``<|turn|>role<|text|>first<|next|>second<|end|>``. Blocks of ``learn_role`` have ``<|learn|>``
    in place of ``<|text|>``: what stands from there to ``<|end|>`` is under the loss mask, markers
    excepted. Texts and roles are escaped, and ``read_back`` restores every turn exactly.

    Null text and null role count as empty. A null turn number sorts first, equal turn numbers sort
    by role, then text; repeated rows are repeated turns. Null ids form one conversation. Other
    columns are not read. A conversation is one string, so it has to fit into one row.
    """
    role = F.coalesce(F.col(role_col), F.lit(""))
    turn = F.struct(F.col(turn_col).alias("turn"), role.alias("role"), body(text_col).alias("text"))
    grouped = turns.select(F.col(conv_col).alias(conv_col), turn.alias("t")).groupBy(conv_col).agg(F.sort_array(F.collect_list("t")).alias("ts"))

    def piece(t: Column, i: Column) -> Column:
        first = ~F.coalesce(F.get("ts", i - 1)["role"] == t["role"], F.lit(False))
        last = ~F.coalesce(F.get("ts", i + 1)["role"] == t["role"], F.lit(False))
        mark = F.when(t["role"] == learn_role, F.lit(LEARN)).otherwise(F.lit(TEXT))
        head = F.when(first, F.concat(F.lit(TURN), escape(t["role"]), mark)).otherwise(F.lit(NEXT))
        return F.concat(head, escape(t["text"]), F.when(last, F.lit(END)).otherwise(F.lit("")))

    return grouped.select(conv_col, F.array_join(F.transform("ts", piece), "").alias("formatted"))


def read_back(formatted: Column) -> Column:
    """array<struct<role, learn, texts array>>, one element for each block of ``formatted``."""
    blocks = F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda b: b != "")
    body_of = r"(?s)^<\|turn\|>(.*?)<\|(text|learn)\|>(.*)$"
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescape(F.regexp_extract(b, body_of, 1)).alias("role"),
            (F.regexp_extract(b, body_of, 2) == "learn").alias("learn"),
            F.transform(F.split(F.regexp_extract(b, body_of, 3), r"<\|next\|>", -1), unescape).alias("texts"),
        ),
    )


# A conversation of control strings, which every run formats besides the table's own.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


@query(
    "op5_chat_formatting",
    r"""
    WITH rows AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
    ), sides AS (
        SELECT *, lag(role) OVER w IS DISTINCT FROM role AS first, lead(role) OVER w IS DISTINCT FROM role AS last
        FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
    )
    SELECT conv_id,
           count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length(replace(replace(text, '\', '\\'), '<', '\l'))
               + CASE WHEN first THEN length('<|turn|>') + length(replace(replace(role, '\', '\\'), '<', '\l'))
                      + CASE WHEN role = 'assistant' THEN 9 ELSE 8 END ELSE length('<|next|>') END
               + CASE WHEN last THEN 8 ELSE 0 END) AS BIGINT) AS formatted_chars
    FROM sides GROUP BY conv_id
    """,
)
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    blocks = format_chat(turns.unionByName(probe)).withColumn("blocks", read_back(F.col("formatted")))
    turn_texts = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t: F.concat(b["role"], F.lit("\n"), t, F.lit("\n")))))
    loss = F.array_join(F.flatten(F.transform(F.filter("blocks", lambda b: b["learn"]), lambda b: b["texts"])), "")
    return blocks.select("conv_id", turn_texts.alias("read"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars")).select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join("read", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
