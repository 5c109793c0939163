"""From raw documents to packed training sequences: five stages, each a written table.

Rejected by toxicity, copies, near copies; then personal data is replaced, and what is left is
packed. ``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignals.llm.common import ship, stored, table
from jobsignals.llm.exact_dedup import drop_copies
from jobsignals.llm.packing import pack
from jobsignals.llm.pii import redact
from jobsignals.llm.simhash import first_of_similar
from jobsignals.llm.toxicity import fit_on_folds, score_toxicity

# Packing depends on a tokenizer and toxicity on a trained model, which SQL does not express.
ORACLE_SQL = None

SCORE = "__toxicity"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, learnt from the labels of the training folds."""
    ship(spark)
    model = fit_on_folds(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    score = SCORE
    while score in docs.columns:
        score += "_"
    return score_toxicity(docs, model, score_col=score).where(F.col(score) < 0.5).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts (five words, 0.8) the document with the smallest id."""
    ship(spark)
    return first_of_similar(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data gives way to the name of its kind, and ``n_chars`` follows the text."""
    ship(spark)
    changed = redact(docs)
    return changed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else changed


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    ship(spark)
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", replace_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
