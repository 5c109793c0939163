"""Judging a sample of extractions and tallying the verdicts."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignals.functions.text import snippet
from jobsignals.functions.values import ratio
from jobsignals.operators.calls import Caller, CallPolicy
from jobsignals.operators.spread import spread

# Verdicts, gate and message length of the evaluation.
VERDICTS = ["correct", "incorrect", "uncertain"]
ACCURACY_GATE = 0.80
MAX_JUDGE_ERROR = 300

_JUDGMENT = T.StructType(
    [T.StructField("verdict", T.StringType()), T.StructField("reasoning", T.StringType())]
)


def judge(
    sample: DataFrame,
    judge_fn: Callable[[str, dict], dict],
    fields: Sequence[str],
    text: str = "description_text",
    parallelism: int | None = None,
    policy: CallPolicy = CallPolicy(),
) -> DataFrame:
    """Add one ``<field>_judgment`` struct per field, and ``error`` for rows that were not judged.

    ``judge_fn(text, extraction)`` returns ``{field: {"verdict": ..., "reasoning": ...}}``. A call
    that raises, or an answer that misses a field or uses an unknown verdict, makes that row an
    error row; the task goes on. Rows are dealt out to ``parallelism`` tasks, by default as many as
    the cluster runs at once; each keeps calls open and tries them again as ``policy`` says.
    """
    names = list(fields)
    columns = sample.columns
    sample = spread(sample, parallelism)

    def given(part: pa.RecordBatch) -> Iterator[tuple]:
        at, extraction = (part.schema.get_field_index(c) for c in (text, "_extraction"))
        return zip(part.column(at).to_pylist(), map(json.loads, part.column(extraction).to_pylist()))

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Caller(judge_fn, policy) as caller:
            for part, outcomes in caller.outcomes_by_slice(batches, given):
                answers, errors = [], []
                for answer, error in outcomes:
                    try:
                        answers.append(None if error else json.dumps(answer))
                        errors.append(str(error) if error else None)
                    except (TypeError, ValueError) as exc:
                        answers.append(None)
                        errors.append(str(exc))
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                found = [pa.array(answers, pa.string()), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays([*kept, *found], names=[*part.schema.names[:-1], "_answer", "_failure"])

    packed = sample.withColumn(
        "_extraction", F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    )
    out = T.StructType(
        [*sample.schema.fields, T.StructField("_answer", T.StringType()), T.StructField("_failure", T.StringType())]
    )
    answered = packed.mapInArrow(call, out).withColumn(
        "_parsed",
        F.from_json("_answer", T.StructType([T.StructField(n, _JUDGMENT) for n in names])),
    )
    complete = F.lit(True)
    for n in names:
        complete = (
            complete
            & F.coalesce(F.col(f"_parsed.{n}.verdict").isin(VERDICTS), F.lit(False))
            & F.col(f"_parsed.{n}.reasoning").isNotNull()
        )
    failure = F.when(
        F.col("_failure").isNotNull() | ~complete,
        F.substring(F.coalesce("_failure", F.lit("invalid judgment")), 1, MAX_JUDGE_ERROR),
    )
    return answered.withColumn("error", failure).select(
        *columns,
        *[F.when(F.col("error").isNull(), F.col(f"_parsed.{n}")).alias(f"{n}_judgment") for n in names],
        "error",
    )


def _verdict(field: str) -> Column:
    return F.col(f"{field}_judgment.verdict")


def verdict_tallies(judged: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Per field: correct, incorrect, uncertain, accuracy (NULL when nothing was decided).

    One pass over the rows; the fields are laid out as rows only after counting.
    """
    names = list(fields)
    wide = judged.where(F.col("error").isNull()).agg(
        *[
            F.count_if(_verdict(n) == v).alias(f"_{i}_{v}")
            for i, n in enumerate(names)
            for v in VERDICTS
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("field"), *[F.col(f"_{i}_{v}").alias(v) for v in VERDICTS])
            for i, n in enumerate(names)
        ]
    )
    return wide.select(F.inline(rows)).withColumn(
        "accuracy", ratio(F.col("correct"), F.col("correct") + F.col("incorrect"))
    )


def judge_accuracy(judged: DataFrame, fields: Sequence[str], gate: float = ACCURACY_GATE) -> DataFrame:
    """One row: judged and failed rows, overall accuracy without 'uncertain', gate result."""

    def tally(verdict: str) -> Column:
        hits = [F.count_if(F.col("error").isNull() & (_verdict(n) == verdict)) for n in fields]
        return sum(hits[1:], hits[0])

    totals = judged.agg(
        F.count_if(F.col("error").isNull()).alias("judged_rows"),
        F.count_if(F.col("error").isNotNull()).alias("failed_rows"),
        tally("correct").alias("correct"),
        (tally("correct") + tally("incorrect")).alias("decided"),
    )
    accuracy = F.coalesce(ratio(F.col("correct"), F.col("decided")), F.lit(0.0))
    return totals.withColumn("overall_accuracy", accuracy).withColumn(
        "passed", F.col("overall_accuracy") >= gate
    )


def failure_examples(
    judged: DataFrame,
    fields: Sequence[str],
    order: Sequence[Column],
    n: int = 5,
    text: str = "description_text",
    keep: Sequence[str] = ("job_id", "job_title"),
) -> DataFrame:
    """First ``n`` rows with an incorrect verdict, with the fields, values and reasons at fault."""
    found = F.filter(
        F.array(
            *[
                F.struct(
                    F.lit(f).alias("field"),
                    F.col(f).cast("string").alias("value"),
                    F.col(f"{f}_judgment.reasoning").alias("reasoning"),
                    _verdict(f).alias("verdict"),
                )
                for f in fields
            ]
        ),
        lambda x: x["verdict"] == "incorrect",
    )
    faults = F.transform(
        found,
        lambda x: F.struct(
            x["field"].alias("field"), x["value"].alias("value"), x["reasoning"].alias("reasoning")
        ),
    )
    return (
        judged.where(F.col("error").isNull())
        .withColumn("faults", faults)
        .where(F.size("faults") > 0)
        .orderBy(*order)
        .limit(n)
        .select(*keep, snippet(F.col(text)).alias("snippet"), "faults")
    )


def run_evaluation(
    sample: DataFrame,
    judge_fn: Callable[[str, dict], dict],
    fields: Sequence[str],
    order: Sequence[Column],
    path: str,
    text: str = "description_text",
    keep: Sequence[str] = ("job_id", "job_title"),
    gate: float = ACCURACY_GATE,
    parallelism: int | None = None,
    policy: CallPolicy = CallPolicy(),
) -> dict[str, DataFrame]:
    """Judge every row of ``sample`` once, store the rows under ``path`` and derive the reports from
    them: ``judged``, ``tallies``, ``accuracy`` and ``examples``."""
    rows = judge(sample, judge_fn, fields, text, parallelism, policy)
    rows.write.mode("overwrite").parquet(path)
    judged = sample.sparkSession.read.schema(rows.schema).parquet(path)
    return {
        "judged": judged,
        "tallies": verdict_tallies(judged, fields),
        "accuracy": judge_accuracy(judged, fields, gate),
        "examples": failure_examples(judged, fields, order, text=text, keep=keep),
    }
