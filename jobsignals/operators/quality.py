"""Declarative data checks.

Row checks (not_null, accepted_values, expression) of one table share a single scan: each is a
``count_if`` in one aggregate. Key checks aggregate the key, reference checks are anti joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from jobsignals.functions.values import ratio, share
from jobsignals.operators.aggregates import fill_rates
from jobsignals.operators.joins import orphans

ROW_KINDS = ("not_null", "accepted_values", "expression")


@dataclass(frozen=True)
class Check:
    """One check on one table. ``severity='warn'`` reports failures without failing the suite."""

    table: str
    kind: str
    columns: tuple[str, ...] = ()
    severity: str = "error"
    values: tuple = ()
    expression: str = ""
    parent: str = ""
    parent_column: str = ""
    threshold: float = 0.0
    label: str = field(default="")

    @property
    def name(self) -> str:
        return self.label or "_".join([self.kind, self.table, *self.columns])


def not_null(table: str, column: str, **more) -> Check:
    return Check(table, "not_null", (column,), **more)


def unique(table: str, column: str, **more) -> Check:
    return Check(table, "unique", (column,), **more)


def unique_combination(table: str, *columns: str, **more) -> Check:
    return Check(table, "unique_combination", columns, **more)


def accepted_values(table: str, column: str, values: Sequence, **more) -> Check:
    return Check(table, "accepted_values", (column,), values=tuple(values), **more)


def expression_is_true(table: str, column: str, expression: str, **more) -> Check:
    return Check(table, "expression", (column,), expression=expression, **more)


def relationship(table: str, column: str, parent: str, parent_column: str, **more) -> Check:
    return Check(table, "relationship", (column,), parent=parent, parent_column=parent_column, **more)


def coverage(table: str, column: str, threshold: float, **more) -> Check:
    return Check(table, "coverage", (column,), threshold=threshold, **more)


def violation(check: Check) -> Column:
    """True for a row that breaks a row check; NULL values and NULL results pass."""
    column = F.col(check.columns[0])
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return ~column.isin(list(check.values))
    if check.kind == "expression":
        return ~F.expr(check.expression)
    raise ValueError(f"{check.kind} is not a row check")


def coverage_totals(df: DataFrame, flag: str) -> DataFrame:
    totals = df.agg(F.count_if(F.col(flag)).alias("covered_rows"), F.count(F.lit(1)).alias("total_rows"))
    return totals.withColumn("coverage_ratio", ratio(F.col("covered_rows"), F.col("total_rows")))


def failing_rows(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows (or key groups) that break a check, for inspection."""
    df = tables[check.table]
    if check.kind in ROW_KINDS:
        return df.where(violation(check))
    if check.kind == "unique":
        df = df.where(F.col(check.columns[0]).isNotNull())
    if check.kind in ("unique", "unique_combination"):
        groups = df.groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n_records"))
        return groups.where("n_records > 1")
    if check.kind == "relationship":
        return orphans(df, check.columns[0], tables[check.parent], check.parent_column)
    if check.kind == "coverage":
        low = F.col("coverage_ratio").isNull() | (F.col("coverage_ratio") < check.threshold)
        return coverage_totals(df, check.columns[0]).where(low)
    raise ValueError(f"unknown check kind {check.kind}")


KEY_KINDS = ("unique", "unique_combination")


def _repeated(check: Check, groups: str = "_rows") -> Column:
    """Whether a group by the check's columns is a repeated key; NULL is no value of a unique column."""
    several = F.col(groups) > 1
    return several & F.col(check.columns[0]).isNotNull() if check.kind == "unique" else several


def _count_table_checks(df: DataFrame, checks: Sequence[Check], key: Check | None) -> DataFrame:
    """Row checks, and one key check, of a table in one pass: violations are counted per key, map
    side first, and added up over the keys."""
    counted = [F.count_if(violation(c)).alias(f"_c{i}") for i, c in enumerate(checks)]
    if key is not None:
        groups = df.groupBy(*key.columns).agg(F.count(F.lit(1)).alias("_rows"), *counted)
        counted = [F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(checks))]
        counted.append(F.count_if(_repeated(key)).alias(f"_c{len(checks)}"))
        df, checks = groups, [*checks, key]
    rows = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.severity).alias("severity"),
            F.col(f"_c{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return df.agg(*counted).select(F.inline(F.array(*rows)))


def _count_failures(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the failures of a check that is not a row check."""
    if check.kind != "relationship":
        return failing_rows(check, tables).agg(F.count(F.lit(1)).alias("failures"))
    # Counting the child values first keeps a hot value from being joined row by row.
    column = check.columns[0]
    values = tables[check.table].groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    lost = orphans(values, column, tables[check.parent], check.parent_column)
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))


class WatchedWrites:
    """Row checks that are counted while a table is written, so that they cost no scan.

    ``watch`` goes between a table and its write; ``failures`` then has the counts of the rows that
    this write had, which are all rows of the table if it was written whole.
    """

    def __init__(self, checks: Sequence[Check]):
        self.checks = [c for c in checks if c.kind in ROW_KINDS]
        self.seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, table: str) -> DataFrame:
        own = [c for c in self.checks if c.table == table]
        if not own:
            return df
        self.seen[table] = Observation()
        return df.observe(self.seen[table], *[F.count_if(violation(c)).alias(f"c{i}") for i, c in enumerate(own)])

    def failures(self) -> dict[Check, int]:
        found = {}
        for table, seen in self.seen.items():
            counts = seen.get
            found |= {c: counts[f"c{i}"] for i, c in enumerate(c for c in self.checks if c.table == table)}
        return found


def run_suite(tables: Mapping[str, DataFrame], checks: Sequence[Check], known: Mapping[Check, int] | None = None) -> DataFrame:
    """One row per check: name, table, severity, failures, status (pass, warn or fail).

    ``known`` has failures that were counted when tables were written; these checks read nothing. All
    other row checks of a table and its first key check share one scan and one shuffle.
    """
    known = dict(known or {})
    parts = []
    counted = [(c.name, c.table, c.severity, known[c]) for c in checks if c in known]
    if counted:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame(counted, "check_name string, table_name string, severity string, failures long"))
    checks = [c for c in checks if c not in known]
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        row_checks = [c for c in own if c.kind in ROW_KINDS]
        key = next((c for c in own if c.kind in KEY_KINDS), None)
        if row_checks or key:
            parts.append(_count_table_checks(tables[table], row_checks, key))
        for check in (c for c in own if c.kind not in ROW_KINDS and c is not key):
            parts.append(
                _count_failures(check, tables).select(
                    F.lit(check.name).alias("check_name"),
                    F.lit(check.table).alias("table_name"),
                    F.lit(check.severity).alias("severity"),
                    "failures",
                )
            )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn(
        "status",
        F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail"),
    )


def suite_result(report: DataFrame) -> DataFrame:
    """One row: checks passed, warned, failed, and whether the suite holds."""
    counts = report.agg(
        *[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in ("pass", "warn", "fail")]
    )
    return counts.withColumn("suite_passed", F.col("fail_count") == 0)


# Targets and floors of the source gate.
FILL_TARGETS = {
    "title": 1.00,
    "description": 0.95,
    "location": 0.95,
    "company": 0.80,
    "created": 1.00,
    "category": 0.80,
    "salary_min": 0.08,
    "salary_max": 0.08,
}
CORE_FLOORS = {"title": 0.99, "description": 0.95, "location": 0.95, "created": 0.99}
MIN_SOURCE_ROWS = 1500
MIN_SALARY_FILL = 0.08


def fill_gate(
    df: DataFrame, fields: Mapping[str, Column], targets: Mapping[str, float] = FILL_TARGETS
) -> DataFrame:
    """Fill rate, target and status (OK or LOW) per field; fields without a target are OK."""
    table = F.create_map(*[x for f, t in targets.items() for x in (F.lit(f), F.lit(float(t)))])
    return (
        fill_rates(df, fields)
        .withColumn("target", table[F.col("field")])
        .withColumn("status", F.when(F.col("fill_rate") < F.col("target"), "LOW").otherwise("OK"))
    )


def source_verdict(
    df: DataFrame,
    fields: Mapping[str, Column],
    core: Mapping[str, float] = CORE_FLOORS,
    salary: Sequence[str] = ("salary_min", "salary_max"),
    min_rows: int = MIN_SOURCE_ROWS,
    announced: Column | None = None,
    volume_only: bool = False,
) -> DataFrame:
    """GO, NEEDS-REVIEW or NO-GO in one row and one pass.

    Volume is the row count, or ``announced`` (an aggregate, such as the total a source reports).
    Salary fill is reported but does not decide. ``volume_only`` is the rule for several cities.
    """
    rows = F.count(F.lit(1)) if announced is None else announced
    rates = df.agg(rows.alias("total_rows"), *[share(p).alias(f"_{n}") for n, p in fields.items()])
    core_ok = F.lit(True)
    for name, floor in core.items():
        core_ok = core_ok & (F.coalesce(F.col(f"_{name}"), F.lit(0.0)) >= floor)
    salary_fill = F.lit(0.0)
    if salary:
        salary_fill = F.greatest(F.lit(0.0), *[F.col(f"_{n}") for n in salary])
    enough = F.col("total_rows") >= min_rows
    if volume_only:
        verdict = F.when(enough, "GO").otherwise("NO-GO")
    else:
        verdict = (
            F.when(enough & F.col("core_ok"), "GO").when(enough, "NEEDS-REVIEW").otherwise("NO-GO")
        )
    return rates.select(
        "total_rows",
        enough.alias("volume_ok"),
        core_ok.alias("core_ok"),
        (salary_fill >= MIN_SALARY_FILL).alias("salary_ok"),
    ).withColumn("verdict", verdict)
