from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from jobsignals.operators.aggregates import discrete_medians, group_rates, item_counts
from jobsignals.operators.evaluation import failure_examples, judge, judge_accuracy, run_evaluation, verdict_tallies
from jobsignals.operators.joins import enrich, orphans, pending_rows
from jobsignals.operators.patterns import map_by_pattern
from jobsignals.operators.quality import (
    accepted_values,
    coverage,
    expression_is_true,
    failing_rows,
    not_null,
    relationship,
    run_suite,
    unique,
    unique_combination,
)
from jobsignals.operators.ranking import keep_first, top_k_per_group, top_rows

# --- ranking ----------------------------------------------------------------------------------


def test_keep_first_and_top_k_against_brute_force_with_a_hot_key(spark):
    """One key holds a third of all rows."""
    rng = random.Random(7)
    rows = [(0 if rng.random() < 0.34 else rng.randrange(50), rng.randrange(1000), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, v long, id long").repartition(8)
    expected = {}
    for k, v, i in rows:
        expected.setdefault(k, []).append((v, i))
    first = {r.k: (r.v, r.id) for r in keep_first(df, ["k"], [F.col("v"), F.col("id")]).collect()}
    assert first == {k: min(group) for k, group in expected.items()}
    top = top_k_per_group(df, ["k"], [F.col("v").desc(), F.col("id")], 3).collect()
    for k, group in expected.items():
        mine = sorted((-r.v, r.id) for r in top if r.k == k)
        assert mine == sorted((-v, i) for v, i in group)[:3]


def test_rank_filter_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    plan = plan_text(keep_first(df, ["k"], [F.col("id")]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_top_rows(spark):
    df = spark.range(10)
    assert [r.id for r in top_rows(df, [F.col("id").desc()], 2).collect()] == [9, 8]
    assert "Sort" not in plan_text(top_rows(df, [F.col("id").desc()], 0))


# --- joins ------------------------------------------------------------------------------------


def test_enrich_filters_before_joining(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    right = spark.createDataFrame([(1, "ok"), (2, "error")], "id long, status string")
    rows = {r.id: r for r in enrich(left, right, ["id"], F.col("status") == "ok", "found").collect()}
    assert [rows[i].found for i in (1, 2, 3)] == [True, False, False]
    assert rows[2].status is None


def test_pending_and_orphans(spark):
    rows = spark.createDataFrame([(1, "x" * 20), (2, "x" * 19), (3, None), (4, "y" * 30)], "id long, body string")
    done = spark.createDataFrame([(4,)], "id long")
    assert [r.id for r in pending_rows(rows, done, ["id"], "body", 20).collect()] == [1]
    child = spark.createDataFrame([("a",), (None,), ("b",), ("b",)], "code string")
    parent = spark.createDataFrame([("a",), (None,)], "key string")
    assert [r.code for r in orphans(child, "code", parent, "key").collect()] == ["b", "b"]


# --- patterns ---------------------------------------------------------------------------------

WORDS = ["data", "web", "test", "lead", "cloud", "nurse", "senior", "engineer", "analyst", "developer"]


def random_patterns(rng, n):
    found = []
    for _ in range(n):
        alternatives = [" ".join(rng.sample(WORDS, rng.choice([1, 2]))) for _ in range(rng.choice([1, 2, 3]))]
        code = rng.choice([None, *"ABCDEFG"]) if rng.random() < 0.1 else rng.choice("ABCDEFG")
        found.append((rng.choice([1, 1, 2, 3, None]), code, "|".join(alternatives).replace(" ", ".?")))
    return found


def brute_force(title, patterns):
    if title is None:
        return None
    hits = [p for p in patterns if re.search(p[2], title.lower())]
    hits.sort(key=lambda p: (p[0] is None, p[0] or 0, p[1] is not None, p[1] or "", p[2]))
    return hits[0][1] if hits else None


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pattern_methods_agree_with_brute_force(spark, seed):
    rng = random.Random(seed)
    patterns = random_patterns(rng, 25)
    titles = [(i, None if rng.random() < 0.1 else " ".join(rng.sample(WORDS, 3)).title()) for i in range(300)]
    titles += [(1000 + i, "Senior Data Engineer") for i in range(150)]  # a hot title
    titles += [(2000 + i, None) for i in range(150)]
    df = spark.createDataFrame(titles, "id long, title string").repartition(4)
    table = spark.createDataFrame(patterns, "priority long, anzsco_code string, title_pattern string")
    rows_of_patterns = [dict(zip(("priority", "anzsco_code", "title_pattern"), p)) for p in patterns]
    expected = {i: brute_force(t, patterns) for i, t in titles}
    for given, cells in [(rows_of_patterns, None), (table, None), (table, (2, 3)), (table, (7, 1))]:
        mapped = map_by_pattern(df, F.lower("title"), given, cells=cells)
        assert mapped.columns == ["id", "title", "anzsco_code"]
        rows = mapped.collect()
        assert len(rows) == len(titles)
        assert {r.id: r.anzsco_code for r in rows} == expected, cells


def test_lists_of_literals_are_looked_up(spark):
    rng = random.Random(5)
    words = ["engineer", "analyst", "data", "web dev", "a.b", "engine", "alyst da"]
    patterns = [(i % 4 or None, "ABCD"[i % 4], "|".join(rng.sample(words, rng.choice([1, 2])))) for i in range(30)]
    titles = [(i, " ".join(rng.sample(["data engineer", "analyst data", "web dev", "axb", "engin", "é analyst", ""], 2))) for i in range(120)]
    table = spark.createDataFrame(patterns, "priority long, anzsco_code string, title_pattern string")
    df = spark.createDataFrame(titles, "id long, title string")
    got = {r.id: r.anzsco_code for r in map_by_pattern(df, F.lower("title"), table).collect()}
    assert got == {i: brute_force(t, patterns) for i, t in titles}


def test_the_kind_of_argument_decides_the_plan(spark):
    df = spark.createDataFrame([("web x7",), ("none",)], "title string")
    for n in (20, 5200):
        table = spark.range(n).selectExpr(
            "id AS priority", "CAST(id AS string) AS anzsco_code", "concat('x', id, '$') AS title_pattern"
        )
        joined = map_by_pattern(df, F.col("title"), table)
        assert "NestedLoop" not in plan_text(joined) and "Cartesian" not in plan_text(joined)
        assert {r.title: r.anzsco_code for r in joined.collect()} == {"web x7": "7", "none": None}
    rows = [{"priority": i, "anzsco_code": str(i), "title_pattern": f"x{i}$"} for i in range(300)]
    inline = map_by_pattern(df, F.col("title"), rows)
    assert "Exchange" not in plan_text(inline) and "Join" not in plan_text(inline)
    assert {r.title: r.anzsco_code for r in inline.collect()} == {"web x7": "7", "none": None}


def test_no_patterns_at_all(spark):
    df = spark.createDataFrame([("a",)], "title string")
    empty = spark.createDataFrame([], "priority long, anzsco_code string, title_pattern string")
    for given in (empty, []):
        assert map_by_pattern(df, F.col("title"), given).first().anzsco_code is None


# --- aggregates -------------------------------------------------------------------------------


def test_group_rates_suppress_small_groups_and_ignore_null_flags(spark):
    df = spark.createDataFrame([("a", True), ("a", None), ("a", False), ("b", True)], "k string, f boolean")
    rows = group_rates(df, ["k"], "n", {"hits": F.col("f")}, {"rate": "hits"}, 2).collect()
    assert [tuple(r) for r in rows] == [("a", 3, 1, 1 / 3)]


def test_item_counts_against_brute_force(spark):
    rng = random.Random(3)
    spellings = ["SQL", "sql", " Sql ", "Go", "go\t", "", "  ", None, "R"]
    rows = []
    for i in range(400):
        items = rng.choice([None, [], [rng.choice(spellings) for _ in range(rng.randrange(6))]])
        rows.append((rng.choice(["hot", "hot", "a", "b", None]), rng.choice(["x", "y", None]), items))
    df = spark.createDataFrame(rows, "g string, city string, items array<string>").repartition(4)
    expected = {}
    for group, city, items in rows:
        for item in items or []:
            if group is not None and item is not None and item.strip():
                entry = expected.setdefault((group, item.strip().lower()), [[], set()])
                entry[0].append(item)
                entry[1].add(city)
    expected = {
        k: (min(names), len(names), len(cities - {None}))
        for k, (names, cities) in expected.items()
        if len(names) >= 3
    }
    result = item_counts(df, "g", "items", "city", min_mentions=3).collect()
    assert {(r.g, r.skill): (r.skill_display, r.mention_count, r.cities_mentioned_in) for r in result} == expected


# --- evaluation -------------------------------------------------------------------------------


def verdict_by_text(text, extraction):
    if text == "fail":
        raise RuntimeError("y" * 1000)
    if text == "partial":
        return {"skills": {"verdict": "correct", "reasoning": "r"}}
    if text == "odd":
        return {f: {"verdict": "perhaps", "reasoning": "r"} for f in ("skills", "years")}
    years = "uncertain" if text == "unsure" else "incorrect" if extraction["years"] is None else "correct"
    return {
        "skills": {"verdict": "uncertain" if text == "unsure" else "correct", "reasoning": "s"},
        "years": {"verdict": years, "reasoning": "no years"},
    }


@pytest.fixture(scope="module")
def judged(spark):
    rows = [("1", "T", "good", ["a"], 3), ("2", "T", "good", [], None), ("3", "T", "fail", [], 1), ("4", "T", "partial", [], 1), ("5", "T", "odd", [], 1), ("6", "T", "unsure", [], 1)]
    sample = spark.createDataFrame(
        rows, "job_id string, job_title string, description_text string, skills array<string>, years long"
    )
    return judge(sample, verdict_by_text, ["skills", "years"])


def test_judging_isolates_failures(judged):
    rows = {r.job_id: r for r in judged.collect()}
    assert rows["1"].error is None and rows["1"].years_judgment.verdict == "correct"
    assert len(rows["3"].error) == 300 and rows["3"].skills_judgment is None
    assert rows["4"].error == rows["5"].error == "invalid judgment"


def test_tallies_accuracy_and_examples(judged):
    tallies = {r.field: tuple(r)[1:] for r in verdict_tallies(judged, ["skills", "years"]).collect()}
    assert tallies == {"skills": (2, 0, 1, 1.0), "years": (1, 1, 1, 0.5)}
    row = judge_accuracy(judged, ["skills", "years"]).first()
    assert (row.judged_rows, row.failed_rows, row.correct, row.decided) == (3, 3, 3, 4)
    assert row.overall_accuracy == 0.75 and row.passed is False
    assert judge_accuracy(judged, ["skills", "years"], gate=0.75).first().passed is True
    examples = failure_examples(judged, ["skills", "years"], [F.col("job_id")]).collect()
    assert [r.job_id for r in examples] == ["2"]
    assert [tuple(f) for f in examples[0].faults] == [("years", None, "no years")]


def test_nothing_decided(judged):
    unsure = judged.where("job_id = '6'")
    assert verdict_tallies(unsure, ["skills"]).first().accuracy is None
    row = judge_accuracy(unsure, ["skills", "years"]).first()
    assert row.overall_accuracy == 0.0 and row.passed is False


# --- data checks ------------------------------------------------------------------------------


def test_every_kind_of_check(spark):
    child = spark.createDataFrame(
        [(1, "a", 5), (1, "b", -1), (None, "z", None), (None, "a", 2), (2, None, 3), (3, "a", 0)],
        "id long, code string, n long",
    )
    parent = spark.createDataFrame([("a",), ("b",)], "code string")
    tables = {"child": child, "parent": parent, "empty": child.where("false").withColumn("f", F.lit(True))}
    checks = [
        not_null("child", "id"),
        unique("child", "id"),
        unique_combination("child", "id", "code"),
        unique_combination("child", "id"),
        accepted_values("child", "code", ["a", "b"], severity="warn"),
        expression_is_true("child", "n", "n >= 0"),
        relationship("child", "code", "parent", "code"),
        coverage("empty", "f", 0.9),
    ]
    report = {r.check_name: (r.failures, r.status) for r in run_suite(tables, checks).collect()}
    assert report == {
        "not_null_child_id": (2, "fail"),
        "unique_child_id": (1, "fail"),
        "unique_combination_child_id_code": (0, "pass"),
        "unique_combination_child_id": (2, "fail"),  # NULL keys equal each other
        "accepted_values_child_code": (1, "warn"),
        "expression_child_n": (1, "fail"),
        "relationship_child_code": (1, "fail"),
        "coverage_empty_f": (1, "fail"),
    }
    for check in checks[:-1]:
        assert failing_rows(check, tables).count() == report[check.name][0]


def test_row_checks_of_a_table_share_one_scan(spark, tmp_path):
    spark.range(10).withColumn("n", F.col("id")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    report = run_suite({"t": df}, [not_null("t", "id"), expression_is_true("t", "n", "n < 5"), accepted_values("t", "n", [1])])
    assert plan_text(report).count("FileScan") == 1


@pytest.mark.parametrize("n", [1, 2, 7, 400_001])
def test_medians_are_exact_at_any_size(spark, n):
    values = spark.range(n).selectExpr("id % 3 AS g", "CASE WHEN id % 11 = 5 THEN NULL ELSE CAST(pmod(id * 7919, 100003) AS double) * 50000 - 1e9 END AS v")
    wanted = values.where("v IS NOT NULL").groupBy("g").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("m"))
    got = discrete_medians(values, ["g"], "v", "m")
    assert sorted(got.collect()) == sorted(wanted.select("g", "m").collect())


def test_medians_of_small_and_negative_values(spark):
    rows = [("a", x) for x in (-1.5, -0.001, 0.0, 0.001, 0.002, 7.0)] + [("b", -3.0), ("b", -2.0), ("c", None)] + [("d", 5.0)] * 9
    got = discrete_medians(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", "m").collect()
    assert {r.g: r.m for r in got} == {"a": 0.0, "b": -3.0, "d": 5.0}


def test_evaluation_judges_every_row_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()

    def judge_one(text, extraction):
        import uuid

        from pyspark import TaskContext

        (calls / f"{TaskContext.get().partitionId()}-{uuid.uuid4().hex}").write_text(text)
        return {"skills": {"verdict": "incorrect" if text == "t3" else "correct", "reasoning": "r"}}

    sample = spark.createDataFrame([(f"j{i}", "title", f"t{i}", i) for i in range(40)], "job_id string, job_title string, description_text string, skills int")
    reports = run_evaluation(sample.limit(40), judge_one, ["skills"], [F.col("job_id")], str(tmp_path / "judged"))
    assert reports["accuracy"].first().correct == 39 and reports["tallies"].first().incorrect == 1
    assert [r.job_id for r in reports["examples"].collect()] == ["j3"]
    assert len(list(calls.iterdir())) == 40
    assert len({f.name.split("-")[0] for f in calls.iterdir()}) > 1


def test_medians_of_values_that_lie_close_together(spark):
    """A million different values within 0.1% of each other: few are left to be put in order."""
    from jobsignals.operators.aggregates import median_candidates

    rows = spark.range(1_000_000).select(F.lit("hot").alias("k"), (F.lit(100_000.0) + F.col("id") * 1e-4).alias("v"))
    rows = rows.unionByName(spark.range(1000).select(F.lit("tiny").alias("k"), (F.col("id") * 1e-300).alias("v")))
    rows = rows.unionByName(spark.range(1001).select(F.lit("signs").alias("k"), (F.pow(F.lit(-7.0), F.col("id") % 200)).alias("v")))
    left = {r.k: r.n for r in median_candidates(rows, ["k"], "v").groupBy("k").agg(F.count("*").alias("n")).collect()}
    assert left.keys() == {"hot", "tiny", "signs"} and max(left.values()) <= 1 << 15 and left["hot"] < 1000
    found = {r.k: r.m for r in discrete_medians(rows, ["k"], "v", "m").collect()}
    expected = {r.k: r.m for r in rows.groupBy("k").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY v)").alias("m")).collect()}
    assert found == expected


def test_weighted_medians_equal_those_of_single_rows(spark):
    import random

    random.seed(8)
    single = [(random.choice("abc"), random.choice([None, float("nan"), 0.0, -0.0, -1.5, 2.0, 1e300, 3.25, 1e-310])) for _ in range(400)]
    rows = spark.createDataFrame(single, "k string, v double").where("NOT isnan(v) OR v IS NULL")
    counted = rows.groupBy("k", "v").agg(F.count("*").alias("n"))
    one = {r.k: r.m for r in discrete_medians(rows, ["k"], "v", "m").collect()}
    two = {r.k: r.m for r in discrete_medians(counted, ["k"], "v", "m", weight="n").collect()}
    plain = {}
    for k in "abc":
        values = sorted(r.v for r in rows.collect() if r.k == k and r.v is not None)
        plain[k] = values[(len(values) - 1) // 2]
    assert one == two == plain
