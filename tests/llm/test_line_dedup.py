"""Repeated runs of lines against a plain version, SQL and the rules they have to keep."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from oracle import compare
from pyspark.sql import functions as F

from jobsignals.llm import line_dedup as module
from jobsignals.llm.line_dedup import line_dedup
from jobsignals.llm.queries import all_oracles, all_queries
from llm_fixtures import con  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def blank(line):
    return not line.strip(" \t\r")


def plain_dedup(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        gone = set()
        for i, pair in enumerate(zip(lines, lines[1:])):
            if pair in seen and not all(map(blank, pair)):
                gone |= {i, i + 1}
            seen.add(pair)
        kept = [x for i, x in enumerate(lines) if i not in gone]
        out[doc_id] = ("\n".join(kept), len(lines), len(gone))
    return out


def texts():
    random.seed(8)
    lines = [f"line {i}" for i in range(400)] + ["", "", " ", " x", "\\n", "é", "x", "\t"]
    passage = [f"shared {i}" for i in range(12)]
    for _ in range(150):
        own = [random.choice(lines) for _ in range(random.randrange(0, 12))]
        if random.random() < 0.4:
            at, cut = random.randrange(len(own) + 1), random.randrange(11)
            own[at:at] = passage[cut : cut + random.randrange(2, 13)]
        yield "\n".join(own)
    yield from ["\n" * 30, "", "\n", " \n ", "x", "one line " * 40_000, "x\nx\nx\nx", "many\nlines\n" * 20_000]


def removed(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_lines int").repartition(3)
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup(df).collect()}


def test_against_plain(spark):
    rows = list(enumerate(texts()))
    got = removed(spark, rows)
    assert got == plain_dedup(rows)
    assert sum(r[2] for r in got.values()) > 400


@pytest.mark.parametrize("kinds", [1, 5])
def test_bytes_decide_where_hashes_are_equal(spark, monkeypatch, kinds):
    """Line hashes of a few kinds only, so that different windows share theirs."""
    monkeypatch.setattr(module, "line_hash", lambda line: F.when(F.length(F.trim(line, F.lit(" \t\r"))) == 0, F.lit(0).cast("long")).otherwise(F.length(line) % kinds + 1))
    rows = list(enumerate(texts()))[:-2]
    assert removed(spark, rows) == plain_dedup(rows)


def test_every_repeated_run_goes_and_every_line_stays_somewhere(spark):
    rows = list(enumerate(texts()))
    got = removed(spark, rows)
    places = defaultdict(set)
    for i, t in rows:
        for line in t.split("\n"):
            places[line].add(i)
    left = {line for t, _, _ in got.values() for line in t.split("\n")}
    assert set(places) <= left
    run = "\n".join(f"shared {i}" for i in range(3, 6))
    assert sum(run in t for _, t in rows) > 5 and sum(run in t for t, _, _ in got.values()) <= 1
    # Lines that stand in one document once are never removed.
    once = {line for line, at in places.items() if len(at) == 1 and sum(t.split("\n").count(line) for _, t in rows) == 1}
    assert all(line in got[next(iter(places[line]))][0].split("\n") for line in once)


def test_against_sql(spark, con):
    df = all_queries()["op4_line_dedup"](spark, SMALL)
    assert compare(df, con, all_oracles()["op4_line_dedup"]) == ""


def test_plan_is_native(spark):
    plan = all_queries()["op4_line_dedup"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edges(spark):
    t = "a\nb\nc"
    rows = [(None, t), (2, t), (2, t), (3, None), (4, ""), (5, "a"), (6, "b\nx\na")]
    got = sorted(((r.doc_id, r.text, r.n_removed) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == sorted([(None, "", 3), (2, t, 0), (2, t, 0), (3, "", 0), (4, "", 0), (5, "a", 0), (6, "b\nx\na", 0)], key=str)
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
