"""Literals that patterns require, and matching by them against brute force."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from jobsignals.operators import patterns as pt
from jobsignals.operators.patterns import map_by_pattern, required_literals


@pytest.mark.parametrize(
    ("pattern", "literals"),
    [
        ("data engineer", ["data engineer"]),
        ("qa lead|test analyst", ["qa lead", "test analyst"]),
        (r"\bdev ?ops\b", ["dev"]),
        (r"c\+\+ developer", ["c++ developer"]),
        ("front-?end (web )?developer", ["developer"]),
        ("(senior|junior) analyst", [" analyst"]),
        ("ab{2}cde", ["cde"]),
        ("colou?rs*", ["colo"]),
        ("nurs(e|ing)", ["nurs"]),
        ("a+bc", ["bc"]),
        ("[a-c]xyz[^]d]", None),
        ("[a-c]xyz[de]", ["xyz"]),
    ],
)
def test_required_literals(pattern, literals):
    assert required_literals(pattern) == literals


@pytest.mark.parametrize("pattern", ["", "a|", "x", "(?i)engineer", r"\Qa+b\E", r"\x41bc", r"\p{Lu}bc", "[ab]+", ".*", "(ab", "ab)", r"(a)\1bc", "engineer|[ab]"])
def test_patterns_that_require_nothing_known(pattern):
    assert required_literals(pattern) is None


def test_a_match_holds_one_of_the_literals():
    random.seed(11)
    pieces = ["ab", "cd", "x", "e?", "f*", "(gh|i)", "[jk]", ".", r"\s", r"\.", "l{1,2}", "m+", "|", "^", r"\b", "(?:no)?"]
    checked = 0
    for _ in range(4000):
        pattern = "".join(random.choices(pieces, k=random.randrange(1, 7)))
        literals = required_literals(pattern)
        if literals is None:
            continue
        for _ in range(40):
            text = "".join(random.choices(["ab", "a", "cd", "x", "e", "ff", "gh", "i", "j", "l", "m", "no", ".", " "], k=random.randrange(0, 9)))
            if re.search(pattern, text):
                checked += 1
                assert any(x in text for x in literals), (pattern, text)
    assert checked > 500


def test_joined_patterns_give_what_the_case_gives(spark, monkeypatch):
    random.seed(12)
    words = ["data", "web", "qa", "test", "lead", "nurse", "dev", "ops", "c++", "naïve", "ß"]
    pieces = ["data", "web ", "qa", "(test|lead)", "nurs", "e?", "dev", " ?", "ops", r"c\+\+", "naïve", "ß", "|", "[qt]", ".", "(?i)QA", r"\bdev\b"]
    given = []
    for i in range(150):
        pattern = "".join(random.choices(pieces, k=random.randrange(1, 5)))
        given.append({"priority": random.choice([None, 1, 2, 3]), "anzsco_code": random.choice([None, "1", "2", "3"]), "title_pattern": random.choice([pattern, pattern, None])})
    titles = [(i, " ".join(random.choices(words, k=random.randrange(0, 5)))) for i in range(300)] + [(-1, None), (-2, "")]
    df = spark.createDataFrame(titles, "id long, title string")
    table = spark.createDataFrame([tuple(g.values()) for g in given], "priority long, anzsco_code string, title_pattern string")
    expected = {r.id: r.anzsco_code for r in map_by_pattern(df, F.lower("title"), given).collect()}
    for size in (20_000, 40):
        monkeypatch.setattr(pt, "AUTOMATON_PATTERNS", size)
        rows = map_by_pattern(df, F.lower("title"), table).collect()
        assert len(rows) == len(titles) and {r.id: r.anzsco_code for r in rows} == expected
    none = map_by_pattern(df, F.lower("title"), table.limit(0)).collect()
    assert len(none) == len(titles) and {r.anzsco_code for r in none} == {None}


def test_many_patterns_and_titles(spark):
    random.seed(13)
    roots = ["".join(random.choices("abcdefghij", k=6)) for _ in range(2000)]
    given = [(i % 7, str(i), f"{root}(er|ing)? [x-z]\\d+") for i, root in enumerate(roots)]
    titles = [(i, f"some {random.choice(roots)}{random.choice(['er', 'ing', '', 'ly'])} {random.choice('wxyz')}{i % 10} role {i}") for i in range(20_000)]
    df = spark.createDataFrame(titles, "id long, title string")
    table = spark.createDataFrame(given, "priority long, anzsco_code string, title_pattern string")
    started = time.perf_counter()
    found = {r.id: r.anzsco_code for r in map_by_pattern(df, F.lower("title"), table).select("id", "anzsco_code").collect()}
    assert time.perf_counter() - started < 30
    by_root = {}
    for i, root in enumerate(roots):
        by_root.setdefault(root, []).append((i % 7, str(i), given[i][2]))
    for i, title in random.sample(titles, 3000):
        hits = [p for word in {title.split()[1][:6]} for p in by_root[word] if re.search(p[2], title)]
        assert found[i] == (min(hits)[1] if hits else None)
    assert sum(c is not None for c in found.values()) > 5000
