"""Lexical search against plain formulas, and its sharing plan against direct sums."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from jobsignals.llm import lexical

WORDS = ["the", "Über", "cat", "sat", "x1", "mat", "ünd", "Dog", "ran", "of", "zebra"]


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, total = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in {*items}:
        scores = []
        for key, c, n in held:
            m = 25 + 75 * n * n_docs // total
            score = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, r in Counter(terms(text)).items() if c[t])
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def search(spark, docs, items, **options):
    docs = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, query int")
    items = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, id int")
    return sorted((tuple(r) for r in lexical.lexical_search(docs, items, **options).collect()), key=str)


def test_ranks_equal_the_plain_formula(spark):
    random.seed(3)
    docs = [(i, " ".join(random.choices(WORDS, k=random.randrange(0, 30)))) for i in range(60)]
    docs += [(None, docs[0][1]), (None, docs[5][1]), (7, docs[0][1]), (7, docs[7][1]), (100, None), (101, ""), (102, "... --- !!")]
    docs += [(200 + i, docs[3][1]) for i in range(15)]
    items = [(i, ", ".join(random.choices(WORDS, k=random.randrange(1, 9)))) for i in range(12)]
    items += [(12, None), (13, ""), (14, "nowhere"), (15, "the"), (15, "the"), (None, "cat the ünd"), (16, "cat cat cat ÜBER über")]
    expected = brute(docs, items, 10)
    assert search(spark, docs, items) == expected
    # Blocks of a few terms, small slices and small windows give the same.
    assert search(spark, docs, items, block_terms=7) == expected


def test_texts_of_one_item_are_ranked_apart(spark):
    docs = [(1, "cat"), (2, "dog"), (3, "bird")]
    assert search(spark, docs, [(5, "cat"), (5, "dog")]) == brute(docs, [(5, "cat"), (5, "dog")], 10)


def test_empty_tables(spark):
    assert search(spark, [], [(1, "cat")]) == []
    assert search(spark, [(1, "cat")], []) == []
    assert search(spark, [(1, None)], [(1, None)]) == []


def test_long_texts_are_cut_between_terms():
    text = "ab cd " * 400_000 + "é" * 3_000_000 + " tail"
    counts = Counter(t for part in lexical.terms_of(text) for t in part)
    assert counts == {b"ab": 400_000, b"cd": 400_000, ("é" * 3_000_000).encode(): 1, b"tail": 1}


def test_plan_shares_and_keeps_the_sums():
    rng = np.random.default_rng(5)
    random.seed(5)
    for reach in (1, 4, 16):
        queries = [{random.randrange(30): random.randrange(1, 3) for _ in range(random.randrange(1, 15))} for _ in range(40)]
        plan = lexical.mine_shared_sets(queries, reach)
        weights = rng.integers(0, 1000, (30, 17))
        direct = np.array([sum(n * weights[t] for t, n in q.items()) for q in queries])
        assert (plan.evaluate(weights) == direct).all()
        assert len(plan.pairs) + len(plan.sources) - len(queries) < sum(len(q) - 1 for q in queries)


def test_equal_queries_become_one_node():
    plan = lexical.mine_shared_sets([{i: 1 for i in range(8)}] * 5)
    assert len(plan.pairs) == 7 and len(plan.sources) == 5


def test_a_task_sends_no_more_than_asked(spark):
    docs = spark.createDataFrame([(i, "cat sat") for i in range(3000)] + [(-1, "dog")], "id long, text string").coalesce(1)
    index = lexical.index_documents(docs, {b"cat": 0, b"sat": 1})
    plan = lexical.mine_shared_sets([{0: 1}, {0: 1, 1: 2}])
    rows = lexical.rank_documents(index, plan, np.array([5, 7]), 3001, 6001, 10).where(F.col("query") == 1).collect()
    assert sorted(r.id for r in rows) == list(range(10))
