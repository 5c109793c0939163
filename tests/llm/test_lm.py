"""Counts, base scores and the automaton against plain versions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobsignals.llm import lm
from jobsignals.llm.queries import all_queries
from llm_fixtures import con  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [None]


class PlainModel:
    """The same model by its formulas, without states."""

    def __init__(self, texts, prior):
        self.c = Counter(w for t in texts for w in t)
        self.n, self.v, self.prior = sum(self.c.values()), len(self.c), prior
        self.grams = Counter(tuple(t[i : i + k]) for t in texts for k in (1, 2, 3) for i in range(len(t) - k + 1))

    def alone(self, w):
        return (self.c.get(w, 0) + 0.1) / (self.n + 0.1 * (self.v + 1))

    def given(self, context, w):
        if not context:
            return self.alone(w)
        lower = self.given(context[1:], w)
        return (self.grams[*context, w] + self.prior * lower) / (self.grams[context] + self.prior)

    def score(self, text):
        return sum(math.log10(self.given(tuple(text[max(0, i - 2) : i]), w)) for i, w in enumerate(text))


TEXTS = ["a b a b a c a b", "A b\x0ba b c", "b a b a b a", "", "c c c c d\x85e", "a b a b", "d", "zz a b a yy b a b"] * 3


@pytest.mark.parametrize("chars, entries", [(10, 3_000_000), (10_000, 7), (30, 5)])
def test_scores_equal_the_formulas(spark, chars, entries):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").repartition(2)
    out = {r.doc_id: r for r in lm.score_texts(df, F.col("doc_id") % 4 == 0, prior=2.0, block_chars=chars, range_entries=entries).collect()}
    model = PlainModel([plain_words(t) for i, t, _ in rows if i % 4], 2.0)
    for i, t, _ in rows:
        words, r = plain_words(t), out[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (i % 4 == 0, len(words), model.n)
        assert r.n_known == sum(w in model.c for w in words)
        assert r.base_score == pytest.approx(sum(math.log10(model.alone(w)) for w in words))
        assert r.score == pytest.approx(model.score(words), rel=1e-9)


def test_probabilities_of_a_context_sum_to_one():
    model = PlainModel([plain_words(t) for t in TEXTS], 2.0)
    for context in ((), ("a",), ("b",), ("a", "b"), ("b", "a"), ("zz",)):
        # every word, and one unseen
        assert sum(model.given(context, w) for w in [*model.c, "never"]) == pytest.approx(1.0)


def test_query(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    words = {i: plain_words(t) for i, t in rows}
    counts = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in all_queries()["op6_lm_scoring"](spark, SMALL).collect()}
    assert set(got) == set(words)
    for i, ws in words.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in counts for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "w " * 50_000), (3, "w " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = lm.score_texts(df, F.col("doc_id").isNull()).collect()
    assert sorted(r.n_tokens for r in out) == [1, 1, 3, 50_001, 50_001] and {r.train_tokens for r in out} == {100_004}
    assert [r.held_out for r in out if r.doc_id is None] == [True]
    nothing = lm.score_texts(df, F.lit(True)).collect()
    assert all(r.n_known == 0 and r.score == pytest.approx(r.base_score) for r in nothing)
    assert lm.score_texts(df.limit(0), F.lit(True)).count() == 0
