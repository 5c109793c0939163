"""The decoder against all paths of its lattice, and the scores on held-out rows."""

from __future__ import annotations

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from jobsignals.llm import toxicity as tx
from jobsignals.llm.common import table
from jobsignals.llm.queries import all_queries

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.1"


def model_of(words):
    counts = np.zeros(tx.LETTERS**tx.ORDER)
    np.add.at(counts, tx.CharModel.grams(words), 1)
    return tx.CharModel(counts)


def path_score(letters, cost, model):
    state, total = 0, -cost
    for c in letters + tx.EDGE:
        key = state * tx.LETTERS + ord(c) - 96
        total += model.logp[key]
        state = key % tx.LETTERS ** (tx.ORDER - 1)
    return total


def test_viterbi_finds_the_best_path():
    random.seed(1)
    model = model_of(["idiot", "stupid", "loser", "the", "there", "solid"])
    for _ in range(150):
        token = "".join(random.choice("idotsl0105$@!..oo") for _ in range(random.randrange(1, 8)))
        lattice = list(tx.options(token))
        paths = [("".join(p for p, _ in choice), sum(c for _, c in choice)) for choice in itertools.product(*lattice)]
        best = max(path_score(letters, cost, model) for letters, cost in paths)
        decoded = tx.decode(token, model)
        assert max(path_score(letters, cost, model) for letters, cost in paths if letters == decoded) >= best - 1e-9


def test_restores_hidden_words():
    model = model_of(["idiot"] * 5 + ["moron"] * 5 + ["the", "cat", "there", "solid"])
    for hidden in ("1d10t", "i.d.i.o.t", "idiiiiot", "ïdìót", "!diot", "id10t###", "i-d-i-o-t"):
        assert tx.restore(hidden, model) == ["idiot"], hidden
    assert "moron" in tx.restore("you m o r o n there", model)
    assert tx.restore("the cat, solid.", model) == ["the", "cat", "solid"]
    assert tx.restore("", model) == [] and tx.restore("12 345-6 %%%", model) == []
    tx.restore("a1" * 20_000, model)


def test_restores_symbols_separators_and_wide_gaps():
    model = model_of(["asshole", "pussy", "kill", "cunt", "ass", "moron", "stupid", "idiot"] * 5 + ["the", "cat", "well", "known", "you", "are", "house"] * 3)
    for hidden, word in (("a$$hole", "asshole"), ("pu$$y", "pussy"), ("k!!ll", "kill"), ("(unt", "cunt"), ("@$$", "ass"), ("st.up.id", "stupid"), ("m0r-0n", "moron"), ("id10t!!!", "idiot"), ("stu--pid", "stupid")):
        assert tx.restore(hidden, model) == [word], hidden
    for hidden in ("m  o  r  o  n", "m o r o n", "m 0 r 0 n", "you are a m o r o n", "a  m o r o n", "m\to\tr\to\tn"):
        assert "moron" in tx.restore(hidden, model), hidden
    assert {"you", "moron"} <= set(tx.restore("y o u  m o r o n", model))
    assert tx.restore("well-known house(cat)", model) == ["well", "known", "house", "cat"]
    assert tx.restore("!!! $100 #1 -- *** +1-2", model) == []
    tx.restore("a " * 20_000 + "$" * 50_000 + " " + "a." * 20_000 + "@!" * 20_000, model)


def test_scores_of_held_out_rows(spark):
    labels = table(spark, MEDIUM, "labels").select("doc_id", "toxic")
    rows = all_queries()["op3_toxicity"](spark, MEDIUM).join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    caught = [r.predicted for r in rows if r.toxic]
    assert right > 0.95 and sum(caught) / len(caught) > 0.75
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = table(spark, SMALL, "documents"), table(spark, SMALL, "labels")
    flipped = labels.withColumn("toxic", F.when(tx.in_fold("doc_id", 5), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tx.fit_on_folds(docs, labels), tx.fit_on_folds(docs, flipped)
    assert a.weights == b.weights and a.bias == b.bias


def test_edges(spark):
    docs = spark.createDataFrame([(1, "you idiot", "s"), (2, None, "s"), (3, "", "s"), (None, "fine", None), (1, "you idiot", "s"), (5, "x" * 300_000, "s")], "doc_id long, text string, y string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (5, 0)], "doc_id long, toxic int")
    model = tx.fit_toxicity(docs, labels)
    assert tx.score_toxicity(docs, model).select("doc_id", "y", "score").count() == 6
    nothing = tx.fit_toxicity(docs.limit(0), labels.limit(0))
    assert [r.score < 0.5 for r in tx.score_toxicity(docs, nothing).collect()] == [True] * 6
    assert tx.score_toxicity(docs.limit(0), model).count() == 0


def test_learns_from_every_labelled_row(spark):
    """Forty words that three toxic rows of 12,500 hold each: a sample of the class misses some."""
    letters = F.translate(F.col("id").cast("string"), "0123456789", "bcdfghjklm")
    rows = spark.range(25_000).select(F.col("id").alias("doc_id"), (F.col("id") < 12_500).cast("int").alias("toxic"), letters.alias("own"))
    rare = F.concat(F.lit("zq"), F.translate((10 + F.col("doc_id") % 40).cast("string"), "0123456789", "bcdfghjklm"))
    text = F.concat_ws(" ", F.col("own"), F.when(F.col("doc_id") < 120, rare), F.when(F.col("toxic") == 1, F.lit("awful")).otherwise("kind"))
    rows = rows.select("doc_id", text.alias("text"), "toxic")
    model = tx.fit_toxicity(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    words = {r.w for r in rows.where("doc_id < 120").select(rare.alias("w")).distinct().collect()}
    assert len(words) == 40 and all(tx.features_of(w)[0] in model.weights for w in words)
    assert model.score("awful") > 0.9 and model.score("kind") < 0.1


def test_newton_sums_equal_dense_matrices():
    rng = np.random.default_rng(3)
    lengths = rng.integers(0, 5, 200)
    flat = np.concatenate([rng.choice(7, n, replace=False) for n in lengths]).astype(int)
    ones, zeros, w = rng.integers(0, 4, 200).astype(float), rng.integers(0, 4, 200).astype(float), rng.normal(size=8)
    x = np.zeros((200, 8))
    x[:, -1] = 1
    x[np.repeat(np.arange(200), lengths), flat] = 1
    p = 1 / (1 + np.exp(-x @ w))
    gradient, curvature = tx.newton_sums(flat, lengths, ones, zeros, w)
    assert np.allclose(gradient, x.T @ ((ones + zeros) * p - ones))
    assert np.allclose(curvature, (x * ((ones + zeros) * (p * (1 - p) + 1e-9))[:, None]).T @ x)


def test_newton_steps_send_the_driver_no_more_for_more_files(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    rows = [([f for f in range(12) if rng.random() < 0.3], rng.randint(0, 3), rng.randint(0, 3)) for _ in range(300)]
    table = spark.createDataFrame(rows, "f array<int>, ones long, zeros long")
    n = sum(a + b for _, a, b in rows)
    sent, frombuffer = [], np.frombuffer
    monkeypatch.setattr(tx.np, "frombuffer", lambda sums: sent.append(len(sums)) or frombuffer(sums))
    found, seen = [], []
    for i, files in enumerate((1, 97)):
        table.repartition(files).write.parquet(path := str(tmp_path / str(i)))
        sent.clear()
        with monkeypatch.context() as m:
            m.setattr(tx, "MOST_TASKS", 2)
            found.append(tx.solve(spark.read.parquet(path), 13, n))
        seen.append(max(sent))
        assert len(sent) <= 2 * 30 and set(sent) == {8 * (13 + 13 * 14 // 2)}
    assert np.array_equal(*found) and seen[0] == seen[1]
