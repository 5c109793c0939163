"""Trees against a row-by-row walk, and the classifier on held-out rows."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from jobsignals.llm import quality_trees as qt
from jobsignals.llm.common import table
from jobsignals.llm.queries import all_queries

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.1"


def example(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    x[:, 4] = rng.integers(0, 3, n)
    y = ((x[:, 0] > 0.3) ^ (x[:, 4] == 1)).astype(float)
    return x, y


def walk(forest, row):
    total = forest.bias
    for features, cuts, leaves in zip(forest.features, forest.cuts, forest.leaves):
        at = 0
        while at < len(features):
            at = 2 * at + (2 if row[features[at]] > cuts[at] else 1)
        total += leaves[at - len(features)]
    return total


def test_flat_arrays_give_what_a_walk_gives():
    x, y = example()
    forest = qt.boost(x, y, 0.0, trees=12, depth=3)
    assert np.allclose(forest.margin(x[:200]), [walk(forest, r) for r in x[:200]], atol=1e-12)


def test_learns_what_one_cut_cannot_say():
    x, y = example()
    forest = qt.boost(x, y, math.log(y.mean() / (1 - y.mean())))
    other_x, other_y = example(seed=2)
    assert ((forest.score(other_x) > 0.5) == other_y).mean() > 0.97


def test_best_split_is_the_best_of_all():
    rng = np.random.default_rng(4)
    binned, g, h = rng.integers(0, 6, (300, 3)), rng.normal(size=300), rng.uniform(0.1, 0.25, 300)
    keys = np.arange(3)[None] * 8 + binned
    feature, cut = qt.best_splits(keys, g, h, 1, (3, 8), 1.0, 5.0)

    def gain(j, b):
        left = binned[:, j] <= b
        if min(left.sum(), (~left).sum()) < 5:
            return 0.0
        part = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1)
        return part(left) + part(~left) - part(np.ones(300, bool))

    best = max(gain(j, b) for j in range(3) for b in range(8))
    assert math.isclose(gain(int(feature[0]), int(cut[0])), best, rel_tol=1e-9)


def test_constant_values_and_few_rows():
    forest = qt.boost(np.ones((5, 2)), np.array([0, 1, 1, 0, 1.0]), 0.4, trees=3)
    assert np.isinf(forest.cuts).all() and np.isfinite(forest.margin(np.ones((2, 2)))).all()


def test_statistics_of_odd_texts():
    for text in ("", " ", "\n\n", "a", "É", "\x00\x7f", "🙂🙂", "x" * 300_000, "a b " * 50_000, "A!! B!!\n| c |"):
        row = qt.statistics(text)
        assert len(row) == len(qt.FEATURES) and np.isfinite(row).all()
    by_name = dict(zip(qt.FEATURES, qt.statistics("Ab cd cd cd\ncd.")))
    assert by_name["repeated_next"] == 2 / 5 and by_name["log_words"] == math.log1p(5) and by_name["log_lines"] == math.log1p(2)


def test_held_out_rows(spark):
    labels = table(spark, MEDIUM, "labels").select("doc_id", "quality")
    rows = all_queries()["op12_quality_trees"](spark, MEDIUM)
    assert rows.count() == table(spark, MEDIUM, "documents").count()
    held = rows.join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    good = [r.predicted for r in held if r.quality]
    bad = [r.predicted for r in held if not r.quality]
    assert sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.06


def test_held_out_labels_do_not_matter(spark):
    docs, labels = table(spark, SMALL, "documents").limit(80), table(spark, SMALL, "labels")
    other = labels.withColumn("quality", F.when(qt.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (qt.fit_quality(docs, x.where(~qt.held_out("doc_id"))) for x in (labels, other))
    assert one.bias == two.bias and (one.leaves == two.leaves).all()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, "a"), (1, "", "b"), (1, "good text.", "c"), (2, "x" * 200_000, None)], "doc_id smallint, text string, score string")
    labels = spark.createDataFrame([(1, 1, 9), (1, None, 9), (None, 0, 9), (2, 0, 9)], "doc_id smallint, quality int, text int")
    forest = qt.fit_quality(docs, labels)
    scores = [r.score for r in qt.score_quality(docs, forest).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    one_class = qt.fit_quality(docs, labels.where("quality = 1"))
    assert qt.score_quality(docs, one_class).where("score < 0.5").isEmpty()
    assert qt.score_quality(docs.limit(0), forest).isEmpty()
    assert qt.score_quality(docs, qt.fit_quality(docs.limit(0), labels.limit(0))).count() == 4
