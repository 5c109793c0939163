"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsignals.llm import ann
from jobsignals.llm.common import table
from jobsignals.llm.queries import all_queries

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.1"

SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, is_query, top=10):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for q, v in rows:
        if is_query(q):
            d = np.sqrt(((x - np.array(v, np.float64)) ** 2).sum(1))
            out[q] = sorted((d[i], ids[i]) for i in range(len(ids)) if ids[i] != q)[:top]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return out


def test_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, MEDIUM, "embeddings").select("vec_id", "embedding").collect()]
    wanted = exact(rows, lambda i: i % 100 == 0)
    got = answers(all_queries()["op10_ann"](spark, MEDIUM))
    assert set(got) == set(wanted)
    hits = [len({i for _, i in got[q]} & {i for _, i in wanted[q]}) / len(wanted[q]) for q in wanted]
    assert sum(hits) / len(hits) >= 0.95
    exact_of = {q: {i: d for d, i in exact(rows, lambda j, q=q: j == q, len(rows))[q]} for q in list(wanted)[:5]}
    for q, of in exact_of.items():
        assert all(s == pytest.approx(of[i], abs=1e-12) for s, i in got[q])


def test_graph_of_small_leaves_improves(spark, monkeypatch):
    """With leaves of 20 nodes, most links come from NN-descent itself."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)
    nodes = ann.classes_of(df, "vec_id", "embedding", 11)
    monkeypatch.setattr(ann, "BLOCK", 100)
    blocks = ann.blocks_for(600)

    def quality(graph):
        d = ((x[:, None] - x[None]) ** 2).sum(-1)
        np.fill_diagonal(d, np.inf)
        near = np.argsort(d, axis=1)[:, :10]
        lists = {r.node: set(r.ids) for r in graph.collect()}
        return np.mean([len(lists.get(i, set()) & set(near[i].tolist())) / 10 for i in range(600)])

    first = ann.first_lists(nodes, 600, 10, 2, 20, blocks)
    start = quality(first)
    better = quality(ann.build_graph(nodes, 600, 10, 2, 20, 0.05))
    assert start < 0.5 and better > 0.85


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(120)]
    rows += [(i, rows[0][1]) for i in range(200, 260)]  # many copies of a query's vector
    rows += [(i, rows[7][1]) for i in range(300, 330)]
    bad = [(400, None), (500, [0.0] * 4), (600, [1.0, None, 1.0, 1.0]), (700, [1.0, float("nan"), 1.0, 1.0]), (800, [float("inf"), 1.0, 1.0, 1.0]), (900, []), (1000, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows + bad + rows[:3]], SCHEMA + ", node int")
    got = answers(ann.nearest_neighbours(df, F.col("vec_id") % 100 == 0))
    wanted = exact(rows, lambda i: i % 100 == 0)
    assert set(got) == set(wanted)
    for q, near in wanted.items():
        assert [i for _, i in got[q]] == [i for _, i in near]
        assert [s for s, _ in got[q]] == pytest.approx([d for d, _ in near], abs=1e-12)


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_few_vectors(spark, n):
    rows = [(i * 100, [float(i + 1), 1.0]) for i in range(n)]
    got = answers(ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0))
    assert got == {q: near for q, near in exact(rows, lambda i: True).items() if near}


def test_recall_where_leaves_are_small(spark, monkeypatch):
    """Many leaves and blocks, hub nodes in parts: what is found comes from the graph and the walk."""
    for name, value in (("BLOCK", 200), ("LEAF", 150), ("DEGREE", 40)):
        monkeypatch.setattr(ann, name, value)
    monkeypatch.setattr(ann.leaves_of, "__defaults__", (3, 150))
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(30, 16)) * 2
    x = (centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = answers(ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0))
    wanted = exact(rows, lambda i: i % 100 == 0)
    hits = [len({i for _, i in got[q]} & {i for _, i in wanted[q]}) / 10 for q in wanted]
    assert len(got) == 30 and sum(hits) / len(hits) >= 0.95


def test_a_round_sends_a_search_each_node_once_at_most(spark, monkeypatch):
    """Blocks send what they found, not the links of it: the rows that reach a search do not grow with
    the number of blocks it visits, and few searches are brought up to date together."""
    for name, value in (("BLOCK", 100), ("LEAF", 60), ("HOME", 4), ("BEAM", 40)):
        monkeypatch.setattr(ann, name, value)
    monkeypatch.setattr(ann.leaves_of, "__defaults__", (3, 60))
    monkeypatch.setattr(ann.search_graph, "__defaults__", (40,))
    sent, merge = [], ann.merge

    def seen(lists, found, most, blocks):
        if most == 40:
            sizes = found.select(F.explode("owner").alias("search"), "at").groupBy("search", "at").count().collect()
            sent.append({r.search: r["count"] for r in sizes})
            assert len({r.search for r in sizes}) == len(sizes) and blocks == 3
        return merge(lists, found, most, blocks)

    monkeypatch.setattr(ann, "merge", seen)
    x = np.random.default_rng(2).normal(size=(1000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    got = answers(ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0))
    wanted = exact(rows, lambda i: i % 100 == 0)
    assert len(sent) > 2 and max(n for r in sent for n in r.values()) < 1000
    hits = [len({i for _, i in got[q]} & {i for _, i in wanted[q]}) / 10 for q in wanted]
    assert len(got) == 10 and sum(hits) / len(hits) >= 0.9
