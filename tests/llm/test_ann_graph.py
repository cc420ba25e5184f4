from __future__ import annotations

import math

import numpy as np
import pytest

from gridtide.llm import ann_graph
from gridtide.llm.ann_graph import DEGREE, _pruned, _reached, built, nearest
from gridtide.llm.queries import QUERIES

SCHEMA = "id long, vector array<double>, n string, code string"


def brute(rows, queries, k):
    """Ranked neighbours of every query by the whole list."""
    rows, queries = ({(n, tuple(v)) for n, v in x} for x in (rows, queries))
    out = []
    for n, v in queries:
        far = sorted((math.dist(v, w), m) for m, w in rows if (m, w) != (n, v))
        out += [(n, rank, m, score) for rank, (score, m) in enumerate(far[:k], 1)]
    return sorted(out)


def found(spark, rows, queries, k, **how):
    frames = [spark.createDataFrame([(*r, "n", "c") for r in x], SCHEMA).repartition(3) for x in (rows, queries)]
    return sorted(tuple(r) for r in nearest(*frames, k, **how).collect())


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-14, atol=0)


def vectors(random, count, d=8):
    return [(n, v.tolist()) for n, v in enumerate(random.standard_normal((count, d)))]


def test_small_tables_are_found_whole_over_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann_graph, "QUERY_BLOCK", 7)
    rows = vectors(np.random.default_rng(1), 150)
    same(found(spark, rows, rows[::7], 10, shard_rows=40), brute(rows, rows[::7], 10))
    same(found(spark, rows[:6], rows[:6], 10), brute(rows[:6], rows[:6], 10))


def test_copies_ties_and_an_id_with_several_vectors(spark):
    random = np.random.default_rng(2)
    rows = vectors(random, 60)
    hot = rows[3][1]
    rows += [(1000 + n, hot) for n in range(40)] + [(1000, hot)] * 30  # one vector has half of all rows
    rows += [(5, rows[9][1]), (5, [1.0] * 8)]
    rows += [(200 + n, [float(n == m) for m in range(8)]) for n in range(8)] + [(300, [0.125] * 8)]
    queries = [rows[3], (1000, hot), (1039, hot), (5, [1.0] * 8), rows[5], (300, [0.125] * 8)]
    same(found(spark, rows, queries, 10), brute(rows, queries, 10))


def test_nulls_odd_vectors_and_empty_tables(spark):
    rows = vectors(np.random.default_rng(3), 20, 3)
    odd = [(100, None), (101, []), (102, [0.0] * 3), (103, [1.0, None, 1.0]), (104, [math.nan, 1.0, 1.0]),
           (105, [1.0, math.inf, 1.0]), (106, [1.0, 2.0]), (None, [1.0, 2.0, 3.0])]
    same(found(spark, rows + odd, rows[:2] + odd, 4), brute(rows, rows[:2], 4))
    assert found(spark, [], [], 4) == [] == found(spark, rows, [], 4) == found(spark, odd[:6], odd, 4)
    assert found(spark, rows[:1], rows[:1], 4) == []


def recall(got, want):
    near: dict = {}
    for n, _, m, _ in want:
        near.setdefault(n, set()).add(m)
    return np.mean([m in near[n] for n, _, m, _ in got])


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_query_recall_and_exact_scores(spark, scale):
    path = f"/root/testdata/{scale}"
    table = {r.vec_id: r.embedding for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()}
    got = sorted(tuple(r) for r in QUERIES["op13_graph_neighbours"](spark, path).collect())
    queries = [(n, v) for n, v in table.items() if n % 100 == 0]
    want = brute(table.items(), queries, 10)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(score - math.dist(table[n], table[m])) < 1e-12 and n != m for n, _, m, score in got)
    assert recall(got, want) >= 0.97


def test_graph_of_clusters_reaches_every_node_within_its_degree():
    random = np.random.default_rng(5)
    middles = random.standard_normal((40, 16)) * 50
    data = np.repeat(middles, 30, 0) + random.standard_normal((1200, 16)) * 0.01
    graph = built(data)
    assert _reached(graph.edges, graph.entry).all()
    assert np.mean((graph.edges >= 0).sum(1) <= DEGREE) > 0.99
    ids, _ = graph.search(data[::17], 32)
    assert all(n in own for n, own in zip(range(0, 1200, 17), ids.tolist()))


def test_pruning_keeps_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [0, 2.1], [-5, 0]], np.float32)
    kept = _pruned(points, np.array([0]), np.array([[5, 4, 3, 2, 1, 1, 0, -1]]), 4, 1.2)[0].tolist()
    assert kept == [1, 3, 5, -1]
