from __future__ import annotations

import math

import numpy as np
import pytest

from gridtide.llm.common import stored
from gridtide.llm.queries import QUERIES
from gridtide.llm.whitening import bidiagonalised, fit, whiten

SCHEMA = "vec_id long, embedding array<double>, x string, key string"


def brute(vectors: dict):
    """Whole numbers, deviations and whitened rows by a plain eigendecomposition, up to sign."""
    x = {n: [math.floor(256 * c) for c in v] for n, v in vectors.items()}
    listed = np.array(sorted({tuple(v) for v in x.values()}), np.float64)
    n, sums = len(listed), listed.sum(0)
    centred = listed - sums / n
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    values, turned = values[::-1], turned[:, ::-1]
    count = min(4, int((values > 1e-12 * values[0]).sum())) if values[0] > 0 else 0
    rows = {}
    for key, v in x.items():
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(v, sums))
        y = (np.array(v) - sums / n) @ turned[:, :count] / np.sqrt(values[:count])
        rows[key] = (deviation, y)
    return n, rows, values[:count] / values.sum()


def compared(spark, vectors: dict, extra=()):
    rows = [(n, v, "x", "k") for n, v in vectors.items()] + [(*r, "x", "k") for r in extra]
    found = whiten(spark.createDataFrame(rows, SCHEMA).repartition(3), "embedding", "vec_id").collect()
    n, want, explained = brute(vectors)
    assert len(found) == len(vectors) * len(explained)
    got: dict = {}
    for r in found:
        assert r.n == n and r.deviation == want[r.vec_id][0]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
        got.setdefault(r.vec_id, {})[r.component] = r.whitened
    keys = sorted(vectors)
    if len(explained):
        mine = np.array([[got[key][c + 1] for c in range(len(explained))] for key in keys])
        theirs = np.array([want[key][1] for key in keys])
        return mine, theirs, explained
    return None


def same_up_to_sign(mine, theirs):
    sign = np.sign((mine * theirs).sum(0))
    assert np.abs(mine * sign - theirs).max() < 1e-8


def test_equals_plain_eigendecomposition(spark):
    random = np.random.default_rng(1)
    base = random.standard_normal((300, 12)) * np.linspace(1, 5, 12) + np.arange(12)
    vectors = {n: row.tolist() for n, row in enumerate(base)}
    vectors |= {1000 + n: base[7].tolist() for n in range(150)}  # one vector has a third of all rows
    mine, theirs, _ = compared(spark, vectors)
    same_up_to_sign(mine, theirs)


def test_fewer_rows_than_dimensions_and_fewer_dimensions_than_components(spark):
    random = np.random.default_rng(2)
    few = {n: row.tolist() for n, row in enumerate(random.standard_normal((4, 30)))}
    mine, theirs, explained = compared(spark, few)
    assert len(explained) == 3
    same_up_to_sign(mine, theirs)
    narrow = {n: row.tolist() for n, row in enumerate(random.standard_normal((50, 2)) * [1, 3])}
    mine, theirs, explained = compared(spark, narrow)
    assert len(explained) == 2
    same_up_to_sign(mine, theirs)


def test_equal_deviations_come_out_as_often_as_they_occur(spark):
    vectors = {}
    for at in range(6):
        for sign in (1, -1):
            row = [0.0] * 6
            row[at] = sign * (4.0 if at < 3 else 1.0)
            vectors[len(vectors)] = row
    mine, theirs, explained = compared(spark, vectors)
    assert np.allclose(explained[:3], explained[0]) and explained[3] < explained[0] / 10
    # Any basis of the space of the equal ones is right: lengths agree.
    assert np.allclose((mine[:, :3] ** 2).sum(1), (theirs[:, :3] ** 2).sum(1))


def test_nulls_odd_vectors_repeated_rows_and_tables_without_deviation(spark):
    vectors = {n: [float(n), float(n * n % 7), 1.0] for n in range(20)}
    odd = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [math.nan, 1.0, 1.0]), (54, [math.inf, 1.0, 1.0]), (55, [1.0, 2.0])]
    mine, theirs, explained = compared(spark, vectors, odd)
    assert len(explained) == 2
    same_up_to_sign(mine, theirs)
    rows = [(None, [1.0, 2.0], "x", "k")] * 2 + [(1, [3.0, 5.0], None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = whiten(docs, "embedding", "vec_id").collect()
    assert sorted((r.vec_id or 0, r.component, r.n, round(abs(r.whitened), 9)) for r in found) == [
        (0, 1, 2, 1.0), (0, 1, 2, 1.0), (1, 1, 2, 1.0),
    ]
    assert whiten(docs.where("vec_id IS NULL"), "embedding", "vec_id").count() == 0
    assert whiten(docs.limit(0), "embedding", "vec_id").columns[0] == "vec_id"
    assert whiten(docs.limit(0), "embedding", "vec_id").count() == 0


def test_deviation_is_exact_and_null_beyond_a_long(spark):
    rows = [(1, [2.0**40], "x", "k"), (2, [-(2.0**40)], "x", "k"), (3, [2.0**20 + 1], "x", "k")]
    found = {r.vec_id: r.deviation for r in whiten(spark.createDataFrame(rows, SCHEMA), "embedding", "vec_id").collect()}
    x = 256 * (2**20 + 1)
    assert found == {1: None, 2: None, 3: (3 * x - x) ** 2}


def test_bidiagonal_matrix_and_full_orthogonality(spark):
    random = np.random.default_rng(4)
    x = np.unique(np.floor(random.standard_normal((80, 9)) * 100), axis=0)
    listed = stored(spark.createDataFrame([([int(a) for a in row],) for row in x], "x array<long>"), "listed")
    centred = x - x.mean(0)
    v, b = bidiagonalised(listed, x.mean(0), float((centred**2).sum()))
    assert np.abs(v @ v.T - np.eye(9)).max() < 1e-12
    assert np.abs(b - np.triu(b) + np.triu(b, 2)).max() == 0
    assert np.allclose(np.linalg.svd(b)[1], np.linalg.svd(centred)[1], rtol=1e-11)
    assert np.allclose(np.linalg.norm(centred @ v.T, axis=0), np.linalg.norm(b, axis=0), rtol=1e-10)
    assert len(fit(listed, 9).values) == 9


@pytest.mark.parametrize("scale", ["sf0.001"])
def test_query_equals_plain_eigendecomposition(spark, scale):
    path = f"/root/testdata/{scale}"
    table = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    n, want, explained = brute({r.vec_id: r.embedding for r in table})
    got = QUERIES["op12_whitening"](spark, path).collect()
    assert len(got) == 4 * len(table) and {r.component for r in got} == {1, 2, 3, 4}
    assert all(r.n == n and r.deviation == want[r.vec_id][0] and r.identity_error <= 1e-4 for r in got)
    for component in range(1, 5):
        rows = sorted((r.vec_id, r.whitened, r.explained) for r in got if r.component == component)
        theirs = np.array([want[key][1][component - 1] for key, _, _ in rows])
        same_up_to_sign(np.array([[y] for _, y, _ in rows]), theirs[:, None])
        assert abs(rows[0][2] / explained[component - 1] - 1) < 1e-4
