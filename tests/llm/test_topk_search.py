from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtide.llm import topk_search
from gridtide.llm.topk_search import MultiIndex, search, segments_of, sign_words

SCHEMA = "id long, code long"


def brute(codes: dict[int, int], query: int, k: int) -> list[tuple[int, int]]:
    mask = (1 << 64) - 1
    far = sorted(((codes[query] ^ c) & mask).bit_count() * 10**9 + i for i, c in codes.items() if i != query)
    return [divmod(x, 10**9) for x in far[:k]]


def found(spark, rows, queries, k):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = search(frame, frame.where(F.col("id").isin(queries)), k).collect()
    out: dict[int, list] = {}
    for row in sorted(got, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(row.query_id, []).append((row.distance, row.id))
    return out


def test_equals_brute_force_with_near_far_and_equal_codes(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "DATA_BLOCK", 150)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(1)
    codes = {n: int(rng.integers(-(1 << 63), 1 << 63)) for n in range(400)}
    for n in range(100):
        codes[1000 + n] = codes[0] ^ (1 << int(rng.integers(63)))
        codes[2000 + n] = codes[7]  # a hot code
    queries = [0, 7, 2050, 1003, *range(50, 400, 50)]
    got = found(spark, list(codes.items()), queries, 10)
    assert got == {q: brute(codes, q, 10) for q in queries}


@pytest.mark.parametrize("n", [1, 2, 30, 3000])
def test_radius_covers_the_last_distance(n):
    rng = np.random.default_rng(n)
    codes = rng.integers(0, 1 << 64, n, dtype=np.uint64)
    index = MultiIndex(codes, np.arange(n))
    query = int(rng.integers(0, 1 << 64, dtype=np.uint64))
    places, distances, covered = index.nearest(query, 5)
    every = np.bitwise_count(codes ^ np.uint64(query))
    assert distances.tolist() == sorted(every.tolist())[:5]
    assert len(places) < 5 or covered >= distances[-1]


def test_segments_cover_all_bits():
    for n in (0, 1, 100, 10**5, 10**9):
        parts = segments_of(n)
        assert [low for low, _ in parts] == [sum(w for _, w in parts[:k]) for k in range(len(parts))]
        assert sum(width for _, width in parts) == 64 and max(w for _, w in parts) <= 32


def test_edge_cases(spark):
    rows = [(1, 5), (1, 5), (2, 5), (3, None), (None, 5), (4, 7), (1, 4)]
    # The repeated row counts once; the same id with another code is another row.
    assert sorted(found(spark, rows, [1], 9)[1]) == [(0, 2), (1, 1), (1, 1), (1, 2), (1, 4), (2, 4)]
    assert found(spark, [(1, 5), (2, 5)], [1], 9) == {1: [(0, 2)]}
    assert found(spark, [(1, 5)], [1], 9) == {}
    assert found(spark, [], [1], 9) == {}


def test_sign_words(spark):
    rows = [([1.0, -1.0, 0.0, 2.0],), ([0.5] * 70,), (None,), ([],)]
    frame = spark.createDataFrame(rows, "e array<float>")
    assert [r.c for r in frame.select(sign_words(F.col("e"), 2).alias("c")).collect()] == [[9, 0], [-1, 63], None, [0, 0]]
    assert topk_search.dimensions(frame, "e") == 70 and topk_search.dimensions(frame.limit(0), "e") == 1
    short = frame.where("size(e) < 65 OR e IS NULL")
    assert [r.c for r in short.select(sign_words(F.col("e")).alias("c")).collect()] == [[9], None, [0]]
    with pytest.raises(Exception, match="more than 64 dimensions"):
        frame.select(sign_words(F.col("e")).alias("c")).collect()


@pytest.mark.parametrize("dimensions", [20, 100, 200])
def test_embeddings_of_any_length_equal_brute_force(spark, dimensions):
    """Every dimension counts; segments reach over the ends of words."""
    rng = np.random.default_rng(dimensions)
    data = rng.standard_normal((300, dimensions))
    data[150:] = data[:150] * rng.choice([1, 1, 1, 1, -1], (150, dimensions))
    rows = [(n, v.tolist()) for n, v in enumerate(data)]
    frame = spark.createDataFrame(rows, "id long, e array<double>")
    code = sign_words(F.col("e"), -(-dimensions // 64)).alias("code")
    codes = frame.select("id", code)
    got = search(codes, codes.where("id % 40 = 0"), 7, dimensions).collect()
    signs = data > 0
    for query in range(0, 300, 40):
        far = (signs != signs[query]).sum(1)
        want = sorted((int(far[n]), n) for n in range(300) if n != query)[:7]
        mine = sorted((r["rank"], r.distance, r.id) for r in got if r.query_id == query)
        assert [(d, n) for _, d, n in mine] == want
