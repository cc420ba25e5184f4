from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest

from gridtide.llm.kd_shards import shard_documents

SCHEMA = "doc_id long, text string, size string, shard string"


def sharded(spark, texts, shards=8, **options):
    rows = [(None if n % 50 == 49 else n, text, "x", "y") for n, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return shard_documents(docs, shards, **options).collect()


def words(rng, n):
    return " ".join(rng.choice(["the", "of", "été", "x", "日本"]) + str(rng.randint(0, 99)) for _ in range(n))


def check(rows, texts, shards):
    want = Counter((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    assert Counter((r["size"], r.text_crc32) for r in rows) == want
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    weight = Counter()
    for r in rows:
        weight[r.shard] += r["size"]
    places = defaultdict(set)
    for r in rows:
        places[r["size"], r.text_crc32].add(r.shard)
    return [weight[n] for n in range(shards)], places


@pytest.mark.parametrize("shards", [8, 5, 1])
def test_sizes_are_near_equal_and_equal_texts_together(spark, shards):
    rng = random.Random(3)
    texts = [words(rng, rng.randint(1, 200)) for _ in range(1500)]
    texts += [texts[0]] * 60 + ["", None, " "]
    weights, places = check(sharded(spark, texts, shards), texts, shards)
    assert max(weights) < 1.02 * min(weights) and all(len(p) == 1 for p in places.values())


def test_a_text_of_a_third_of_all_rows_is_divided(spark):
    rng = random.Random(4)
    hot = words(rng, 60)
    texts = [words(rng, rng.randint(20, 100)) for _ in range(600)] + [hot] * 300
    rows = sharded(spark, texts)
    weights, places = check(rows, texts, 8)
    assert max(weights) < 1.03 * min(weights)
    torn = [key for key, found in places.items() if len(found) > 1]
    assert torn == [(len(hot.encode()) + 1, zlib.crc32(hot.encode()))]


def test_only_equal_texts_one_row_no_row(spark):
    for texts in (["same"] * 400, [None] * 100):
        weights, _ = check(sharded(spark, texts), texts, 8)
        assert max(weights) < 2.5 * max(min(weights), 1)
    assert len(sharded(spark, ["one"])) == 1
    assert sharded(spark, []) == []


def described(spark, rows):
    schema = "doc_id long, text string, source string, lang string, n_chars long, size string"
    return spark.createDataFrame([(*r, "x") for r in rows], schema).repartition(4)


def test_splits_follow_the_widest_metadata_dimension(spark):
    """Four sources of equal weight: two shards part them in the middle of their order."""
    rng = random.Random(6)
    rows = []
    for n in range(800):
        text = f"{n:04} " + "w" * 100
        rows.append((n, text, "abcd"[n % 4] + "-site", "en", 105 + rng.randint(0, 1)))
    rows += [(1000 + n, rows[0][1], "zz", "de", 999) for n in range(5)]  # a copy with other metadata
    found = {r.doc_id: r.shard for r in shard_documents(described(spark, rows), 2, tolerance=0.02).collect()}
    by_source = defaultdict(set)
    for n, _, source, *_ in rows[:800]:
        by_source[source].add(found[n])
    assert by_source == {"a-site": {0}, "b-site": {0}, "c-site": {1}, "d-site": {1}}
    assert {found[1000 + n] for n in range(5)} == {found[0]}


def test_one_source_with_most_rows_is_divided_along_the_next_dimension(spark):
    rows = [(n, f"{n:04} " + "w" * 50, "hot" if n % 10 else f"s{n}", "en", n) for n in range(1000)]
    found = shard_documents(described(spark, rows), 4).collect()
    weights = Counter()
    for r in found:
        weights[r.shard] += r["size"]
    assert max(weights.values()) < 1.01 * min(weights.values())
    hot = sorted((rows[r.doc_id][4], r.shard) for r in found if rows[r.doc_id][2] == "hot")
    # Within the source, shards are ranges of the number of characters.
    assert sum(a[1] != b[1] for a, b in zip(hot, hot[1:])) <= 4


def test_a_thousand_leaves_of_target_bytes(spark):
    rng = random.Random(8)
    rows = [(n, f"{n} " + "x" * rng.randint(20, 200), rng.choice(["s", "t"]), "en", n % 77) for n in range(24_000)]
    total = sum(len(r[1]) + 1 for r in rows)
    found = shard_documents(described(spark, rows), target_bytes=-(-total // 1000)).collect()
    weights = Counter()
    for r in found:
        weights[r.shard] += r["size"]
    assert len(found) == 24_000 and sorted(weights) == list(range(1000))
    assert max(weights.values()) < 1.5 * total / 1000


def test_metadata_that_are_null_absent_or_no_numbers(spark):
    rows = [(n, f"text {n}", None, None, None) for n in range(300)]
    schema = "doc_id long, text string, source string, lang string, n_chars string"
    for frame in (
        described(spark, rows),
        described(spark, rows).drop("source", "lang", "n_chars"),
        spark.createDataFrame([(n, f"text {n}", "é" * (n % 3), "", "many" if n % 2 else "-5") for n in range(300)], schema),
    ):
        weights = Counter()
        for r in shard_documents(frame, 3).collect():
            weights[r.shard] += r["size"]
        assert sorted(weights) == [0, 1, 2] and max(weights.values()) < 1.05 * min(weights.values())
