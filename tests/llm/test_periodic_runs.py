from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtide.llm import periodic_runs
from gridtide.llm.periodic_runs import find_in_texts, find_runs
from gridtide.llm.queries import QUERIES

SPACE = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, runs string, k0 string"


def brute_runs(words, shortest=12):
    """Every stretch of every lag, extended word by word; of one stretch the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(shortest, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return [word for i, word in enumerate(words) if i not in gone]


def agrees(texts):
    sizes, runs, kept = find_in_texts([" ".join(words).encode() for words in texts])
    for words, size, own, text in zip(texts, sizes, runs, kept):
        want = brute_runs(words)
        assert size == len(words)
        assert sorted(map(tuple, own.tolist())) == want, words
        assert text.decode().split() == collapsed(words, want)


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_all_runs_of_texts_full_of_them():
    rng = random.Random(1)
    texts = [fibonacci(n) for n in range(0, 600, 37)]
    for _ in range(150):
        d = rng.randint(1, 6)
        root = "".join(rng.choices("ab", k=d)) * 200
        # Stretches of one short period that touch out of step: long runs without an end inside.
        texts.append("".join(root[rng.randint(0, d) : rng.randint(d, 150)] for _ in range(rng.randint(1, 6))))
        texts.append("b".join("a" * rng.randint(0, 70) for _ in range(rng.randint(1, 6))) * rng.randint(1, 3))
        base = "".join(rng.choices("abcdefgh", k=rng.randint(1, 120)))
        texts.append("".join(rng.choices("xy", k=9)) + (base * 6)[: rng.randint(1, 6 * len(base))] + "xyx")
        texts.append("".join(rng.choices("ab", k=rng.randint(0, 300))))
    agrees([list(text) for text in texts])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=40), max_size=6), st.lists(st.integers(0, 5), max_size=9))
def test_all_runs_of_any_text(parts, order):
    agrees([list("".join(parts[n] for n in order if n < len(parts)) * 2)])


def test_periods_at_the_edges_of_the_scales():
    texts = []
    for q in (15, 16, 31, 32, 33, 63, 64, 127, 128, 255, 256):
        root = [f"w{n}" for n in range(q)]
        for length in (2 * q - 1, 2 * q, 2 * q + 1, 5 * q):
            texts.append((root * 5)[:length])
            texts.append(["x"] * 3 + (root * 5)[:length] + ["y"])
    agrees(texts)


def test_slices_and_batches_of_bounded_size(monkeypatch):
    rng = random.Random(2)
    texts = [list("ab" * rng.randint(0, 80)) + list(rng.choices("abc", k=rng.randint(0, 90))) for _ in range(80)]
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 100)
    agrees(texts)


def brute_query(doc_id, text):
    words = SPACE.findall(text or "")
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [word if i < a else words[a + (i - a) % p] for i, word in enumerate(words)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{start},{length},{q}\n" for start, length, q in sorted(runs, key=lambda r: (r[0], r[2])))
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, " ".join(collapsed(words, runs)))]
    numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(runs), *numbers, *digests)


def test_query_equals_brute_force(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows if len(SPACE.findall(r.text or "")) <= 700]
    taken = {n for n, _ in rows}
    planted = [n for n in range(10**6, 10**6 + 4000) if zlib.crc32(str(n).encode()) % 10 == 0][:60]
    rng = random.Random(3)
    for n in planted:
        rows.append((n, " ".join(rng.choices("abcdefghij", k=rng.randint(0, 300)))))
    rows += [(-1, None), (-2, ""), (-3, " \n\t"), (-4, "a " * 11), (-5, "a\x0ba\x0ca\ra\na\ta " * 2), (-6, "  " * 12)]
    assert len(taken) == len({n for n, _ in rows} - set(planted) - set(range(-6, 0)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert got == {n: brute_query(n, text) for n, text in rows}
    assert sum(r[0] > 0 for n, r in got.items() if n in set(planted)) > 30


def test_nulls_repeated_rows_clashing_names_long_text_and_empty_table(spark):
    long = " ".join(f"w{n % 1500}" for n in range(200_000))
    rows = [(None, None, "r", "k"), (None, "a " * 12, None, None), (1, "a " * 12, "r", "k"), (1, "a " * 12, "r", "k"), (2, long, "r", "k")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = find_runs(docs, ["k0", "doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.k0 or "", r.n_words, [tuple(x) for x in r.runs], len(r.collapsed)) for r in got) == [
        (0, "", 12, [(0, 12, 1)], 1),
        (0, "k", 0, [], 0),
        (1, "k", 12, [(0, 12, 1)], 1),
        (1, "k", 12, [(0, 12, 1)], 1),
        (2, "k", 200_000, [(0, 200_000, 1500)], len(" ".join(f"w{n}" for n in range(1500)))),
    ]
    assert find_runs(docs.limit(0), ["doc_id"]).count() == 0


@pytest.mark.parametrize("size", [1, 2, 4, 8, 64])
def test_window_minima(size):
    values = np.random.default_rng(size).integers(0, 30, 200).astype(np.uint64) + np.uint64(1)
    want = set()
    for start in range(len(values) - size + 1):
        window = values[start : start + size]
        want |= {start + n for n in np.flatnonzero(window == window.min())}
    assert set(periodic_runs._window_minima(values, size).tolist()) == want
