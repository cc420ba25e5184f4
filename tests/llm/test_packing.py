from __future__ import annotations

import random
import struct
import zlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridtide.llm import packing
from gridtide.llm.packing import TierPacker, WordTokenizer, pack_documents, step_groups

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return WordTokenizer(PATH)


def ids_of(data: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(data) // 4}I", data))


TEXTS = [
    "", "  \n", "Hello, WORLD!! it's don't I'll x2y 10.5%", "Ärger Éclair ÇA ñandú œuvre ŒUVRE İstanbul ΣΑΣ",
    "ﬁ ² ½ ٣ 日本語 текст x y\u0085z á étude ẞ", "<|endoftext|> a<|startoftext|>b",
    "\x00 \x1c\x1d tab\tx", "word" * 2000, "***&&& a*b ___ a_b #tag @x",
]


def test_other_tokenizer_files_take_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), WordTokenizer(path)
    assert WordTokenizer.word_pattern(library.to_str()) is None
    for text, data in zip(TEXTS, own.encode(TEXTS)):
        assert ids_of(data) == library.encode(text, add_special_tokens=False).ids


def test_what_is_kept_is_bounded(known, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_PARTS", 300)
    monkeypatch.setattr(packing, "KEPT_WORDS", 200)
    own, rng = WordTokenizer(PATH), random.Random(9)
    for turn in range(40):
        texts = [" ".join(f"w{rng.randrange(10**5)} {'y' * 90}{n}" for n in range(20)) for _ in range(5)]
        for text, data in zip(texts, own.encode(texts)):
            assert ids_of(data) == known.encode(text, add_special_tokens=False).ids
        for kept, limit in ((own._parts, 300), (own._words, 200)):
            held = {**kept.now, **kept._before}
            assert len(held) <= 2 * (limit + 400) and all(len(key) <= packing.LONGEST_KEPT for key in held)


def test_ids_equal_the_library(known, own):
    for text, data in zip(TEXTS, own.encode(TEXTS)):
        assert ids_of(data) == known.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_ids_of_any_text(known, own, texts):
    texts = [text.encode("utf-8", "ignore").decode() for text in texts]
    want = [known.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ids_of(data) for data in own.encode(texts)] == want


def test_cache_limit_changes_nothing(known, own, monkeypatch):
    monkeypatch.setattr(packing, "KEPT_PARTS", 3)
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    for text in TEXTS * 2:
        (data,) = own.encode([text])
        assert ids_of(data) == known.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("pool", [1 << 20, 3000])
def test_windows_are_full_and_hold_every_token_once(pool):
    rng = random.Random(5)
    packer, windows, lengths = TierPacker(), [], {}
    for n in range(700):
        lengths[n] = rng.choice([1, 3, 200, 256, 257, 700, 1500, 2048, 2049, 9000, rng.randint(1, 3000)])
        packer.add((n, lengths[n]), n.to_bytes(4, "little") * lengths[n])
        if packer.held > pool:
            packer.pack()
            windows += packer.take()
    packer.pack(last=True)
    windows += packer.take()
    assert packer.held == 0
    covered: dict[int, list] = {n: [] for n in lengths}
    for tier, pieces in windows:
        assert sum(p.length for p in pieces) == tier and tier & (tier - 1) == 0 and tier <= 2048
        for p in pieces:
            assert p.ids == p.document[0].to_bytes(4, "little") * p.length
            covered[p.document[0]].append((p.start, p.length))
    for n, parts in covered.items():
        ends = [0]
        for start, length in sorted(parts):
            assert start == ends[-1]
            ends.append(start + length)
        assert ends[-1] == lengths[n]
    # Short documents stay whole unless they close a last gap.
    whole = sum(len(covered[n]) == 1 for n in lengths if lengths[n] <= 256)
    assert whole > 0.7 * sum(length <= 256 for length in lengths.values())
    assert sum(tier < 256 for tier, _ in windows) <= 8


def test_step_groups_are_balanced():
    packer = TierPacker()
    rng = random.Random(2)
    for n in range(2000):
        packer.add((n, 0), bytes(4 * rng.randint(1, 2048)))
    packer.pack(last=True)
    groups: dict[int, list] = {}
    for number, (tier, pieces) in step_groups(packer.take(), 1 << 15):
        groups.setdefault(number, []).append((tier, sum(p.length**2 for p in pieces)))
    assert all(len({tier for tier, _ in g}) == 1 for g in groups.values())
    long = [g for g in groups.values() if g[0][0] == 2048]
    sizes, costs = [len(g) for g in long], [sum(c for _, c in g) / len(g) for g in long]
    assert max(sizes) - min(sizes) <= 1 and max(costs) < 1.1 * min(costs)


def test_rows(spark, known):
    rows = [(n, "word " * (n * 37 % 3000), "x") for n in range(60)]
    rows += [(None, "no id", None), (5, None, None), (6, "", None), (7, "twice", "x"), (7, "twice", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string").repartition(3)
    got = pack_documents(docs, PATH).collect()
    windows: dict[int, list] = {}
    for r in got:
        windows.setdefault(r.sequence_id, []).append(r)
    for pieces in windows.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:n]) for n in range(len(pieces))]
        assert sum(r.length for r in pieces) == pieces[0].tier
    for doc_id, text, _ in rows[:60]:
        if doc_id in (5, 6, 7):
            continue
        ids = [*known.encode(text, add_special_tokens=False).ids, 1]
        parts = sorted((r for r in got if r.doc_id == doc_id), key=lambda r: r.start)
        assert sum(r.length for r in parts) == len(ids) == parts[0].doc_tokens
        for r in parts:
            data = struct.pack(f"<{r.length}I", *ids[r.start : r.start + r.length])
            assert zlib.crc32(data) == r.ids_crc32
    assert {r.doc_tokens for r in got if r.doc_id is None} == {3}
    twice = len(known.encode("twice", add_special_tokens=False).ids) + 1
    assert sum(r.length for r in got if r.doc_id == 7 and r.doc_tokens == twice) == 2 * twice
    assert pack_documents(docs.limit(0), PATH).count() == 0


def test_tiers_are_powers_of_two(spark):
    with pytest.raises(ValueError):
        pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH, tiers=(100,))
