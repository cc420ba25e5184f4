from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from gridtide.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

TEXTS = [
    "", " ", "  ", "   ", "a", " a", "a ", "a  ", "a   b", "a \n b", "a\n\n  b\n", "\n \nB", " \n\nB",
    "I'll say 'tis 100% of 12345 naïve façades!!!", "x" * 5000, "ab" * 3000, "éèê" * 1000, "aaa aaaa aaaaa",
    "日本語のテキスト 😀😀 ​ x", "tab\tx \t y", "<|endoftext|> and <|x|>", "\x00\x1c \x1d ",
]


@pytest.fixture(scope="module", params=[RANKS, MULTI])
def pair(request):
    ranks = bpe.read_ranks(request.param)
    known = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return bpe.CorpusEncoder(request.param, public_tokenizers.PATTERN), known


def test_indented_texts_are_encoded_but_not_kept(monkeypatch):
    """A text with indentation is one part: whole texts must not stay in the worker."""
    monkeypatch.setattr(bpe, "KEPT_PARTS", 200)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 200)
    ranks = bpe.read_ranks(RANKS)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = bpe.CorpusEncoder(RANKS, public_tokenizers.PATTERN)
    for turn in range(12):
        texts = ["\n".join(f"    x{turn}{n} = {k} *  y{n * k}" for n in range(80)) for k in range(10)]
        texts += [f"{turn} plain words {k} " + "z" * 100 for k in range(40)]
        for text, (ids, _) in zip(texts, encoder.encode(texts)):
            assert ids.tolist() == known.encode_ordinary(text)
        parts = {**encoder._parts.now, **encoder._parts._before}
        assert sum(len(k.encode()) + len(a) + len(b) for k, (a, b) in parts.items()) < 100_000
        words = {**encoder._words.now, **encoder._words._before}
        assert all(len(word) <= bpe.LONGEST_KEPT for word in [*parts, *words]) and len(words) < 6000


def test_long_words_merge_by_merge(pair):
    encoder, known = pair
    for word in ("ab" * 4000, "the" * 3000, "aaaaaaa" * 1000, "é😀x" * 900):
        assert encoder.replay.encode_word(word.encode()) == known.encode_ordinary(word)


def test_equals_the_library(pair):
    encoder, known = pair
    for text, (ids, spelled) in zip(TEXTS, encoder.encode(TEXTS)):
        want = known.encode_ordinary(text)
        assert ids.tolist() == want and spelled == b" ".join(b"%d" % n for n in want)
        assert encoder.replay.decode(want) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abAB 1'.\n\té😀 ntheriosd"), max_size=40), max_size=6))
def test_any_text(pair, texts):
    encoder, known = pair
    assert [i.tolist() for i, _ in encoder.encode(texts)] == [known.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=30), max_size=8))
def test_any_bytes_replayed_together_or_one_by_one(pair, words):
    encoder, known = pair
    got = [ids.tolist() for ids in encoder.replay.encode(words)]
    assert got == [encoder.replay.encode_word(word) for word in words]


def test_a_lower_rank_that_comes_up_goes_first():
    """In this vocabulary ``aba`` ranks below ``ab``, so a merge brings up a lower rank."""
    ranks = {bytes([n]): n for n in range(256)} | {b"aba": 300, b"ab": 301, b"abab": 302}
    replay = bpe.MergeReplay(ranks)
    words = [b"ababab", b"xabab", b"abaab", b"aabab", b"ba"]
    assert [i.tolist() for i in replay.encode(words)] == [replay.encode_word(w) for w in words]


def test_cache_limit_changes_nothing(pair, monkeypatch):
    encoder, known = pair
    monkeypatch.setattr(bpe, "KEPT_PARTS", 3)
    for text in TEXTS * 2:
        ((ids, _),) = encoder.encode([text])
        assert ids.tolist() == known.encode_ordinary(text)


def test_rows(spark):
    rows = [(1, "Hello hello world", "x"), (None, "Hello hello world", None), (3, None, None), (1, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    encoded = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, with_ids=True)
    got = encoded.collect()
    assert [r.doc_id for r in got] == [1, None, 3, 1]
    assert [r.n_tokens for r in got] == [len(r.ids) for r in got] and got[2].n_tokens == 0
    spelled = " ".join(map(str, got[0].ids)).encode()
    assert got[0].ids_sha256 == got[1].ids_sha256 == hashlib.sha256(spelled).hexdigest()
    assert got[0].decoded_sha256 == hashlib.sha256(b"Hello hello world").hexdigest()
    assert [bytes(r.decoded) for r in bpe.decode_ids(encoded, RANKS).collect()][0] == b"Hello hello world"
    assert bpe.encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_parts_follow_the_pattern(pair):
    encoder, _ = pair
    whole = regex.compile(public_tokenizers.PATTERN).findall
    for text in TEXTS:
        assert [w for part in encoder._parts_of(text) for w in whole(part)] == whole(text)
