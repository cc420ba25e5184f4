"""Hierarchical packing of tokenized documents into context windows of several sizes.

Documents are routed to tiers by length: what fills whole long windows is cut
off, the remainder goes to the smallest tier that holds it.  Each tier is
packed from the longest tier down: a remainder opens a window of its tier and
gaps are filled with the largest fitting pieces of shorter tiers; only the last
gap of a window is closed by cutting a piece.  Every window is therefore full
and has a power of two as its length.  The tokens left at the end of a task
close windows of the powers of two that add up to them, so nothing is padded.

Finished windows of one tier are dealt to step groups of about the same number
of windows and the same attention cost (the sum of squared piece lengths).

Tokenizing, routing and packing happen in the task that reads the documents:
no shuffle, and a lost task is redone alike, as its rows and its partition
number are the same.  What a task holds back for packing is bounded by
``pool_tokens``.  The windows of two tasks never mix.

A null text counts as empty: its end token alone is packed.  Null ids are
carried along, repeated rows are packed each, an empty table gives no pieces.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import Recent, kept_by_worker, no_cycle_search, slices

TIERS = (256, 512, 1024, 2048)
END_ID = 1
ID_BYTES = 4
SLICE_BYTES = 4 << 20
# Twice so many entries at most, none of a longer key: about 200 bytes each.
KEPT_PARTS = 500_000
KEPT_WORDS = 300_000
LONGEST_KEPT = 64
# For executors that other stages have filled: parts, words and bytes of a slice.
SMALL_CACHES = (100_000, 50_000, 1 << 20)

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
    " sequence_id long, offset long, tier long, step_group long"
)


class WordTokenizer:
    """Ids of texts by a tokenizer that drops white space, as little-endian 32-bit numbers.

    No token spans white space, so the ids of a text are those of its parts
    between ASCII white space, one after the other.  A part of Latin letters,
    digits and marks splits into lower-case words; words and parts are encoded
    once and kept.  Every other part goes through the tokenizer as it is.

    That holds for files that lower-case, split by a pattern into words and mark
    the end of each.  Texts of any other file go through the tokenizer whole.
    """

    WORD_END = "</w>"
    NORMALIZERS = [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ]

    def __init__(self, path: str, kept_parts: int | None = None, kept_words: int | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        pattern = self.word_pattern(self._tokenizer.to_str())
        self._by_words = pattern is not None
        size = self._tokenizer.get_vocab_size()
        tokens = [self._tokenizer.id_to_token(n) or "" for n in range(size)]
        self._ends = [token.endswith(self.WORD_END) for token in tokens]
        self._parts = Recent(kept_parts or KEPT_PARTS, LONGEST_KEPT)
        self._words = Recent(kept_words or KEPT_WORDS, LONGEST_KEPT)
        # Code points whose case and kind no library disagrees about, and the split into words.
        self._plain = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]+").fullmatch
        self._split = regex.compile(pattern or "").findall

    @classmethod
    def word_pattern(cls, file: str) -> str | None:
        """The pattern of the words of a tokenizer file; null if it works another way."""
        spec = json.loads(file)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        kind = {key: steps[0].get(key) for key in ("type", "behavior", "invert")}
        later = [(step.get("type"), step.get("use_regex"), step.get("add_prefix_space")) for step in steps[1:]]
        by_words = (
            (spec["normalizer"] or {}).get("normalizers") == cls.NORMALIZERS
            and kind == {"type": "Split", "behavior": "Removed", "invert": True}
            and later == [("ByteLevel", False, False)]
            and spec["model"].get("end_of_word_suffix") == cls.WORD_END
            and spec["post_processor"] is None
        )
        return steps[0]["pattern"].get("Regex") if by_words else None

    @classmethod
    def of_worker(cls, path: str, *sizes: int) -> WordTokenizer:
        kept, key = kept_by_worker("packing"), ("tokenizer", path, *sizes)
        return kept.get(key) or kept.setdefault(key, cls(path, *sizes))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, words: list[str]) -> None:
        """Encode many words at a time; the last token of each word is marked."""
        for start in range(0, len(words), 64):
            some, at, ids = words[start : start + 64], 0, []
            for n in self._ids([" ".join(some)])[0]:
                ids.append(n)
                if self._ends[n]:
                    self._words.now[some[at]] = struct.pack(f"<{len(ids)}I", *ids)
                    at, ids = at + 1, []

    def _learn(self, parts: set[bytes]) -> None:
        plain, other = {}, []
        for part in parts:
            text = part.decode()
            if self._plain(text) and b"<|" not in part:  # may hold the name of a special token
                plain[part] = self._split(text.lower())
            else:
                other.append((part, text))
        words = {word for split in plain.values() for word in split}
        new = self._words.missing(words)
        self._learn_words(list(new))
        known, made = self._words.now, self._parts.now
        for part, split in plain.items():
            made[part] = b"".join([known[word] for word in split])
        for (part, _), ids in zip(other, self._ids([text for _, text in other])):
            made[part] = struct.pack(f"<{len(ids)}I", *ids)
        self._words.forget_long(new)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        if not self._by_words:
            return (struct.pack(f"<{len(ids)}I", *ids) for ids in self._ids([text or "" for text in texts]))
        split = [(text or "").encode().split() for text in texts]
        every = set().union(*split)
        new = self._parts.missing(every)
        if new:
            with no_cycle_search():
                self._learn(new)
        parts = self._parts.now
        encoded = [b"".join([parts[w] for w in words]) for words in split]
        self._parts.forget_long(new)
        return iter(encoded)


@dataclass(order=True, slots=True)
class Piece:
    """Tokens of a document from ``start`` on, not yet packed."""

    length: int
    order: int
    document: tuple = field(compare=False)  # id and number of tokens
    start: int = field(compare=False)
    ids: bytes = field(compare=False)

    def cut(self, length: int, order: int) -> tuple[Piece, Piece]:
        at = length * ID_BYTES
        return (
            Piece(length, self.order, self.document, self.start, self.ids[:at]),
            Piece(self.length - length, order, self.document, self.start + length, self.ids[at:]),
        )


class TierPacker:
    """Packs pieces into full windows; ``finished`` gathers (tier, pieces)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers = sorted(tiers)
        self.pools: dict[int, list[Piece]] = {tier: [] for tier in self.tiers}
        self.finished: list[tuple[int, list[Piece]]] = []
        self.held = 0
        self._order = 0

    def _route(self, piece: Piece) -> None:
        if piece.length:
            insort(self.pools[next(t for t in self.tiers if piece.length <= t)], piece)

    def add(self, document: tuple, ids: bytes) -> None:
        longest, at = self.tiers[-1], 0
        while len(ids) // ID_BYTES - at >= longest:
            part = ids[at * ID_BYTES : (at + longest) * ID_BYTES]
            self.finished.append((longest, [Piece(longest, 0, document, at, part)]))
            at += longest
        self._order += 1
        rest = Piece(len(ids) // ID_BYTES - at, self._order, document, at, ids[at * ID_BYTES :])
        self._route(rest)
        self.held += rest.length

    def _largest_within(self, gap: int, top: int) -> Piece | None:
        """Take the longest piece of at most ``gap`` tokens from the tiers up to ``top``."""
        for tier in reversed([t for t in self.tiers if t <= top]):
            pool = self.pools[tier]
            at = bisect_right(pool, gap, key=lambda piece: piece.length)
            if at:
                return pool.pop(at - 1)
        return None

    def _shortest(self, top: int) -> Piece | None:
        for tier in self.tiers:
            if tier <= top and self.pools[tier]:
                return self.pools[tier].pop(0)
        return None

    def _fill(self, size: int, top: int) -> None:
        """One full window of ``size`` tokens; the caller knows there are enough."""
        window, gap = [], size
        while gap:
            piece = self._largest_within(gap, top)
            if piece is None:
                self._order += 1
                piece, rest = self._shortest(top).cut(gap, self._order)
                self._route(rest)
            window.append(piece)
            gap -= piece.length
        self.finished.append((size, window))

    def _tokens(self, top: int) -> int:
        return sum(p.length for t in self.tiers if t <= top for p in self.pools[t])

    def pack(self, last: bool = False) -> None:
        """Pack what is held; what cannot fill a window stays, unless this is the last call."""
        for tier in reversed(self.tiers):
            left = self._tokens(tier)
            while self.pools[tier] and left >= tier:
                self._fill(tier, tier)
                left -= tier
        left, size = self._tokens(self.tiers[-1]), self.tiers[-1]
        while last and left:
            while size > left:
                size //= 2
            self._fill(size, self.tiers[-1])
            left -= size
        self.held = left

    def take(self) -> list[tuple[int, list[Piece]]]:
        done, self.finished = self.finished, []
        return done


def step_groups(
    windows: list[tuple[int, list[Piece]]], group_tokens: int
) -> Iterator[tuple[int, tuple[int, list[Piece]]]]:
    """Number the step group of each window: one tier, like counts, balanced attention cost.

    Windows are sorted by cost and dealt to the groups there and back.
    """
    number = 0
    for tier in sorted({tier for tier, _ in windows}, reverse=True):
        same = [window for window in windows if window[0] == tier]
        same.sort(key=lambda w: -sum(p.length**2 for p in w[1]))
        groups = -(-len(same) * tier // group_tokens)
        for n, window in enumerate(same):
            turn, place = divmod(n, groups)
            yield number + (groups - 1 - place if turn % 2 else place), window
        number += groups


def _packed(path: str, tiers: tuple[int, ...], pool_tokens: int, group_tokens: int, caches: tuple[int, int, int]):
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, packer = WordTokenizer.of_worker(path, *caches[:2]), TierPacker(tiers)
        first = TaskContext.get().partitionId() << 40
        sequences, groups = first, first

        def emitted(last: bool) -> pa.RecordBatch:
            nonlocal sequences, groups
            packer.pack(last)
            columns: list[list] = [[] for _ in names]
            top = groups - 1
            for group, (tier, pieces) in step_groups(packer.take(), group_tokens):
                offset, top = 0, max(top, groups + group)
                for p in pieces:
                    crc = zlib.crc32(p.ids)
                    row = (p.document[0], p.start, p.length, crc, p.document[1])
                    row += (sequences, offset, tier, groups + group)
                    for column, value in zip(columns, row):
                        column.append(value)
                    offset += p.length
                sequences += 1
            groups = top + 1
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        end = END_ID.to_bytes(ID_BYTES, "little")
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for start, count in slices(texts, caches[2]):
                some = tokenizer.encode(texts.slice(start, count).to_pylist())
                for doc_id, encoded in zip(ids[start : start + count], some):
                    packer.add((doc_id, len(encoded) // ID_BYTES + 1), encoded + end)
                    if packer.held > pool_tokens or len(packer.finished) > 4096:
                        yield emitted(False)
        yield emitted(True)

    return made


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    tiers: tuple[int, ...] = TIERS,
    pool_tokens: int = 1 << 20,
    group_tokens: int = 1 << 15,
    caches: tuple[int, int, int] = (KEPT_PARTS, KEPT_WORDS, SLICE_BYTES),
) -> DataFrame:
    """A row per piece: document, place in it, window (sequence), place there, tier, step group.

    ``docs`` has ``doc_id`` and ``text``; its other columns are not read.  The
    tiers are powers of two.  ``caches`` trades memory for time; rows do not depend on it.
    """
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are powers of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(_packed(tokenizer_path, tiers, pool_tokens, group_tokens, caches), SCHEMA)
