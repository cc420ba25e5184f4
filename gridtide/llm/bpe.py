"""Byte-level BPE by replaying the merges over a corpus of words.

The distinct words of the documents a task reads together form its corpus.
An inverted index maps each mergeable token pair to the word positions where it
stands.  Merges are applied in the order of their ranks, each at all its
positions in one go; an applied merge touches only the two neighbours of a
position, whose new pairs enter the index.  The ids of a word are kept, so a
word of many documents is merged once, and a document's ids are those of its
words, one after the other.  Nothing is shuffled; what is kept is bounded.

A null text counts as empty (no ids).  Null document ids, ties and repeated
rows are carried along; whole texts are encoded, however long one word is.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import Recent, kept_by_worker, no_cycle_search, slices

SLICE_BYTES = 8 << 20
# Twice so many entries at most, none of a longer key: 200 to 400 bytes each.
KEPT_PARTS = 150_000
KEPT_WORDS = 100_000
LONGEST_KEPT = 64

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeReplay:
    """Encode words by the ranks of their tokens; ``decode`` joins the tokens of ids."""

    NONE = np.int32(1 << 30)  # no merge of this pair

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._bytes = np.array([ranks[bytes([n])] for n in range(256)], np.int32)
        # Any split of a token into two tokens is a pair that merges into it.
        self._merged = {
            (ranks[token[:at]], ranks[token[at:]]): rank
            for token, rank in ranks.items()
            for at in range(1, len(token))
            if token[:at] in ranks and token[at:] in ranks
        }
        self._twins = {rank for (a, b), rank in self._merged.items() if a == b}
        keys = np.array([(a << 32) | b for a, b in self._merged], np.int64)
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.iinfo(np.int64).max)
        self._ranks = np.append(np.array(list(self._merged.values()), np.int32)[order], self.NONE)

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._ranks[at], self.NONE)

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word: at any time its pair of the lowest rank merges, leftmost first."""
        lengths = np.array([len(word) for word in words], np.int64)
        ends = np.cumsum(lengths)
        token = self._bytes[np.frombuffer(b"".join(words), np.uint8)]
        size = len(token)
        if not size:
            return [np.empty(0, np.int32) for _ in words]
        following, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        following[ends[lengths > 0] - 1] = -1
        before[(ends - lengths)[lengths > 0]] = -1
        alive = np.ones(size, bool)
        rank_at = np.full(size, self.NONE, np.int32)
        inner = np.flatnonzero(following >= 0)
        rank_at[inner] = self._rank_of(token[inner], token[following[inner]])

        # The inverted index: for each rank the positions of its pair.
        index: dict[int, list[np.ndarray]] = {}

        def enter(places: np.ndarray) -> list[int]:
            """Index positions by their rank; returns the ranks that are new to the index."""
            ranks = rank_at[places]
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            edges = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]]).tolist()
            new = []
            for start, end in zip(edges, [*edges[1:], len(ranks)]):
                rank = int(ranks[start])
                if rank in index:
                    index[rank].append(places[start:end])
                else:
                    index[rank] = [places[start:end]]
                    new.append(rank)
            return new

        first = np.flatnonzero(rank_at < self.NONE)
        queue = enter(first) if len(first) else []
        heapq.heapify(queue)
        disturbed: list[np.ndarray] = []
        while queue:
            rank = heapq.heappop(queue)
            places = index.pop(rank)
            at = places[0] if len(places) == 1 else np.unique(np.concatenate(places))
            at = at[rank_at[at] == rank]  # others were changed by a merge beside them
            if not len(at):
                continue
            if rank in self._twins:
                at = _not_overlapping(np.sort(at), following)
            second = following[at]
            right = following[second]
            token[at] = rank
            alive[second] = False
            rank_at[second] = self.NONE
            following[at] = right
            inside = right >= 0
            before[right[inside]] = at[inside]
            left = before[at]
            touched = np.concatenate([left[left >= 0], at])
            beyond = following[touched]
            rank_at[touched[beyond < 0]] = self.NONE
            touched, beyond = touched[beyond >= 0], beyond[beyond >= 0]
            ranks = self._rank_of(token[touched], token[beyond])
            rank_at[touched] = ranks
            if (ranks < rank).any():
                disturbed.append(touched[ranks < rank])
            touched = touched[ranks < self.NONE]
            if len(touched):
                for new in enter(touched):
                    heapq.heappush(queue, new)
        token, number = token[alive], np.repeat(np.arange(len(words)), lengths)[alive]
        out = np.split(token, np.searchsorted(number, np.arange(1, len(words))))
        # A merge may bring up a pair of lower rank, which goes before further places of its own
        # rank in that word: such words are encoded once more, merge by merge.
        for places in disturbed:
            for n in np.unique(np.searchsorted(ends, places, side="right")).tolist():
                out[n] = np.array(self.encode_word(words[n]), np.int32)
        return out

    def encode_word(self, word: bytes) -> list[int]:
        """One word, merge by merge: the lowest rank first, of equal ones the first place."""
        ids = [int(self._bytes[b]) for b in word]
        count = len(ids)
        before, behind = list(range(-1, count - 1)), list(range(1, count + 1))
        queue = [(self._merged.get(pair, self.NONE), at) for at, pair in enumerate(zip(ids, ids[1:]))]
        queue = [entry for entry in queue if entry[0] != self.NONE]
        heapq.heapify(queue)
        while queue:
            rank, at = heapq.heappop(queue)
            after = behind[at]
            # A place may have been merged away, or have another neighbour by now.
            if ids[at] < 0 or after >= count or self._merged.get((ids[at], ids[after])) != rank:
                continue
            ids[at], ids[after] = int(rank), -1
            behind[at] = behind[after]
            if behind[at] < count:
                before[behind[at]] = at
            for low, high in ((before[at], at), (at, behind[at])):
                if low >= 0 and high < count:
                    made = self._merged.get((ids[low], ids[high]), self.NONE)
                    if made != self.NONE:
                        heapq.heappush(queue, (made, low))
        return [n for n in ids if n >= 0]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.tokens[n] for n in ids])


def _not_overlapping(places: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Leave out places that are the second half of the pair before: equal tokens in a row."""
    chosen, taken = [], -1
    for at, after in zip(places.tolist(), following[places].tolist()):
        if at != taken:
            chosen.append(at)
            taken = after
    return np.array(chosen, np.int64)


class CorpusEncoder:
    """Ids of texts by way of their distinct parts and words.

    A part is what stands between single spaces, the space before it included.
    The pattern never joins two parts, except where a space has white space on
    both sides (or the end behind it): such a text is one part.
    """

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import regex

        self.replay = MergeReplay(read_ranks(ranks_path))
        self._split = regex.compile(pattern).findall
        self._joined = re.compile(r"\s \s|\s \Z").search
        self._parts = Recent(KEPT_PARTS, LONGEST_KEPT)  # ids, and the ids spelled out
        self._words = Recent(KEPT_WORDS, LONGEST_KEPT)
        self._numerals = {n: b"%d" % n for n in self.replay.tokens}

    @classmethod
    def of_worker(cls, ranks_path: str, pattern: str) -> CorpusEncoder:
        kept, key = kept_by_worker("bpe"), ("byte bpe", ranks_path, pattern)
        return kept.get(key) or kept.setdefault(key, cls(ranks_path, pattern))

    def _parts_of(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self._joined(text):
            return [text]
        first, *others = text.split(" ")
        parts = [" " + part for part in others]
        return [first, *parts] if first else parts

    def _learn(self, parts: list[str]) -> None:
        split = [self._split(part) for part in parts]
        every = set().union(*split)
        new = self._words.missing(every)
        known, made, numerals = self._words.now, self._parts.now, self._numerals
        known.update(zip(new, self.replay.encode([word.encode() for word in new])))
        for part, words in zip(parts, split):
            ids = known[words[0]] if len(words) == 1 else np.concatenate([known[w] for w in words])
            spelled = b" ".join([numerals[n] for n in ids.tolist()])
            made[part] = (ids.tobytes(), spelled)
        self._words.forget_long(new)

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, bytes]]:
        """The ids of each text, and the ids as decimal numbers with single spaces between."""
        split = [self._parts_of(text) for text in texts]
        new = self._parts.missing(set().union(*split))
        with no_cycle_search():
            self._learn(list(new))
        known, encoded = self._parts.now, []
        for parts in split:
            found = [known[part] for part in parts]
            ids = np.frombuffer(b"".join([f[0] for f in found]), np.int32)
            encoded.append((ids, b" ".join([f[1] for f in found])))
        self._parts.forget_long(new)
        return encoded


def _encoded(ranks_path: str, pattern: str, with_ids: bool):
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CorpusEncoder.of_worker(ranks_path, pattern)
        for batch in batches:
            for start, count in slices(batch.column(1), SLICE_BYTES):
                some = batch.slice(start, count)
                rows: list[list] = [[], [], [], []]
                for ids, spelled in encoder.encode(some.column(1).to_pylist()):
                    decoded = encoder.replay.decode(ids.tolist())
                    rows[0].append(len(ids))
                    rows[1].append(hashlib.sha256(spelled).hexdigest())
                    rows[2].append(hashlib.sha256(decoded).hexdigest())
                    rows[3].append(ids)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
                arrays = [some.column(0), *map(pa.array, rows, kinds)][: len(names)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return made


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False
) -> DataFrame:
    """A row per document: number of ids, digests of the ids and of the decoded bytes, the ids.

    ``docs`` has ``doc_id`` and ``text``; its other columns are not read.
    ``ranks_path`` and ``pattern`` name the vocabulary, a file each machine has.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    schema = f"{SCHEMA}, ids array<int>" if with_ids else SCHEMA
    return rows.mapInArrow(_encoded(ranks_path, pattern, with_ids), schema)


def decode_ids(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The text (bytes) of each row's ``ids``, beside its ``doc_id``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = MergeReplay(read_ranks(ranks_path))
        for batch in batches:
            decoded = [replay.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            arrays = [batch.column(0), pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(made, "doc_id long, decoded binary")
