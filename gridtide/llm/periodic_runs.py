"""Periodic runs of words by multi-scale minimizers, and the texts without the repeats.

A run is a stretch of consecutive words with smallest period q (words q apart
are equal), of at least max(shortest, 2 q) words, that no neighbouring word
extends.  All runs of a text are found, for every period:

1. Periods below 16 are found by direct lag scans: the words are compared with
   those q places on.
2. Scale k = 8, 16, 32, ... finds the periods from 2 k to 4 k - 1.  Every k-gram
   has a hash; the minima of windows of k k-grams are the anchors.  A window
   inside the first period of a run is repeated a period later, and so is its
   minimum: two anchors with equal k-grams at the distance of the period.  Pairs
   of equal anchors at the distances of the scale seed an extension to both
   sides, which compares blocks of 2^t words by their hashes.
3. A k-gram that has itself a period of at most k / 2 lies in a run found
   before, and would be an anchor once each such period.  The first and the last
   k-gram of that run stand for all of them: where a longer run holds one of its
   ends, it holds the copy a period on.  Other equal k-grams are more than k / 2
   apart, so each anchor meets at most eight others.
4. A longer run that holds no such end is spanned by two runs of one short
   period that touch each other; the lags at which their words agree are seeds.

So the runs are complete, in time n log n.  Words are compared by numbers that
are one to one within a batch, blocks of words by 64-bit hashes.

Texts are taken in slices of bounded bytes, and those of one length class
together; a single longer text is a slice of its own.  Null and blank texts have
no words and no runs.  Rows without an id and repeated rows are treated like
others; other columns are passed on as asked for; an empty table gives an empty
result.  No row is moved between tasks.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm.common import slices

SHORTEST = 12
FIRST_SCALE = 8
SLICE_BYTES = 4 << 20
BATCH_WORDS = 1 << 17
TOP_LEVEL = 12  # blocks of at most 2^12 words are hashed

RUNS = "array<struct<start long, length long, period long>>"
_RUN_TYPE = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Blocks:
    """Hashes of the blocks of 2^t words that start at each place."""

    def __init__(self, words: np.ndarray) -> None:
        self.levels = [_mixed(words.astype(np.uint64) + np.uint64(1))]

    def level(self, t: int) -> np.ndarray:
        """Blocks that reach past the end have no equals."""
        while len(self.levels) <= t:
            half, gap = self.levels[-1], 1 << (len(self.levels) - 1)
            behind = np.arange(len(half), dtype=np.uint64) | np.uint64(1 << 63)
            behind[: len(half) - gap] = half[gap:]
            self.levels.append(_mixed(_mixed(half) + behind * np.uint64(0x9E3779B97F4A7C15)))
        return self.levels[t]

    def _stepped(self, at: np.ndarray, lag: np.ndarray, top: int, forward: bool) -> np.ndarray:
        """Move every place on while its block equals that of the lag; blocks get ever shorter."""
        at = at.copy()
        n = len(self.levels[0])
        for t in range(top, -1, -1):
            hashes, size = self.level(t), 1 << t
            live = np.arange(len(at))
            while len(live):
                low = at[live] if forward else at[live] - size
                high = low + lag[live]
                inside = (low >= 0) & (high < n)
                live, low, high = live[inside], low[inside], high[inside]
                live = live[hashes[low] == hashes[high]]
                at[live] += size if forward else -size
                if t < top:
                    break
        return at

    def extended(self, at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of the stretch of that lag around each place."""
        top = min(TOP_LEVEL, max(len(self.levels[0]).bit_length() - 1, 0))
        first = self._stepped(at, lag, top, False)
        last = self._stepped(at, lag, top, True)
        return first, last + lag - 1


def _window_minima(hashes: np.ndarray, size: int) -> np.ndarray:
    """Places that hold the minimum of some window of ``size`` (a power of two) places."""
    low = hashes
    step = 1
    while step < size:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if not len(low):
        return np.empty(0, np.int64)
    # The windows a place lies in start at the size places up to it; the largest of their minima.
    edge = np.zeros(size - 1, np.uint64)
    high = np.concatenate([edge, low, edge])
    step = 1
    while step < size:
        high = np.maximum(high[:-step], high[step:])
        step *= 2
    return np.flatnonzero(high == hashes)


def _lag_stretches(words: np.ndarray, lag: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the stretches of one lag that are long enough."""
    same = np.zeros(len(words) - lag + 2, np.int8)
    same[1:-1] = words[:-lag] == words[lag:]
    turns = np.flatnonzero(same[1:] != same[:-1])
    first, end = turns[::2], turns[1::2]
    fits = end - first >= max(lag, shortest - lag)
    return first[fits], end[fits] + lag - 1


def _of_least_period(first: np.ndarray, last: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows (first, last, period), sorted by period and place; one stretch, one period."""
    rows = np.stack([first, last, period], 1)
    rows = rows[np.lexsort((period, last, first))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 0], rows[:, 2]))]


def _equal_pairs(keys: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of places with equal keys whose distance belongs to the scale."""
    order = np.lexsort((places, keys))
    keys, places = keys[order], places[order]
    found_at, found_lag = [], []
    for step in range(1, len(keys)):
        lag = places[step:] - places[:-step]
        near = (keys[step:] == keys[:-step]) & (lag < 4 * k)
        if not near.any():
            break
        near &= lag >= 2 * k
        found_at.append(places[:-step][near])
        found_lag.append(lag[near])
    if not found_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_lag)


def _touching(runs: np.ndarray, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) where two runs of one period touch and agree at a lag of the scale."""
    found_at, found_lag = [], []
    length = runs[:, 1] - runs[:, 0] + 1
    long = runs[length >= 2 * k]
    a, b = long[:-1], long[1:]
    pairs = np.flatnonzero((a[:, 2] == b[:, 2]) & (b[:, 0] <= a[:, 1] + 1))
    for n in pairs.tolist():
        (a0, a1, d), (b0, b1, _) = long[n].tolist(), long[n + 1].tolist()
        # Where in the last period of the first run the second one's root stands.
        root = words[b0 : b0 + d]
        tail = words[a1 - 2 * d + 2 : a1 + 1]
        places = np.flatnonzero(tail[:d] == root[0])
        for x in places.tolist():
            if np.array_equal(tail[x : x + d], root):
                lag = b0 - (a1 - 2 * d + 2 + x)
                lags = np.arange(lag + -(-(2 * k - lag) // d) * d, min(4 * k - 1, a1 - a0 + 1, b1 - b0 + 1) + 1, d)
                lags = lags[lags > 0]
                found_lag.append(lags)
                found_at.append(np.maximum(a0, b0 - lags))
                break
    if not found_at:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_at), np.concatenate(found_lag)


def runs_of(words: np.ndarray, longest: int, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (first, last, period) of all runs; no text in ``words`` has more than ``longest``."""
    kept_from = min(shortest, FIRST_SCALE)  # the first scale asks for shorter runs of short periods
    parts = []
    for lag in range(1, min(2 * FIRST_SCALE - 1, longest // 2) + 1):
        first, last = _lag_stretches(words, lag, kept_from)
        parts.append((first, last, np.full(len(first), lag)))
    if not parts:
        return np.empty((0, 3), np.int64)
    runs = _of_least_period(*map(np.concatenate, zip(*parts)))

    blocks, k = Blocks(words), FIRST_SCALE
    while 4 * k <= longest:
        hashes = blocks.level(k.bit_length() - 1)
        short = runs[(2 * runs[:, 2] <= k) & (runs[:, 1] - runs[:, 0] + 1 >= k)]
        inside = np.zeros(len(words) + 1, np.int64)
        np.add.at(inside, short[:, 0], 1)
        np.add.at(inside, short[:, 1] - k + 2, -1)
        anchors = _window_minima(hashes, k)
        anchors = anchors[np.cumsum(inside)[anchors] == 0]
        seeds = [_equal_pairs(hashes[places], places, k) for places in (anchors, short[:, 0], short[:, 1] - k + 1)]
        seeds.append(_touching(short, words, k))
        at, lag = (np.concatenate(x) for x in zip(*seeds))
        if len(at):
            first, last = blocks.extended(at, lag)
            fits = last - first + 1 >= 2 * lag
            found = np.unique(np.stack([first[fits], last[fits], lag[fits]], 1), axis=0)
            runs = _of_least_period(*np.concatenate([runs, found]).T)
        k *= 2
    return runs[runs[:, 1] - runs[:, 0] + 1 >= shortest]


# --- texts ------------------------------------------------------------------------


def _batches(sizes: list[int]) -> Iterator[list[int]]:
    """Texts of one length class together, a bounded number of words at a time."""
    classes = defaultdict(list)
    for n, size in enumerate(sizes):
        classes[size.bit_length()].append(n)
    for members in classes.values():
        held, total = [], 0
        for n in members:
            if held and total + sizes[n] > BATCH_WORDS:
                yield held
                held, total = [], 0
            held.append(n)
            total += sizes[n]
        yield held


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """One number per different word, a number of its own after each text, and where texts start."""
    known: dict[bytes, int] = {}
    for words in texts:
        for word in words:
            if word not in known:
                known[word] = len(known)
    starts = np.cumsum([0] + [len(words) + 1 for words in texts])
    numbers = np.empty(starts[-1], np.int64)
    for n, words in enumerate(texts):
        numbers[starts[n] : starts[n + 1] - 1] = [known[word] for word in words]
        numbers[starts[n + 1] - 1] = len(known) + n
    return numbers, starts


def find_in_texts(texts: list[bytes | None], shortest: int = SHORTEST) -> tuple[list[int], list, list[bytes]]:
    """Of each text the number of words, its runs (start, length, period) and its kept words."""
    split = [(text or b"").split() for text in texts]
    sizes = [len(words) for words in split]
    runs: list[np.ndarray] = [np.empty((0, 3), np.int64)] * len(texts)
    kept = [b""] * len(texts)
    for members in _batches(sizes):
        numbers, starts = _numbered([split[n] for n in members])
        found = runs_of(numbers, max(sizes[n] for n in members), shortest)
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
        owner = np.searchsorted(starts, found[:, 0], "right") - 1
        bounds = np.searchsorted(owner, np.arange(len(members) + 1))
        for place, n in enumerate(members):
            own = found[bounds[place] : bounds[place + 1]]
            if not len(own):
                kept[n] = b" ".join(split[n])
                continue
            start = own[:, 0] - starts[place]
            length = own[:, 1] - own[:, 0] + 1
            runs[n] = np.stack([start, length, own[:, 2]], 1)
            change = np.zeros(sizes[n] + 1, np.int64)
            np.add.at(change, start + own[:, 2], 1)
            np.add.at(change, start + length, -1)
            stays = np.cumsum(change)[:-1] == 0
            kept[n] = b" ".join([split[n][i] for i in np.flatnonzero(stays).tolist()])
    return sizes, runs, kept


def find_runs(docs: DataFrame, keep: list[str], shortest: int = SHORTEST) -> DataFrame:
    """The kept columns, n_words, runs (by start, then period) and collapsed text of every row.

    A word is collapsed away if a run contains it after that run's first period;
    the words that stay are joined by one space.
    """
    text = F.col("text").cast("string").cast("binary").alias("text")
    rows = docs.select(*[F.col(name).alias(f"k{n}") for n, name in enumerate(keep)], text)
    schema = T.StructType([T.StructField(f"k{n}", docs.schema[name].dataType) for n, name in enumerate(keep)])
    schema = schema.add("n_words", "long").add("runs", T.DataType.fromDDL(RUNS)).add("collapsed", "binary")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, count in slices(batch.column(len(keep)), SLICE_BYTES):
                some = batch.slice(start, count)
                n_words, runs, kept = find_in_texts(some.column(len(keep)).to_pylist(), shortest)
                offsets = np.cumsum([0] + [len(own) for own in runs])
                fields = [pa.array(column) for column in np.concatenate(runs).T]
                values = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values).cast(_RUN_TYPE)
                arrays = [*some.columns[: len(keep)], pa.array(n_words, pa.int64()), lists, pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    found = rows.mapInArrow(made, schema)
    names = [F.col(f"k{n}").alias(name) for n, name in enumerate(keep)]
    return found.select(*names, "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))
