"""Exact top-k search in binary codes by incremental multi-index hashing.

A code of any number of bits, in words of 64, is cut into segments of about log2(n)
bits, each with a hash table from segment value to codes.  A query first probes its own segment
values, then all values at distance 1, 2, ... of each segment in turn.  After
radius r in the first j + 1 of m segments (r - 1 in the others), every code
within a Hamming distance of m r + j has been met: were all its segments farther
off, its distance would be larger.  Codes met are verified by their whole
distance, and a query ends when its k-th best distance is within that bound.

Equal codes are searched once and stand for their ids; ties in distance go to
the smaller id.  Codes and query codes are dealt to blocks of bounded size, and
each pair of blocks is searched in one task with tables of its own; the best of
each block are merged by rank.  Only ids of bounded number per code and query
travel, so a code a third of all rows share costs what any other code costs.

Rows with a null id or a null code are neither found nor asked for.  Rows that
repeat id and code count once; an id with several codes is found with each.  A
query does not find its own row; with fewer than k other rows it finds them all.
Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.llm.common import stored

BITS = 64
DATA_BLOCK = 1 << 16
QUERY_BLOCK = 1 << 11


def sign_words(embedding: Column, words: int = 1) -> Column:
    """A bit per dimension, 1 where it is positive, in so many words of 64; the first one lowest.

    Dimensions an embedding lacks are 0; one with more dimensions than bits is an error.
    """

    def word(number: int) -> Column:
        bits = F.transform(
            F.slice(embedding, number * BITS + 1, BITS),
            lambda x, n: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), n)).otherwise(
                F.lit(0).cast("long")
            ),
        )
        return F.aggregate(bits, F.lit(0).cast("long"), lambda all_bits, bit: all_bits.bitwiseOR(bit))

    too_long = F.raise_error(F.lit(f"an embedding has more than {words * BITS} dimensions"))
    code = F.when(embedding.isNotNull(), F.array(*[word(n) for n in range(words)]))
    return F.when(F.size(embedding) > words * BITS, too_long.cast("array<long>")).otherwise(code)


def dimensions(embeddings: DataFrame, name: str) -> int:
    """The length of the longest embedding, 1 at least."""
    return max(embeddings.agg(F.max(F.size(name)).alias("n")).first().n or 1, 1)


def segments_of(n_codes: int, bits: int = BITS) -> list[tuple[int, int]]:
    """(shift, width) of the segments: about as many bits as count the codes, 20 at most."""
    width = min(max(math.log2(max(n_codes, 2)), 4.0), 20.0)
    count = max(1, round(bits / width))
    edges = [n * bits // count for n in range(count + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


class MultiIndex:
    """Hash tables over the segments of codes; ``nearest`` searches them exactly."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray, bits: int = BITS) -> None:
        codes = codes.astype(np.uint64)
        self.codes, self.ids, self.bits = codes.reshape(len(codes), -1), ids, bits
        self.segments = segments_of(len(codes), bits)
        self._tables = []
        for shift, width in self.segments:
            values = self._segment(self.codes, shift, width)
            order = np.argsort(values, kind="stable")
            starts = np.searchsorted(values[order], np.arange((1 << width) + 1))
            self._tables.append((order, starts))
        self._masks: dict[tuple[int, int], np.ndarray] = {}

    @staticmethod
    def _segment(codes: np.ndarray, shift: int, width: int) -> np.ndarray:
        """The values of a segment of each row; it may reach into the next word."""
        word, at = divmod(shift, BITS)
        values = codes[:, word] >> np.uint64(at)
        if at + width > BITS:
            values = values | (codes[:, word + 1] << np.uint64(BITS - at))
        return (values & np.uint64((1 << width) - 1)).astype(np.int64)

    def _flips(self, width: int, radius: int) -> np.ndarray:
        """All ways to flip ``radius`` bits of a segment."""
        key = (width, radius)
        if key not in self._masks:
            made = [sum(1 << n for n in chosen) for chosen in combinations(range(width), radius)]
            self._masks[key] = np.array(made, np.int64)
        return self._masks[key]

    def nearest(self, query: int | np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and distances of the k codes of lowest (distance, id); the radius covered."""
        query = np.asarray(query, np.uint64).reshape(1, -1)
        met = np.zeros(len(self.codes), bool)
        places, distances = np.empty(0, np.int64), np.empty(0, np.int64)
        covered = -1
        for radius in range(max(width for _, width in self.segments) + 1):
            for number, (shift, width) in enumerate(self.segments):
                if radius <= width:
                    order, starts = self._tables[number]
                    values = self._segment(query, shift, width) ^ self._flips(width, radius)
                    low, high = starts[values], starts[values + 1]
                    used = high > low
                    low, sizes = low[used], (high - low)[used]
                    # The rows of all buckets: each run of places from its start on.
                    ends = np.cumsum(sizes)
                    at = np.arange(ends[-1] if len(ends) else 0)
                    at += np.repeat(low - (ends - sizes), sizes)
                    new = order[at]
                    new = new[~met[new]]
                    met[new] = True
                    places = np.concatenate([places, new])
                    far = np.bitwise_count(self.codes[new] ^ query).sum(1, dtype=np.int64)
                    distances = np.concatenate([distances, far])
                covered = len(self.segments) * radius + number
                if len(places) >= k and np.partition(distances, k - 1)[k - 1] <= covered:
                    best = np.lexsort((self.ids[places], distances))[:k]
                    return places[best], distances[best], covered
        best = np.lexsort((self.ids[places], distances))[:k]
        return places[best], distances[best], covered


def _searched(k: int, bits: int):
    def words_of(column: pa.ChunkedArray) -> np.ndarray:
        column = column.combine_chunks()
        return column.flatten().to_numpy().reshape(len(column), -1)

    def made(queries: pa.Table, data: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_code": [], "code": [], "distance": []}
        if data.num_rows and queries.num_rows:
            codes = words_of(data["code"])
            index = MultiIndex(codes.view(np.uint64), data["least_id"].to_numpy(), bits)
            for query in words_of(queries["query_code"]):
                places, distances, _ = index.nearest(query.view(np.uint64), k)
                out["query_code"] += [query.tolist()] * len(places)
                out["code"] += codes[places].tolist()
                out["distance"] += distances.tolist()
        words = pa.list_(pa.int64())
        kinds = {"query_code": words, "code": words, "distance": pa.int32()}
        return pa.table({n: pa.array(v, kinds[n]) for n, v in out.items()})

    return made


def _blocks(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def search(rows: DataFrame, queries: DataFrame, k: int, bits: int = BITS) -> DataFrame:
    """The k nearest rows of each query: query_id, rank from 1, id, distance.

    Both frames have ``id`` and ``code``: an array of words of 64 bits, or one
    such word.  The lowest ``bits`` of the code count.
    """

    def words(frame: DataFrame) -> DataFrame:
        several = isinstance(frame.schema["code"].dataType, T.ArrayType)
        one = F.when(F.col("code").isNotNull(), F.array(F.col("code").cast("long"))) if not several else F.col("code")
        return frame.select(F.col("id").cast("long"), one.alias("code"))

    known, asked = words(rows), words(queries)
    known, asked = (x.where("id IS NOT NULL AND code IS NOT NULL").distinct() for x in (known, asked))

    # Of equal codes only the k + 1 smallest ids can be among the k nearest without the query itself.
    wanted = k + 1
    by_id = Window.partitionBy("code").orderBy("id")
    members = known.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= wanted)
    members = stored(members, "topk-members")
    codes = members.where("n = 1").select("code", F.col("id").alias("least_id"))
    query_codes = asked.select(F.col("code").alias("query_code")).distinct()

    n_data = _blocks(codes.count(), DATA_BLOCK)
    n_query = _blocks(query_codes.count(), QUERY_BLOCK)

    def met(frame: DataFrame, code: str, own: int, other: int, names: tuple[str, str]) -> DataFrame:
        """Every row in its block, once for each block of the other side."""
        block = F.pmod(F.xxhash64(code), F.lit(own))
        others = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        return frame.select("*", block.alias(names[0]), others.alias(names[1]))

    left = met(query_codes, "query_code", n_query, n_data, ("qb", "db"))
    right = met(codes, "code", n_data, n_query, ("db", "qb"))
    found = (
        left.groupBy("qb", "db")
        .cogroup(right.groupBy("qb", "db"))
        .applyInArrow(_searched(wanted, bits), "query_code array<long>, code array<long>, distance int")
    )
    # Codes in the order of their least ids, then the ids of the best codes.
    near = found.join(codes, "code")
    by_code = Window.partitionBy("query_code").orderBy("distance", "least_id")
    near = near.withColumn("n", F.row_number().over(by_code)).where(F.col("n") <= wanted)
    ids = near.select("query_code", "code", "distance").join(members.select("code", "id"), "code")
    by_distance = Window.partitionBy("query_code").orderBy("distance", "id")
    ids = ids.withColumn("n", F.row_number().over(by_distance)).where(F.col("n") <= wanted)
    best = asked.withColumnRenamed("id", "query_id").join(
        ids.select(F.col("query_code").alias("code"), "id", "distance"), "code"
    )
    by_rank = Window.partitionBy("query_id", "code").orderBy("distance", "id")
    ranked = best.where("query_id <> id OR distance > 0").withColumn("rank", F.row_number().over(by_rank))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
