"""Approximate nearest neighbours: a robust-pruned directed graph in each shard, searched by beam.

Distinct vectors are dealt to shards of bounded size by a hash.  A shard's graph
grows by batches: a beam search from the entry (the vector nearest the mean)
through the graph so far proposes neighbours of each new vector; pruning goes
through them from the nearest on and drops those that are nearer, by more than
the factor ``RELAXED``, to a neighbour kept than to the vector, so edges keep
pointing in different directions.  Reversed edges are added, and nodes with too
many are pruned alike.  A second pass proposes for all vectors anew.  At the end
nodes that the entry does not reach get an edge from the nearest one it does.

Graphs are a table in the shared folder.  Query vectors are dealt to blocks; a
task holds one shard and one block and gives each query the best vectors of its
beam, with the Euclidean distance in double precision.  The best of all shards
are merged by rank.  So the work is queries times shards beam searches; the
vectors compared are a small part of each shard.

Equal vectors are one node and stand for their ids, of which the k + 1 smallest
are kept, as no more can be among the k nearest: a vector a third of all rows
share costs what any other costs.

Rows with a null id, and vectors null, empty, zero or holding null or non-finite
numbers, or of another length than most vectors have (the greater of two as
frequent lengths), take no part.  Rows that repeat id and vector count once; an
id with several vectors is found, and asks, with each.  A query does not find
its own row.  Ties go to the smaller id.  With at most k other rows all are
found.  Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.llm.common import stored

SHARD_ROWS = 8192
QUERY_BLOCK = 8192
DEGREE = 32
BUILD_BEAM = 48
SEARCH_BEAM = 128
RELAXED = 1.2
BATCH = 512
AT_ONCE = 4  # nodes each query expands in one step
SEED = 31


class Graph:
    """Vectors and the edges of each (-1 where there are fewer)."""

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, entry: int) -> None:
        self.vectors, self.edges, self.entry = vectors.astype(np.float32), edges, entry
        self.squares = (self.vectors**2).sum(1)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest nodes met for each query, and the others it was led through.

        Both have a row per query, the first nearest first, filled up with -1.
        """
        queries = queries.astype(np.float32)
        count, n = len(queries), len(self.vectors)
        ids = np.full((count, beam), -1)
        far = np.full((count, beam), np.inf, np.float32)
        open_ = np.zeros((count, beam), bool)
        met = np.zeros((count, n), bool)
        ids[:, 0], open_[:, 0], met[:, self.entry] = self.entry, True, True
        far[:, 0] = ((queries - self.vectors[self.entry]) ** 2).sum(1)
        live, passed = np.arange(count), []
        while len(live):
            # The nearest nodes of the beam that are not expanded yet; beams are sorted.
            waiting = open_[live]
            first = waiting & (np.cumsum(waiting, 1) <= AT_ONCE)
            row, place = np.nonzero(first)
            owner = live[row]
            open_[owner, place] = False
            passed.append((owner, ids[owner, place], far[owner, place]))
            around = self.edges[ids[owner, place]]
            turn = np.cumsum(first, 1)[row, place] - 1
            new_owner, new_ids = [], []
            for n_th in range(AT_ONCE):  # one after another, so no node is met twice
                at = turn == n_th
                who, which = owner[at], around[at]
                new = (which >= 0) & ~met[who[:, None], which]
                r, c = np.nonzero(new)
                met[who[r], which[r, c]] = True
                new_owner.append(who[r])
                new_ids.append(which[r, c])
            who, which = np.concatenate(new_owner), np.concatenate(new_ids)
            order = np.argsort(who, kind="stable")
            who, which = who[order], which[order]
            distance = ((queries[who] - self.vectors[which]) ** 2).sum(1)
            # Only what beats the end of a beam can enter it.
            enters = distance < far[who, -1]
            who, which, distance = who[enters], which[enters], distance[enters]
            if len(who):
                rows, starts, sizes = np.unique(who, return_index=True, return_counts=True)
                slot = np.arange(len(who)) - np.repeat(starts, sizes)
                line = np.repeat(np.arange(len(rows)), sizes)
                shape = (len(rows), int(sizes.max()))
                more_ids, more_far = np.full(shape, -1), np.full(shape, np.inf, np.float32)
                more_ids[line, slot], more_far[line, slot] = which, distance
                all_far = np.concatenate([far[rows], more_far], 1)
                all_ids = np.concatenate([ids[rows], more_ids], 1)
                all_open = np.concatenate([open_[rows], more_ids >= 0], 1)
                best = np.argsort(all_far, 1, kind="stable")[:, :beam]
                far[rows] = np.take_along_axis(all_far, best, 1)
                ids[rows] = np.take_along_axis(all_ids, best, 1)
                open_[rows] = np.take_along_axis(all_open, best, 1)
            live = live[open_[live].any(1)]
        owner, node, distance = (np.concatenate(x) for x in zip(*passed))
        left = distance > far[owner, -1]
        return ids, _rows_of(owner[left], node[left], count)


def _rows_of(owner: np.ndarray, value: np.ndarray, count: int) -> np.ndarray:
    """The values of each owner as a row, filled up with -1."""
    order = np.argsort(owner, kind="stable")
    owner, value = owner[order], value[order]
    slot = np.arange(len(owner)) - np.searchsorted(owner, owner)
    rows = np.full((count, int(slot.max(initial=0)) + 1), -1)
    rows[owner, slot] = value
    return rows


def _pruned(vectors: np.ndarray, nodes: np.ndarray, pool: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """At most ``degree`` neighbours for each node out of its pool (-1 where there are none)."""
    valid = (pool >= 0) & (pool != nodes[:, None])
    some = vectors[np.where(valid, pool, 0)]
    near = np.where(valid, ((some - vectors[nodes][:, None]) ** 2).sum(2), np.inf)
    order = np.argsort(near, 1, kind="stable")
    pool, near = np.take_along_axis(pool, order, 1), np.take_along_axis(near, order, 1)
    some = np.take_along_axis(some, order[:, :, None], 1)
    squares = (some**2).sum(2)
    between = squares[:, :, None] + squares[:, None] - 2 * (some @ some.transpose(0, 2, 1))
    alive = np.isfinite(near)
    # A repeated member of a pool lies at distance 0 from itself and goes with it.
    rows, kept = np.arange(len(nodes)), np.full((len(nodes), degree), -1)
    for n in range(degree):
        has = alive.any(1)
        if not has.any():
            break
        chosen = alive.argmax(1)
        kept[has, n] = pool[rows[has], chosen[has]]
        covered = relaxed**2 * between[rows, chosen] <= near
        alive &= ~(covered & has[:, None])
        alive[rows, chosen] = False
        same = pool == np.where(has, kept[:, n], -2)[:, None]
        alive &= ~same
    return kept


def _with_reversed(graph: Graph, nodes: np.ndarray, degree: int, relaxed: float) -> None:
    """Add the reverse of the edges of these nodes; prune nodes that get too many."""
    edges = graph.edges
    source = np.repeat(nodes, edges.shape[1])
    target = edges[nodes].ravel()
    source, target = source[target >= 0], target[target >= 0]
    new = ~(edges[target] == source[:, None]).any(1)
    source, target = source[new], target[new]
    order = np.lexsort((source, target))
    source, target = source[order], target[order]
    owners, starts, counts = np.unique(target, return_index=True, return_counts=True)
    if not len(owners):
        return
    held = (edges[owners] >= 0).sum(1)
    fits = held + counts <= degree
    line = np.repeat(np.arange(len(owners)), counts)
    slot = np.arange(len(source)) - np.repeat(starts, counts)
    at = fits[line]
    edges[owners[line[at]], held[line[at]] + slot[at]] = source[at]
    # Nodes with pools of like size are pruned together.
    over = np.flatnonzero(~fits)
    over = over[np.argsort(counts[over], kind="stable")]
    for start in range(0, len(over), 256):
        some = over[start : start + 256]
        pool = np.full((len(some), degree + int(counts[some].max())), -1)
        pool[:, :degree] = edges[owners[some]]
        for n, owner in enumerate(some.tolist()):
            pool[n, degree : degree + counts[owner]] = source[starts[owner] : starts[owner] + counts[owner]]
        edges[owners[some]] = _pruned(graph.vectors, owners[some], pool, degree, relaxed)


def _reached(edges: np.ndarray, entry: int) -> np.ndarray:
    reached = np.zeros(len(edges), bool)
    reached[entry] = True
    front = np.array([entry])
    while len(front):
        front = np.unique(edges[front])
        front = front[front >= 0]
        front = front[~reached[front]]
        reached[front] = True
    return reached


def _with_all_reached(graph: Graph) -> None:
    """An edge from the nearest reached node to each node the entry does not reach."""
    while not (reached := _reached(graph.edges, graph.entry)).all():
        inside, outside = np.flatnonzero(reached), np.flatnonzero(~reached)[:BATCH]
        dot = graph.vectors[outside] @ graph.vectors[inside].T
        nearest = inside[(graph.squares[inside] - 2 * dot).argmin(1)]
        graph.edges = np.concatenate([graph.edges, _rows_of(nearest, outside, len(graph.edges))], 1)


def built(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED) -> Graph:
    """The graph of distinct vectors; the same for the same vectors in the same order."""
    n = len(vectors)
    entry = int(((vectors - vectors.mean(0)) ** 2).sum(1).argmin())
    graph = Graph(vectors, np.full((n, degree), -1), entry)
    order = np.random.default_rng(SEED).permutation(n)
    first = order[order != entry]
    for turn, nodes in ((0, first), (1, order)):
        done = 0
        while done < len(nodes):
            size = min(BATCH, max(done, 1)) if turn == 0 else BATCH
            some = nodes[done : done + size]
            # The way there gives far neighbours, the beam near ones; edges so far stay in the choice.
            met, passed = graph.search(graph.vectors[some], beam)
            pool = np.concatenate([met, passed, graph.edges[some]], 1)
            factor = 1.0 if turn == 0 else relaxed
            graph.edges[some] = _pruned(graph.vectors, some, pool, degree, factor)
            _with_reversed(graph, some, degree, factor)
            done += len(some)
    _with_all_reached(graph)
    return graph


# --- shards and blocks --------------------------------------------------------------

GRAPH = "shard int, node int, least long, code long, vector array<double>, edges array<int>, entry int"


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _built_shard(table: pa.Table) -> pa.Table:
    table = table.sort_by([("least", "ascending"), ("code", "ascending")])
    graph = built(_matrix(table["vector"]))
    lists = [own[own >= 0] for own in graph.edges]
    count = table.num_rows
    return pa.table(
        {
            "shard": table["shard"],
            "node": pa.array(np.arange(count), pa.int32()),
            "least": table["least"],
            "code": table["code"],
            "vector": table["vector"],
            "edges": pa.array(lists, pa.list_(pa.int32())),
            "entry": pa.array(np.full(count, graph.entry), pa.int32()),
        }
    )


FOUND = "q_least long, q_code long, least long, code long, score double"


def _searched(wanted: int, beam: int):
    names = [field.split()[0] for field in FOUND.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.float64()]

    def made(graphs: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], kind) for n, kind in zip(names, kinds)})
        if not graphs.num_rows or not queries.num_rows:
            return empty
        graphs = graphs.sort_by("node")
        exact, lists = _matrix(graphs["vector"]), graphs["edges"].to_pylist()
        edges = np.full((len(lists), max(1, max(map(len, lists)))), -1)
        for n, own in enumerate(lists):
            edges[n, : len(own)] = own
        graph = Graph(exact, edges, graphs["entry"][0].as_py())
        asked, parts = _matrix(queries["vector"]), []
        keys = [queries[n].to_numpy() for n in ("q_least", "q_code")]
        least, code = graphs["least"].to_numpy(), graphs["code"].to_numpy()
        for start in range(0, len(asked), BATCH):
            some = asked[start : start + BATCH]
            ids, _ = graph.search(some, beam)
            gap = np.where(ids >= 0, np.sqrt(((exact[ids] - some[:, None]) ** 2).sum(2)), np.inf)
            order = np.lexsort((least[ids], gap), axis=1)[:, :wanted]
            row = np.repeat(np.arange(len(some)), order.shape[1])
            node, score = np.take_along_axis(ids, order, 1).ravel(), np.take_along_axis(gap, order, 1).ravel()
            ok = np.isfinite(score)
            row, node, score = row[ok], node[ok], score[ok]
            parts.append([keys[0][start + row], keys[1][start + row], least[node], code[node], score])
        return pa.table({n: pa.array(np.concatenate(p), kind) for n, p, kind in zip(names, zip(*parts), kinds)})

    return made


def usable(vector: Column) -> Column:
    """The vector in double precision; null where it takes no part."""
    doubles = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall(doubles, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(finite & F.exists(doubles, lambda c: c != 0.0), doubles)


def _blocks(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def nearest(
    rows: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM
) -> DataFrame:
    """The k nearest rows found for each query: query_id, rank from 1, vec_id, score.

    Both frames have ``id`` and ``vector``; score is the Euclidean distance.
    """
    wanted = k + 1
    known = rows.select(F.col("id").cast("long"), usable(F.col("vector")).alias("vector"))
    known = known.where("id IS NOT NULL AND vector IS NOT NULL")
    usual = known.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    length = usual["size"] if usual else 0
    asked = queries.select(F.col("id").cast("long").alias("query_id"), usable(F.col("vector")).alias("vector"))
    asked = asked.where((F.size("vector") == length) & F.col("query_id").isNotNull()).distinct()

    # Rank before distinct: a vector that very many rows share ships few rows per task.
    by_id = Window.partitionBy("vector").orderBy("id")
    members = known.where(F.size("vector") == length).withColumn("n", F.dense_rank().over(by_id))
    members = members.where(F.col("n") <= wanted).distinct()
    members = members.withColumn("least", F.first("id").over(by_id))
    members = stored(members.withColumn("code", F.xxhash64("vector")), "ann-members")
    nodes = members.where("n = 1").select("least", "code", "vector")

    n_shards = _blocks(nodes.count(), shard_rows)
    shard = F.pmod(F.xxhash64("code", F.lit("shard")), F.lit(n_shards)).cast("int")
    graphs = nodes.withColumn("shard", shard).groupBy("shard").applyInArrow(_built_shard, GRAPH)
    graphs = stored(graphs, "ann-graphs")

    # Queries with one vector are asked once, by the smallest of their ids.
    asked = stored(asked.withColumn("q_code", F.xxhash64("vector")), "ann-queries")
    once = asked.groupBy("vector", "q_code").agg(F.min("query_id").alias("q_least"))
    n_blocks = _blocks(once.count(), QUERY_BLOCK)
    block = F.pmod(F.xxhash64("q_code", F.lit("block")), F.lit(n_blocks)).cast("int")
    left = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    right = once.select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))
    found = found.applyInArrow(_searched(wanted, beam), FOUND)

    query = ["q_least", "q_code"]
    by_node = Window.partitionBy(*query).orderBy("score", "least")
    found = found.withColumn("n", F.row_number().over(by_node)).where(F.col("n") <= wanted).drop("n")
    ids = found.join(members.select("least", "code", F.col("id").alias("vec_id")), ["least", "code"])
    by_score = Window.partitionBy(*query).orderBy("score", "vec_id")
    ids = ids.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= wanted).drop("n")
    named = asked.join(once.drop("q_code"), "vector").select("query_id", *query)
    best = named.join(ids, query).where("query_id <> vec_id OR q_code <> code")
    by_rank = Window.partitionBy("query_id", "q_code").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(by_rank))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
