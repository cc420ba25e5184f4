"""Sharding by a k-d tree over the metadata of documents: splits at distributed weighted medians.

The points are the distinct texts, weighted with the bytes of all their copies;
the dimensions are the metadata ``source``, ``lang`` (strings by their first
bytes) and ``n_chars`` (its logarithm), each scaled to [0, 1], and at last the
CRC-32 of the text.  A text with several metadata has the least of each, so
equal texts are one point and are never torn apart unless a single text
outweighs a leaf.

A node is split along its widest metadata dimension at the weighted median, so
that the bytes on both sides match the leaves that are still to come.  Where one
place of that dimension holds the median, as with a source that has most of the
bytes, the next widest dimension decides within that place, and the CRC-32 where
all metadata agree.  A leaf is reached when it is one of so many shards, or when
it has the target bytes.

The median is found by refining a histogram: each round sums weights by node and
bin over all texts and sends a bounded number of sums to the driver, then opens
the bin that holds the median.  Nodes and cuts are tables that the texts are
joined with, of one row per node, so the tree may have very many leaves.  A text
too heavy for one side, by more than ``torn_above`` of the node, is divided: its
copies are numbered, and the side takes the share of numbers it lacks.

Slots number the rows of a shard from 0 without gaps: rows are counted per
shard and input partition, and numbered within it, so no task sees a whole shard.

A null text has no bytes and the CRC-32 of the empty text.  Metadata that are
null, no number or not there count as lowest.  Null ids, repeated rows and ties
are placed like any other row.  An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from gridtide.llm.common import stored

BINS = 512
MOST_SUMS = 1 << 18  # that reach the driver in a round
METADATA = ("source", "lang", "n_chars")
DIMENSIONS = (*METADATA, "crc")
LAST = len(DIMENSIONS) - 1  # one place for one text
CODE_BYTES = 6  # of a string make up its place
PARTITION_SHIFT = 33  # monotonically_increasing_id keeps the partition above these bits
BROADCAST_NODES = 100_000
KEY = ["text_hash", "text_crc32", "size"]


# --- points ---------------------------------------------------------------------


def _code(column: Column) -> Column:
    """A number that orders strings by their first bytes."""
    head = F.rpad(F.hex(F.substring(F.encode(column.cast("string"), "utf-8"), 1, CODE_BYTES)), 2 * CODE_BYTES, "0")
    return F.conv(head, 16, 10).cast("double")


def points(docs: DataFrame) -> DataFrame:
    """A row per document: id, key of the text, metadata as numbers and a row number."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def given(name: str) -> Column:
        return F.col(name) if name in docs.columns else F.lit(None).cast("string")

    chars = F.greatest(given("n_chars").try_cast("double"), F.lit(0.0))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.coalesce(_code(given("source")), F.lit(0.0)).alias("source"),
        F.coalesce(_code(given("lang")), F.lit(0.0)).alias("lang"),
        F.coalesce(F.log2(F.nanvl(chars, F.lit(0.0)) + 1), F.lit(0.0)).alias("n_chars"),
        F.monotonically_increasing_id().alias("row_number"),
    )


def _texts(rows: DataFrame) -> DataFrame:
    """A row per distinct text: key, weight, ``dims`` scaled to [0, 1], node and share of its copies."""
    of_text = rows.groupBy(*KEY).agg(
        F.sum("size").alias("weight"), *[F.min(name).alias(name) for name in METADATA]
    )
    of_text = of_text.withColumn("crc", F.col("text_crc32").cast("double"))
    of_text = stored(of_text, "kd-texts")
    ends = {"low": F.min, "high": F.max}
    found = of_text.agg(*[end(d).alias(f"{n}_{d}") for d in DIMENSIONS for n, end in ends.items()]).first()
    scaled = []
    for d in DIMENSIONS:
        low, high = found[f"low_{d}"], found[f"high_{d}"]
        flat = low is None or low == high
        scaled.append(F.lit(0.0) if flat else (F.col(d) - low) / (high - low))
    return of_text.select(
        *KEY,
        F.col("weight").cast("double").alias("weight"),
        F.array(*scaled).alias("dims"),
        F.lit(0).alias("node"),
        F.lit(0.0).alias("from_share"),
        F.lit(1.0).alias("to_share"),
    )


# --- nodes ----------------------------------------------------------------------


@dataclass
class Node:
    """A part of the points: the leaves it is to give, and how it is split."""

    number: int
    leaves: int
    first_leaf: int
    total: float = 0.0
    goal: float = 0.0  # weight of the lower side
    order: tuple[int, ...] = tuple(range(len(DIMENSIONS)))  # dimensions, widest first
    # The search: places fixed in the first dimensions, the opened interval of the next one
    # and the weight below it.
    fixed: list[float] = field(default_factory=list)
    low: float = 0.0
    high: float = 1.0
    below: float = 0.0
    # The best cut so far: what lies below these places, compared one after the other.
    gap: float = float("inf")
    cut: list[float] = field(default_factory=list)
    # The text on the median, should it be too heavy for one side: its places, share of the lower side.
    heavy: tuple[list[float], float] | None = None

    def open_dimension(self, below: float) -> None:
        self.low, self.high, self.below = 0.0, 1.0 + 1.0 / BINS, below


def _joined(rows: DataFrame, table: list[tuple], schema: str) -> DataFrame:
    """Rows with what a table of nodes says about theirs; rows of other nodes are left out."""
    frame = rows.sparkSession.createDataFrame(table, schema)
    return rows.join(F.broadcast(frame) if len(table) <= BROADCAST_NODES else frame, "node")


def _place(number: int) -> Column:
    """The place in the so many-th widest dimension of the node."""
    return F.get("dims", F.get("order", F.lit(number)))


def _measure(rows: DataFrame, nodes: list[Node]) -> None:
    """Weight of each node and its metadata dimensions, widest first; the CRC-32 comes last."""
    sums = [F.sum("weight").alias("total")]
    for n, d in enumerate(METADATA):
        place = F.get("dims", F.lit(n))
        sums.append((F.max(place) - F.min(place)).alias(d))
    found = {row.node: row for row in rows.groupBy("node").agg(*sums).collect()}
    for node in nodes:
        if row := found.get(node.number):
            node.total = row.total
            node.goal = row.total * (node.leaves // 2) / node.leaves
            widest = sorted(range(len(METADATA)), key=lambda n: -row[METADATA[n]])
            node.order = (*widest, LAST)
            node.open_dimension(0.0)


def _bins(nodes: list[Node]) -> int:
    return max(8, min(BINS, MOST_SUMS // max(len(nodes), 1)))


def _histogram(rows: DataFrame, nodes: list[Node], bins: int) -> dict[tuple[int, int], Row]:
    """Weight, lowest and highest place by node and bin of the node's opened interval."""
    table = [
        (n.number, list(n.order), n.fixed, len(n.fixed), n.low, (n.high - n.low) / bins) for n in nodes
    ]
    schema = "node int, order array<int>, fixed array<double>, depth int, low double, width double"
    joined = _joined(rows, table, schema)
    for n in range(LAST):
        joined = joined.where((F.col("depth") <= n) | (_place(n) == F.get("fixed", F.lit(n))))
    place = F.get("dims", F.get("order", F.col("depth")))
    sums = (
        joined.select("node", "weight", place.alias("place"), "low", "width")
        .where(f"place >= low AND (place - low) / width < {bins}")
        .groupBy("node", F.expr("CAST(floor((place - low) / width) AS INT)").alias("bin"))
        .agg(F.sum("weight").alias("weight"), F.min("place").alias("a"), F.max("place").alias("b"))
    )
    return {(row.node, row.bin): row for row in sums.collect()}


def _refine(node: Node, found: list[Row], tolerance: float) -> bool:
    """Try the cuts between bins; open the bin on the median.  False ends the search here."""
    below = node.below
    for at, row in enumerate(found):
        # Cutting at the lowest place of a bin leaves ``below`` on the lower side.
        if abs(below - node.goal) < node.gap:
            node.gap, node.cut = abs(below - node.goal), [*node.fixed, row.a]
        if below + row.weight > node.goal:
            break
        below += row.weight
    else:
        return False
    if at + 1 < len(found) and abs(below + row.weight - node.goal) < node.gap:
        node.gap, node.cut = abs(below + row.weight - node.goal), [*node.fixed, found[at + 1].a]
    if node.gap <= tolerance * node.total:
        return False
    if row.a < row.b:
        node.low, node.high, node.below = row.a, row.b + (row.b - row.a) / BINS, below
        return True
    # One place holds the median: the next dimension decides within it.
    if len(node.fixed) == LAST:
        node.heavy = ([*node.fixed, row.a], (node.goal - below) / row.weight)
        return False
    node.fixed = [*node.fixed, row.a]
    node.open_dimension(below)
    return True


def _find_cuts(rows: DataFrame, nodes: list[Node], tolerance: float) -> None:
    searching = [n for n in nodes if n.total]
    while searching:
        found: dict[int, list[Row]] = {}
        bins = _histogram(rows, searching, _bins(searching))
        for key in sorted(bins):
            found.setdefault(key[0], []).append(bins[key])
        searching = [n for n in searching if _refine(n, found.get(n.number, []), tolerance)]


def _split(rows: DataFrame, nodes: list[Node], first_child: int, torn_above: float) -> DataFrame:
    """The texts of these nodes in their children, two numbers for each node; a torn text in both."""
    lowest = float("-inf")
    table = []
    for n, node in enumerate(nodes):
        torn = node.heavy if node.heavy and node.gap > torn_above * node.total else None
        cut = torn[0] if torn else node.cut
        places = [*cut, *[lowest] * (len(DIMENSIONS) - len(cut))]
        table.append((node.number, list(node.order), places, torn[1] if torn else None, first_child + 2 * n))
    schema = "node int, order array<int>, cut array<double>, share double, lower int"
    joined = _joined(rows, table, schema)
    below, same = F.lit(False), F.lit(True)
    for n in range(len(DIMENSIONS)):
        here = F.get("cut", F.lit(n))
        below = below | (same & (_place(n) < here))
        same = same & (_place(n) == here)
    middle = F.col("from_share") + (F.col("to_share") - F.col("from_share")) * F.col("share")
    whole = F.struct(
        F.when(below, F.col("lower")).otherwise(F.col("lower") + 1).alias("node"),
        F.col("weight"),
        F.col("from_share"),
        F.col("to_share"),
    )
    parts = [
        F.struct(
            (F.col("lower") + n).alias("node"),
            (F.col("weight") * share).alias("weight"),
            low.alias("from_share"),
            high.alias("to_share"),
        )
        for n, (share, low, high) in enumerate(
            [
                (F.col("share"), F.col("from_share"), middle),
                (1 - F.col("share"), middle, F.col("to_share")),
            ]
        )
    ]
    torn = F.col("share").isNotNull() & same
    placed = F.inline(F.when(torn, F.array(*parts)).otherwise(F.array(whole)))
    return joined.select(*KEY, "dims", placed).select(*rows.columns)


# --- shards ---------------------------------------------------------------------


def shard_documents(
    docs: DataFrame,
    shards: int = 8,
    tolerance: float = 0.0005,
    torn_above: float = 0.02,
    target_bytes: int | None = None,
) -> DataFrame:
    """A row per document: doc_id, size, text_crc32, shard, slot.

    With ``target_bytes`` there are as many shards as leaves of that size take.
    ``tolerance`` is the share of a node's bytes by which a split may miss its
    goal before the next dimension is tried; a node that misses it by more than
    ``torn_above`` holds a text too heavy for one side, whose copies are divided.
    """
    rows = stored(points(docs), "kd-points")
    texts = _texts(rows)
    if target_bytes is not None:
        total = rows.agg(F.sum("size").alias("total")).first().total or 0
        shards = max(1, -(-total // target_bytes))
    nodes, number, done = [Node(0, shards, 0)], 1, []
    leaf = "node int, leaf int"
    while True:
        finished = [n for n in nodes if n.leaves == 1]
        if finished:
            found = _joined(texts, [(n.number, n.first_leaf) for n in finished], leaf)
            done.append(found.select(*KEY, "from_share", "to_share", F.col("leaf").alias("shard")))
        nodes = [n for n in nodes if n.leaves > 1]
        if not nodes:
            break
        _measure(texts, nodes)
        _find_cuts(texts, nodes, tolerance)
        texts = stored(_split(texts, nodes, number, torn_above), "kd-level")
        children = []
        for node in nodes:
            half = node.leaves // 2
            children += [Node(number, half, node.first_leaf)]
            children += [Node(number + 1, node.leaves - half, node.first_leaf + half)]
            number += 2
        nodes = children
    placed = done[0]
    for more in done[1:]:
        placed = placed.union(more)
    return _numbered(_placed(rows, stored(placed, "kd-placed")), ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )


def _placed(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Each row in the shard of its text; the copies of a torn text by their number."""
    rows = rows.select("doc_id", *KEY, "row_number")
    torn = placed.where("from_share > 0 OR to_share < 1")
    keys = torn.select(*KEY).distinct()
    whole = rows.join(placed.where("from_share = 0 AND to_share = 1").drop("from_share", "to_share"), KEY)
    copies = _numbered(rows.join(keys, KEY, "left_semi"), KEY, "copy")
    counts = copies.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"))
    # Few texts are torn; the parts of each are as many as the shards it spans.
    parts = torn.join(counts, KEY).groupBy(*KEY, "copies").agg(
        F.collect_list(F.struct("from_share", "to_share", "shard")).alias("parts")
    )
    lot = (F.col("copy") + 0.5) / F.col("copies")
    part = F.filter("parts", lambda p: (lot >= p["from_share"]) & (lot < p["to_share"]))[0]
    divided = copies.join(parts, KEY).select("doc_id", *KEY, "row_number", part["shard"].alias("shard"))
    return whole.select("doc_id", *KEY, "row_number", "shard").union(divided)


def _numbered(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number the rows of each key from 0: those of earlier input partitions first."""
    rows = rows.withColumn("part", F.shiftright("row_number", PARTITION_SHIFT))
    counts = rows.groupBy(*keys, "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy(*keys, "part").orderBy("row_number")
    numbered = rows.withColumn("place", F.row_number().over(within) - 1).join(offsets, [*keys, "part"])
    return numbered.withColumn(name, (F.col("first") + F.col("place")).cast("long")).drop("part", "place", "first")
