"""Sharding by a k-d tree over metadata, split at distributed weighted medians."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.llm.storage import running_sum, stored

DIMENSIONS = ("size", "source", "lang", "doc_id")
GRID = 32  # bits of a coordinate; the bits below break ties by text
TIE = 29
BINS = 4096


@dataclass
class Node:
    """An open part of the tree: ``parts`` shards from ``first``; keys below ``cut`` stay with it."""

    first: int
    parts: int
    dimension: int = 0
    cut: int = 0

    @property
    def right(self) -> int:
        return self.first + self.parts // 2


def _coordinates(rows: DataFrame, limit: float) -> DataFrame:
    """Grid keys of every row; rows of equal text share theirs unless together they pass ``limit`` bytes."""
    groups = rows.groupBy("text_hash", "text_crc32").agg(
        F.sum("size").alias("bytes"), *(F.min(c).alias(f"g_{c}") for c in ("source", "lang", "doc_id"))
    )
    keys = ["text_hash", "text_crc32"]
    # At most total / limit groups, a number fixed by the share of a shard and the shard count.
    large = F.broadcast(groups.where(F.col("bytes") > limit).select(*keys))
    own = rows.join(large, keys, "left_semi").select(
        "*", *(F.col(c).alias(f"g_{c}") for c in ("source", "lang", "doc_id")), F.xxhash64("doc_id", "text_hash").alias("tie")
    )
    small = rows.join(large, keys, "left_anti").join(groups.drop("bytes"), keys)
    both = own.unionByName(small.withColumn("tie", F.xxhash64("text_hash", F.lit(1))))
    tie = F.pmod("tie", F.lit(1 << TIE))
    edges = both.agg(*(f(c).alias(f"{n}_{c}") for c in ("size", "g_doc_id") for n, f in (("lo", F.min), ("hi", F.max)))).first()

    def number(column: str) -> Column:
        low, high = edges[f"lo_{column}"], edges[f"hi_{column}"]
        if low is None or high == low:
            return F.lit(0).cast("long")
        share = (F.coalesce(F.col(column), F.lit(low)) - low).cast("double") / float(high - low)
        return F.floor(share * ((1 << GRID) - 1)).cast("long")

    grid = {
        "size": number("size"),
        "source": F.pmod(F.xxhash64("g_source"), F.lit(1 << GRID)),
        "lang": F.pmod(F.xxhash64("g_lang"), F.lit(1 << GRID)),
        "doc_id": number("g_doc_id"),
    }
    keyed = [(F.shiftleft(v, TIE) + tie).alias(f"k_{d}") for d, v in grid.items()]
    return both.select("doc_id", "size", "text_crc32", "text_hash", *keyed)


def _of_node(values: dict[int, int]) -> Column:
    """The value of the row's node; null for nodes without one."""
    top = max(values)
    return F.lit([values.get(k, -1) for k in range(top + 1)])[F.least("node", F.lit(top))].cast("long")


def _key(nodes: list[Node]) -> Column:
    """The row's key in the dimension that its node is cut along."""
    return F.array(*(f"k_{d}" for d in DIMENSIONS))[_of_node({n.first: n.dimension for n in nodes}).cast("int")]


def _split(rows: DataFrame, nodes: list[Node], slack: float) -> None:
    """Choose the widest dimension of every node and its weighted median, all nodes in each pass.

    A pass adds the bytes up in ``BINS`` bins of the open interval of each node; the bin that the
    median falls into is the next interval, until it holds next to nothing or a single key.
    """
    ends = [f(f"k_{d}").alias(f"{n}_{d}") for d in DIMENSIONS for n, f in (("lo", F.min), ("hi", F.max))]
    stats = {r["node"]: r for r in rows.groupBy("node").agg(F.sum("size").alias("bytes"), *ends).collect()}
    active = [n for n in nodes if n.first in stats]
    open_, goal = {}, {}
    for n in active:
        s = stats[n.first]
        wide = max(DIMENSIONS, key=lambda d: s[f"hi_{d}"] - s[f"lo_{d}"])
        n.dimension = DIMENSIONS.index(wide)
        open_[n.first] = s[f"lo_{wide}"], s[f"hi_{wide}"] + 1
        goal[n.first] = s["bytes"] * (n.parts // 2) / n.parts
    while active:
        step = {n.first: max(1, -(-(open_[n.first][1] - open_[n.first][0]) // BINS)) for n in active}
        low, high = (_of_node({n.first: open_[n.first][k] for n in active}) for k in (0, 1))
        key = _key(active)
        inside = rows.where(F.col("node").isin([n.first for n in active]) & (key >= low) & (key < high))
        apart = inside.select("node", "size", (key - low).alias("offset"), _of_node(step).alias("step"))
        bins = apart.groupBy("node", F.expr("offset div step").alias("bin"))
        sums: dict[int, list[tuple[int, int]]] = {}
        for r in bins.agg(F.sum("size").alias("bytes")).collect():
            sums.setdefault(r["node"], []).append((r["bin"], r["bytes"]))
        again = []
        for n in active:
            left = goal[n.first]
            for number, size in sorted(sums[n.first]):
                if size >= left:
                    break
                left -= size
            begin = open_[n.first][0] + number * step[n.first]
            stop = min(open_[n.first][1], begin + step[n.first])
            n.cut = begin if left < size - left else stop
            if size > slack and stop - begin > 1 and 0 < left < size:
                open_[n.first], goal[n.first] = (begin, stop), left
                again.append(n)
        active = again


def kd_shards(
    docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, group_share: float = 0.02, bucket_rows: int = 1_000
) -> DataFrame:
    """Put all documents into shards of nearly equal bytes: the leaves of a k-d tree.

    A node of ``p`` shards is cut along the dimension (size, source, language or id) in which its
    documents spread widest, at the point that leaves ``p // 2`` parts of its bytes on the left, until
    each leaf is one shard; give ``shards``, or ``target_bytes`` for a shard. Cuts are found by sums
    over bins, which combine before the shuffle; the driver sees bin sums and keeps one cut per shard.
    Documents of equal text stay together, ordered by the group's smallest metadata, unless the
    group is over ``group_share`` of a shard: its documents are then placed one by one, so that a hot
    group is spread.

    Returns ``doc_id, size`` (UTF-8 bytes plus 16), ``text_crc32, shard, slot``; slots number a shard
    without gaps. A null text has no bytes; null metadata are values of their own; equal rows are
    placed like any others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
    )
    rows = stored(rows, "sizes")
    whole = rows.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    total = whole["bytes"] or 0
    parts = shards or max(1, math.ceil(total / (target_bytes or total or 1)))
    share = total / parts
    placed = stored(_coordinates(rows, share * group_share), "coordinates")
    placed = placed.withColumn("node", F.lit(0))
    nodes = [Node(0, parts)]
    while nodes := [n for n in nodes if n.parts > 1]:
        _split(placed, nodes, share * 1e-3)
        beyond = F.col("node").isin([n.first for n in nodes]) & (_key(nodes) >= _of_node({n.first: n.cut for n in nodes}))
        placed = stored(placed.withColumn("node", F.when(beyond, _of_node({n.first: n.right for n in nodes}).cast("int")).otherwise(F.col("node"))), "nodes")
        nodes = [part for n in nodes for part in (Node(n.first, n.parts // 2), Node(n.right, n.parts - n.parts // 2))]
    buckets = max(1, math.ceil(whole["n"] / parts / bucket_rows))
    leaf = placed.select(
        "doc_id", "size", "text_crc32", "text_hash", F.col("node").alias("shard"), F.lit(1).alias("one"),
        F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)).alias("bucket"),
    )
    numbered = running_sum(leaf, ["shard"], "bucket", ["doc_id", "text_hash"], "one", "slot")
    return numbered.select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))
