"""Exact top-k by inner product: one k-d tree per shard, best-first search under a shared k-th score."""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.storage import stored

SHARD_ROWS = 8192
LEAF_ROWS = 64
QUERY_ROWS = 512
EXACT = float(1 << 53)
LONG = np.iinfo(np.int64)

BLOB = "dim int, part int, blob binary"
HITS = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def build_tree(vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row order, (start, end, left child, right child) of every node, and its tight box.

    Nodes are halved at the median of their widest dimension; equal vectors are halved by position.
    """
    order = np.arange(len(vectors))
    nodes: list[list[int]] = [[0, len(vectors), -1, -1]]
    low, high = [vectors.min(0)], [vectors.max(0)]
    k = 0
    while k < len(nodes):
        start, end = nodes[k][:2]
        if end - start > leaf_rows:
            wide = int(np.argmax(high[k] - low[k])) if vectors.shape[1] else None
            half = (start + end) // 2
            part = order[start:end]
            if wide is not None:
                order[start:end] = part[np.argpartition(vectors[part, wide], half - start)]
            for side, (a, b) in enumerate(((start, half), (half, end))):
                nodes[k][2 + side] = len(nodes)
                nodes.append([a, b, -1, -1])
                box = vectors[order[a:b]]
                low.append(box.min(0))
                high.append(box.max(0))
        k += 1
    return order, np.array(nodes), np.array(low), np.array(high)


def _index(table: pa.Table) -> pa.Table:
    dim = table["dim"][0].as_py()
    vectors = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim).astype(np.float64)
    order, nodes, low, high = build_tree(vectors)
    rows, ids = (table[c].to_numpy()[order] for c in ("row", "vec_id"))
    blob = _packed(vectors=vectors[order], rows=rows, ids=ids, nodes=nodes, low=low, high=high)
    return pa.table({"dim": pa.array([dim], pa.int32()), "part": table["part"][:1], "blob": pa.array([blob], pa.binary())})


def _block(table: pa.Table) -> pa.Table:
    dim = table["dim"][0].as_py()
    vectors = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim).astype(np.float64)
    kth = table["kth"].fill_null(np.iinfo(np.int64).min).to_numpy()
    blob = _packed(vectors=vectors, rows=table["row"].to_numpy(), ids=table["vec_id"].to_numpy(), kth=kth)
    return pa.table({"dim": pa.array([dim], pa.int32()), "part": table["part"][:1], "blob": pa.array([blob], pa.binary())})


def _product(queries: np.ndarray, vectors: np.ndarray, size: float) -> np.ndarray:
    """Inner products; whole numbers as doubles while they are exact, as Python integers beyond.

    Products past the range of a long are held at its ends.
    """
    if size < EXACT:
        return queries @ vectors.T
    exact = np.frompyfunc(int, 1, 1)
    product = exact(queries) @ exact(vectors).T
    return np.maximum(np.minimum(product, LONG.max), LONG.min)


def _below(score: float) -> float:
    """The score as a bound: a double that is no larger, since doubles past 2**53 may round up."""
    return score if abs(score) < EXACT else math.nextafter(score, -math.inf)


def _ranked(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best scores, ties to the smaller id."""
    if scores.dtype != object:
        return np.lexsort((ids, -scores))[:k]
    return np.array(sorted(range(len(scores)), key=lambda n: (-scores[n], ids[n]))[:k], dtype=np.int64)


def search(tree, queries, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every query: its number, and the rows and scores of one shard that may be among its best.

    A box's bound is the largest product that a point of it can have. Bounds go down the tree and
    drop boxes under the query's k-th score; the leaves that remain are visited best first, and
    the k-th score rises with what they hold.
    """
    vectors, ids, own = tree["vectors"], tree["ids"], tree["rows"]
    q, kth = queries["vectors"], np.array([_below(float(x)) for x in queries["kth"]])
    size = float(np.abs(q).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, vectors.shape[1]))
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    nodes = tree["nodes"]
    slack = 0.0 if size < EXACT else size * 1e-9
    bounds = up @ tree["high"].T + down @ tree["low"].T + slack
    alive = np.zeros((len(nodes), len(q)), bool)
    alive[0] = True
    for n, (_, _, left, right) in enumerate(nodes):  # children come after their parent
        alive[n] &= bounds[:, n] >= kth
        if left >= 0:
            alive[left] = alive[right] = alive[n]
    leaves = np.flatnonzero(nodes[:, 2] < 0)
    for number in range(len(q)):
        mine = leaves[alive[leaves, number]]
        mine = mine[np.argsort(-bounds[number, mine], kind="stable")]
        limit, at, scores = kth[number], np.zeros(0, np.int64), np.zeros(0)
        step = 4
        while len(mine):
            group, mine = mine[:step], mine[step:]
            spans = np.concatenate([np.arange(*nodes[n, :2]) for n in group])
            got = _product(q[number : number + 1], vectors[spans], size)[0]
            fits = (got >= limit) & (own[spans] != queries["rows"][number])
            at, scores = np.concatenate([at, spans[fits]]), np.concatenate([scores, got[fits]])
            if len(at) > k:
                best = _ranked(scores, ids[at], k)
                at, scores = at[best], scores[best]
            if len(at) >= k:
                limit = max(limit, _below(float(scores.min())))
            mine = mine[bounds[number, mine] >= limit]
            step *= 2
        yield number, ids[at], scores


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree_blob, query_blob in zip(batch["tree"], batch["queries"]):
                tree, queries = (np.load(io.BytesIO(b.as_py())) for b in (tree_blob, query_blob))
                tree, queries = dict(tree), dict(queries)
                found = list(search(tree, queries, k))
                number = np.repeat([n for n, _, _ in found], [len(i) for _, i, _ in found]).astype(np.int64)
                ids = np.concatenate([np.zeros(0, np.int64), *(i for _, i, _ in found)])
                scores = [int(s) for _, _, part in found for s in part]
                yield pa.record_batch(
                    {
                        "query_row": pa.array(queries["rows"][number]),
                        "query_id": pa.array(queries["ids"][number]),
                        "vec_id": pa.array(ids),
                        "score": pa.array(scores, pa.int64()),
                    }
                )

    return run


def _best(hits: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k)


def _meet(trees: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Search every tree with every block of queries of the same dimension."""
    blocks = queries.select("dim", F.col("part").alias("block"), F.col("blob").alias("queries"))
    pairs = trees.select("dim", "part", F.col("blob").alias("tree")).join(blocks, "dim")
    return pairs.repartition("part", "block").select("tree", "queries").mapInArrow(_search(k), HITS)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` rows with the largest inner product for every query row, exactly.

    ``vectors`` has ``vec_id`` and ``vector``, an array of whole numbers; ``is_query`` marks the
    queries, which are searched in blocks against all rows but their own. Shards are dealt by a hash
    and indexed by one k-d tree each. Each block is first searched in one shard; its k-th scores
    there are passed to the search of the others and close most of their boxes.

    Returns ``query_id, rank, vec_id, score``; ties go to the smaller ``vec_id``. Vectors that are
    null or hold a null take no part, scores past the range of a long count as its ends (:func:`scaled`
    holds components there, too), vectors of different lengths don't meet, rows of equal
    ``vec_id`` are rows of their own, and a null ``vec_id`` takes no part.
    """
    plain = vectors.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", F.isnull))
    plain = plain.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<bigint>").alias("vector"), is_query.alias("is_query"))
    plain = stored(plain.select(F.monotonically_increasing_id().alias("row"), F.size("vector").alias("dim"), "*"), "vectors")
    n = plain.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    shards, blocks = max(1, math.ceil(n["n"] / shard_rows)), max(1, math.ceil(n["q"] / QUERY_ROWS))

    deal = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    trees = stored(plain.withColumn("part", deal).groupBy("dim", "part").applyInArrow(_index, BLOB), "trees")
    wanted = plain.where("is_query").withColumn("part", F.pmod(F.xxhash64("row", F.lit(7)), F.lit(blocks)).cast("int"))

    first = wanted.withColumn("kth", F.lit(None).cast("long")).groupBy("dim", "part").applyInArrow(_block, BLOB)
    seed = trees.join(trees.groupBy("dim").agg(F.min("part").alias("part")), ["dim", "part"], "left_semi")
    hits = stored(_best(_meet(seed, first, k), k), "hits")
    kth = hits.where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("kth"))
    second = wanted.join(kth, "row", "left").groupBy("dim", "part").applyInArrow(_block, BLOB)
    others = trees.join(seed.select("dim", "part"), ["dim", "part"], "left_anti")
    every = hits.select("query_row", "query_id", "vec_id", "score").unionByName(_meet(others, second, k))
    return _best(every, k).select("query_id", "rank", "vec_id", "score")


def scaled(embedding: str = "embedding", factor: int = 64) -> Column:
    """``floor(factor * x)`` of every component as a whole number; null unless all are finite."""
    wide = F.transform(embedding, lambda x: x.cast("double") * float(factor))
    odd = F.exists(wide, lambda x: F.isnull(x) | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(F.col(embedding).isNotNull() & ~odd, F.transform(wide, lambda x: F.floor(x)))
