"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.kernels import distinct_by_row, flat, shingles, slices, words
from ratewell.llm.storage import stored, text_bytes

ITEMS = "item_id bigint, hashes binary"
MATCHES = "doc_id bigint, row bigint, item_id bigint, n_shared bigint, n_item bigint"
FILTER_BITS = 20


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch["text"])
            hashes, row = shingles(words(data, offsets, lower=True), size)
            values, at = distinct_by_row(hashes, row, batch.num_rows)
            blobs = [values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.record_batch({"item_id": batch["item_id"], "hashes": pa.array(blobs, pa.binary())})

    return run


class Index:
    """MinHash signatures of one block of items, grouped by the size of their shingle sets.

    Items of up to ``u`` shingles keep their ``floor((1 - t) * u) + 1`` smallest hashes. A document
    holding at least the share ``t`` of such an item lacks fewer shingles than that, so it must hold
    one of the signature: the search has no misses.
    """

    def __init__(self, ids: list[int], sets: list[np.ndarray], percent: int) -> None:
        self.ids, self.sets, self.percent = np.array(ids, np.int64), sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        upper = 1 << np.ceil(np.log2(np.maximum(self.sizes, 1))).astype(np.int64)
        kept = [s[: (100 - percent) * int(u) // 100 + 1] for s, u in zip(sets, upper)]
        marks = np.concatenate([np.zeros(0, np.uint64), *kept])
        owner = np.repeat(np.arange(len(sets)), [len(k) for k in kept])
        order = np.argsort(marks, kind="stable")
        self.marks, self.owner = marks[order], owner[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.marks & np.uint64((1 << FILTER_BITS) - 1)] = True

    def candidates(self, hashes: np.ndarray, row: np.ndarray, row_sizes: np.ndarray) -> np.ndarray:
        """Distinct (row, item) pairs that share a signature hash and whose sizes allow a match."""
        near = np.flatnonzero(self.filter[hashes & np.uint64((1 << FILTER_BITS) - 1)])
        low = np.searchsorted(self.marks, hashes[near])
        count = np.searchsorted(self.marks, hashes[near], side="right") - low
        near, low, count = near[count > 0], low[count > 0], count[count > 0]
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        rows, items = np.repeat(row[near], count), self.owner[place]
        fits = row_sizes[rows] * 100 >= self.sizes[items] * self.percent
        return np.unique(np.stack([rows[fits], items[fits]], 1), axis=0)

    def matches(self, hashes: np.ndarray, row: np.ndarray, n_rows: int) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles) of every pair at or above the threshold."""
        bounds = np.searchsorted(row, np.arange(n_rows + 1))
        found, held, last = [], hashes[:0], -1
        for r, item in self.candidates(hashes, row, np.diff(bounds)).tolist():
            if r != last:
                held, last = np.unique(hashes[bounds[r] : bounds[r + 1]]), r
            wanted = self.sets[item]
            at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
            shared = int((held[at] == wanted).sum())
            if shared * 100 >= len(wanted) * self.percent:
                found.append((r, item, shared))
        return found


def _search(index: Index, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch["text"])
            ids, key = batch["doc_id"], batch["row"]
            for i, j in slices(offsets):
                table = words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True)
                found = index.matches(*shingles(table, size), j - i)
                at = pa.array([i + r for r, _, _ in found], pa.int64())
                item = np.array([k for _, k, _ in found], np.int64)
                yield pa.record_batch(
                    {
                        "doc_id": ids.take(at),
                        "row": key.take(at),
                        "item_id": pa.array(index.ids[item]),
                        "n_shared": pa.array([s for _, _, s in found], pa.int64()),
                        "n_item": pa.array(index.sizes[item]),
                    }
                )

    return run


def find_items(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 80, block_bytes: int = 32 << 20) -> DataFrame:
    """Documents that hold at least ``percent`` of an item's distinct ``size``-word shingles.

    Words are lower-cased (A-Z). Items are indexed in blocks of about ``block_bytes`` of text. With more
    than one, the matches of a block are stored before the next index is built, so that the driver
    and a closure hold one index, however large the benchmark. The documents are scanned once per
    block and never shuffled. Candidates from the signatures are verified on the exact shingle sets.

    Returns ``doc_id, row`` (``xxhash64`` of the text), ``item_id, n_shared, n_item``, one row per
    document row and item row. An item of fewer than ``size`` words is one shingle, its whole
    sequence, and is held only by a document of the same words. Null or empty texts hold nothing and
    are held by nothing; a null ``doc_id`` is
    returned as null and an item without id is left out.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.length("text") > 0)
    blocks = max(1, math.ceil(text_bytes(items)[1] / block_bytes))
    sets = items.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = None
    for k in range(blocks):
        rows = sets.where(F.col("_block") == k).select("item_id", "text").mapInArrow(_sets(size), ITEMS).collect()
        full = [(r["item_id"], np.frombuffer(bytes(r["hashes"]), np.uint64)) for r in rows if r["hashes"]]
        known = [(i, s) for i, s in full if i is not None]
        part = docs.mapInArrow(_search(Index([i for i, _ in known], [s for _, s in known], percent), size), MATCHES)
        part = stored(part, "matches") if blocks > 1 else part
        del rows, full, known
        found = part if found is None else found.unionByName(part)
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that hold an item; every column is kept."""
    bad = find_items(docs, items, size, percent).select("doc_id", "row").distinct()
    left = docs.select(F.struct("*").alias("doc"))
    key = F.col("doc.doc_id").eqNullSafe(bad["doc_id"]) & (F.xxhash64("doc.text") == bad["row"])
    return left.join(bad.hint("shuffle_hash"), key, "left_anti").select("doc.*")
