"""Substring removal: repeated windows of words become maximal removal intervals."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.kernels import flat, span_hashes, strings, windows, words
from ratewell.llm.storage import in_blocks, text_bytes

BLOCK_BYTES = 8 << 20
BUCKET_ROWS = 1 << 21

HASHES = "bucket int, block int, hashes binary"
SEEN = "block int, bucket int, seen binary"
RESULT = "doc_id bigint, n_words bigint, removed array<struct<start:int,end:int>>, text string"


def _by_id(table: pa.Table) -> pa.Table:
    return table.take(pc.sort_indices(table, sort_keys=[("doc_id", "ascending")]))


def _windows(table: pa.Table, size: int):
    """Words of the block's rows; the window hashes, first words and rows, rows without id left out."""
    data, offsets = flat(table["text"])
    found = words(data, offsets, lower=False)
    first, row = windows(found.rows, size)
    named = ~np.asarray(table["doc_id"].is_null().combine_chunks().to_numpy(zero_copy_only=False), bool)
    if not named.all():
        keep = named[row]
        first, row = first[keep], row[keep]
    return data, offsets, found, span_hashes(found.hashes, first, first + size), first, row


def _send(size: int, bits: int) -> Callable[[pa.Table], pa.Table]:
    """Distinct window hashes of one block, ascending, cut into ranges of the hash."""

    def run(table: pa.Table) -> pa.Table:
        hashes = np.unique(_windows(table, size)[3])
        cuts = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else [0]
        ends = [*cuts[1:], len(hashes)]
        rows = [(k, hashes[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, ends)) if b > a]
        block = table["block"][0].as_py()
        return pa.table(
            {
                "bucket": pa.array([k for k, _ in rows], pa.int32()),
                "block": pa.array([block] * len(rows), pa.int32()),
                "hashes": pa.array([h for _, h in rows], pa.binary()),
            }
        )

    return run


def _first_block(table: pa.Table) -> pa.Table:
    """For every hash of a range: has a smaller block sent it too? One bit per sent hash."""
    table = table.take(pc.sort_indices(table, sort_keys=[("block", "ascending")]))
    parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["hashes"]]
    joined = np.concatenate(parts)
    order = np.argsort(joined, kind="stable")
    ranked = joined[order]
    again = np.zeros(len(joined), bool)
    again[order[1:]] = ranked[1:] == ranked[:-1]
    bits = [np.packbits(x).tobytes() for x in np.split(again, np.cumsum([len(p) for p in parts])[:-1])]
    return pa.table({"block": table["block"], "bucket": table["bucket"], "seen": pa.array(bits, pa.binary())})


def _runs(mask: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``mask`` that don't cross a row: starts, ends (in words of all rows), row offsets."""
    before = np.zeros(len(mask), bool)
    before[1:] = mask[:-1]
    edge = rows[:-1][rows[:-1] < len(mask)]
    before[edge] = False
    after = np.zeros(len(mask), bool)
    after[:-1] = mask[1:]
    after[edge[edge > 0] - 1] = False
    starts, ends = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    return starts, ends, np.searchsorted(starts, rows)


def _kept(data: np.ndarray, offsets: np.ndarray, found, keep: np.ndarray) -> pa.Array:
    """Kept words of every row, joined by one space."""
    starts, ends = found.starts[keep], found.ends[keep]
    step = np.zeros(len(data) + 1, np.int8)
    step[starts] += 1
    np.subtract.at(step, ends, 1)
    mask = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    row = np.searchsorted(offsets, starts, side="right") - 1
    later = np.zeros(len(starts), bool)
    later[1:] = row[1:] == row[:-1]
    gap = starts[later] - 1  # a blank, since another word of the row stands before it
    out = data.copy()
    out[gap] = 0x20
    mask[gap] = True
    sizes = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return strings(out[mask], sizes[offsets])


def _remove(size: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, seen: pa.Table) -> pa.Table:
        table = _by_id(table)
        data, offsets, found, hashes, first, row = _windows(table, size)
        removed = np.zeros(len(found.starts), bool)
        if len(hashes):
            order = np.argsort(hashes, kind="stable")
            ranked = hashes[order]
            new = np.ones(len(order), bool)
            new[1:] = ranked[1:] != ranked[:-1]
            kind = np.cumsum(new) - 1  # rows ascend by doc_id, so a hash's first row is its smallest document
            sizes = np.diff(np.flatnonzero(np.append(new, True)))
            earlier = _earlier(seen, ranked[new])
            ids = table["doc_id"].fill_null(0).to_numpy()[row[order]]
            owner = np.repeat(ids[new], sizes)
            hit = order[earlier[kind] | (ids > owner)]
            step = np.zeros(len(removed) + 1, np.int32)
            np.add.at(step, first[hit], 1)
            np.subtract.at(step, first[hit] + size, 1)
            removed = np.cumsum(step[:-1]) > 0
        starts, ends, at = _runs(removed, found.rows)
        base = np.repeat(found.rows[:-1], np.diff(at))
        spans = pa.StructArray.from_arrays(
            [pa.array((starts - base).astype(np.int32)), pa.array((ends - base).astype(np.int32))], ["start", "end"]
        )
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "n_words": pa.array(np.diff(found.rows).astype(np.int64)),
                "removed": pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), spans),
                "text": _kept(data, offsets, found, ~removed),
            }
        )

    return run


def _earlier(seen: pa.Table, hashes: np.ndarray) -> np.ndarray:
    """The returned bits put together, one for each distinct hash of the block in ascending order."""
    if not seen.num_rows:
        return np.zeros(len(hashes), bool)
    seen = seen.take(pc.sort_indices(seen, sort_keys=[("bucket", "ascending")]))
    bits = seen["bucket_bits"][0].as_py()
    keys = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    counts = np.bincount(keys, minlength=1 << bits)
    parts = [
        np.unpackbits(np.frombuffer(blob.as_buffer(), np.uint8), count=int(counts[k.as_py()])).astype(bool)
        for k, blob in zip(seen["bucket"], seen["seen"])
    ]
    return np.concatenate(parts)


def remove_repeats(
    docs: DataFrame, size: int = 13, block_bytes: int = BLOCK_BYTES, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Remove each word covered by a window of ``size`` words that also starts in a smaller ``doc_id``.

    Documents are dealt into blocks of consecutive ids. Each block sends the Rabin-Karp hash of
    every distinct window once, so a passage that a third of all documents hold is one entry per
    block. Ranges of the hash answer with one bit per entry: a smaller block holds it too. Inside a
    block the rows in order of their ids decide. Flagged windows merge into maximal intervals.
    The text is shuffled once, by block, and read by both passes.

    Returns ``doc_id, n_words, removed`` (intervals of word numbers, end exclusive) and ``text``, the
    kept words joined by one space. A null text has no words. A row without ``doc_id`` is returned
    whole and counts for no other row. Rows sharing a ``doc_id`` are one document for the comparison
    and one result row each. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    _, total = text_bytes(docs)
    blocks, _ = in_blocks(docs, total, block_bytes)
    bits = max(4, min(30, int(np.ceil(np.log2(max(1, total / 6.5 / bucket_rows))))))
    sent = blocks.groupBy("block").applyInArrow(_send(size, bits), HASHES)
    seen = sent.groupBy("bucket").applyInArrow(_first_block, SEEN).withColumn("bucket_bits", F.lit(bits))
    return blocks.groupBy("block").cogroup(seen.groupBy("block")).applyInArrow(_remove(size), RESULT)
