"""Line removal: a repeated line stays only in the smallest document that holds it."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ratewell.llm.kernels import flat, is_blank, lower_bytes, slices, span_hashes, strings
from ratewell.llm.storage import stored

KEYS = "hash bigint, doc_id bigint, row bigint, pos int"
DROPPED, PENDING, TAIL = 0, 1, 2
DECISIONS = "kind int, hash bigint, doc_id bigint, row bigint, pos int"
BITMAPS = "doc_id bigint, row bigint, bitmap binary"


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the lines of every row, cut at ``\\n``, and the index of each row's first line."""
    breaks = np.flatnonzero(data == 0x0A)
    inside = np.searchsorted(breaks, offsets)
    rows = inside + np.arange(len(offsets))
    starts, ends = np.empty(rows[-1], np.int64), np.empty(rows[-1], np.int64)
    first = np.zeros(rows[-1] + 1, bool)
    first[rows] = True
    starts[first[:-1]] = offsets[:-1]
    starts[~first[:-1]] = breaks + 1
    ends[first[1:]] = offsets[1:]
    ends[~first[1:]] = breaks
    return starts, ends, rows


def line_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines whose stripped key has at least ``min_chars`` code points, and the hashes of their keys."""
    solid = np.flatnonzero(~is_blank(data))
    if not len(solid):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    full = b > a
    left, right = solid[a[full]], solid[b[full] - 1] + 1
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    long = chars[right] - chars[left] >= min_chars
    return np.flatnonzero(full)[long], span_hashes(lower_bytes(data), left[long], right[long])


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch["text"])
            ids, row_hash = (batch[c].to_numpy(zero_copy_only=False) for c in ("doc_id", "row"))
            for i, j in slices(offsets):
                part = data[offsets[i] : offsets[j]]
                starts, ends, rows = line_spans(part, offsets[i : j + 1] - offsets[i])
                line, hashes = line_keys(part, starts, ends, min_chars)
                row = np.searchsorted(rows, line, side="right") - 1
                yield pa.record_batch(
                    {
                        "hash": pa.array(hashes.view(np.int64)),
                        "doc_id": pa.array(ids[i + row]),
                        "row": pa.array(row_hash[i + row]),
                        "pos": pa.array((line - rows[row]).astype(np.int32)),
                    }
                )

    return run


def _decisions(kind: int, hashes, ids, row, pos) -> pa.RecordBatch:
    kinds = np.full(len(hashes), kind, np.int32)
    return pa.record_batch([pa.array(x) for x in (kinds, hashes, ids, row, pos)], ["kind", "hash", "doc_id", "row", "pos"])


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk one range in order of hash, document and position; only the run at hand is remembered.

    The range's first run may have begun in the range before, so its smallest document is
    reported as pending, and every range reports its last run for the range after.
    """
    run: tuple[int, int] | None = None
    head = True
    for batch in batches:
        if not batch.num_rows:
            continue
        hashes, ids, row, pos = (batch[c].to_numpy(zero_copy_only=False) for c in ("hash", "doc_id", "row", "pos"))
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        number = np.cumsum(new) - 1
        owners = ids[new]
        if run is not None and run[0] == hashes[0]:
            owners[0] = run[1]
        elif run is not None:
            head = False
        later = ids > owners[number]
        yield _decisions(DROPPED, hashes[later], ids[later], row[later], pos[later])
        if head:
            first = (number == 0) & ~later
            yield _decisions(PENDING, hashes[first], ids[first], row[first], pos[first])
            head = number[-1] == 0
        run = int(hashes[-1]), int(owners[-1])
    if run is not None:
        zero = np.zeros(1, np.int64)
        yield _decisions(TAIL, np.array([run[0]]), np.array([run[1]]), zero, zero.astype(np.int32))


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for lines in batch["lines"]:
            at = lines.values.to_numpy()
            keep = np.ones((int(at.max()) // 8 + 1) * 8, np.uint8)
            keep[at] = 0
            maps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
        yield pa.record_batch({"doc_id": batch["doc_id"], "row": batch["row"], "bitmap": pa.array(maps, pa.binary())})


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Compressed bitmaps of the lines to keep, for every document that loses a line.

    A line's key is the line without blanks at both ends and with A-Z in lower case. Keys of at
    least ``min_chars`` code points found in two or more documents keep their lines only in the
    smallest ``doc_id`` holding them. Key hashes are range partitioned with document and position as
    secondary sort, so a key that a third of all documents hold is cut over as many ranges as it
    needs; each range is streamed once and remembers one run.

    Returns ``doc_id, row, bitmap``: ``row`` is ``xxhash64`` of the text, since an id may come with
    several texts, and ``bitmap`` is zlib over little-endian bits, 1 for keep, lines past its end kept.
    Rows without ``doc_id`` neither lose lines nor count; a null text is one empty line.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text"
    )
    order = ["hash", "doc_id", "pos", "row"]
    placed = rows.mapInArrow(_keys(min_chars), KEYS).repartitionByRange(*order).sortWithinPartitions(*order)
    decided = stored(placed.mapInArrow(_first_occurrences, DECISIONS), "lines")
    edge = decided.where(F.col("kind") != DROPPED)
    owner = edge.groupBy("hash").agg(F.min("doc_id").alias("owner"))
    pending = decided.where(F.col("kind") == PENDING).join(owner, "hash").where(F.col("doc_id") > F.col("owner"))
    gone = decided.where(F.col("kind") == DROPPED).select("doc_id", "row", "pos")
    gone = gone.unionByName(pending.select("doc_id", "row", "pos"))
    by_row = gone.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("lines"))
    return by_row.mapInArrow(_compress, BITMAPS)


def _mask(bitmaps: pa.Array, rows: np.ndarray) -> np.ndarray:
    keep = np.ones(rows[-1], bool)
    for k in np.flatnonzero(bitmaps.is_valid().to_numpy(zero_copy_only=False)):
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmaps[int(k)].as_buffer()), np.uint8), bitorder="little")
        n = min(len(bits), rows[k + 1] - rows[k])
        keep[rows[k] : rows[k] + n] = bits[:n]
    return keep


def _kept(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray, keep: np.ndarray, offsets: np.ndarray):
    """Kept lines of every row joined by ``\\n``."""
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))[keep]
    starts, ends = starts[keep], ends[keep]
    later = np.zeros(len(starts), bool)
    later[1:] = row[1:] == row[:-1]
    step = np.zeros(len(data) + 1, np.int32)
    np.add.at(step, starts - later, 1)  # with the line break before it
    np.subtract.at(step, ends, 1)
    mask = np.cumsum(step[:-1]) > 0
    sizes = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return strings(data[mask], sizes[offsets])


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc = batch["doc"]
        names = [doc.type.field(k).name for k in range(doc.type.num_fields)]
        fields = dict(zip(names, doc.flatten()))
        data, offsets = flat(fields["text"])
        starts, ends, rows = line_spans(data, offsets)
        keep = _mask(batch["bitmap"], rows)
        kept = np.add.reduceat(keep.astype(np.int64), rows[:-1]) if len(keep) else np.zeros(0, np.int64)
        fields["text"] = _kept(data, starts, ends, rows, keep, offsets)
        whole = pa.StructArray.from_arrays([fields[n] for n in names], names)
        yield pa.record_batch({"doc": whole, "n_lines": pa.array(np.diff(rows)), "n_dropped": pa.array(np.diff(rows) - kept)})


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Apply :func:`keep_bitmaps`: ``doc`` (every column of ``docs``, text reduced), ``n_lines``, ``n_dropped``.

    A null text becomes the empty text. The columns stay inside ``doc``, so none can clash.
    """
    left = docs.select(F.struct("*").alias("doc"))
    key = (F.col("doc.doc_id") == bitmaps["doc_id"]) & (F.xxhash64("doc.text") == bitmaps["row"])
    joined = left.join(bitmaps.hint("shuffle_hash"), key, "left").select("doc", "bitmap")
    counts = [StructField(n, LongType()) for n in ("n_lines", "n_dropped")]
    return joined.mapInArrow(_apply, StructType([StructField("doc", left.schema["doc"].dataType), *counts]))


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """:func:`apply_bitmaps` with the :func:`keep_bitmaps` of the same documents."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars))
