"""Mixture-controlled packing: deficit round-robin over source queues into fixed windows of tokens."""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator, Mapping
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.llm.kernels import flat, slices, words
from ratewell.llm.storage import running_sum, stored

END = 1
CACHE = 1_000_000
TOKENS = "doc_id bigint, source string, text_hash bigint, n bigint, ids binary"
PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, source string"
)

class Encoder:
    """Ids of words, each distinct word encoded once while there is room to remember it."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[int, int] = {}
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, words_: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [x.ids for x in self.tokenizer.encode_batch_fast(words_, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for ids in got for i in ids), np.uint32, int(sizes.sum())), sizes

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of every row and the offsets of the rows.

        The vocabulary drops white space and never joins across it, so a text's ids are those of its
        words one after another.
        """
        found = words(data, offsets, lower=False)
        if not len(found.starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        kinds, at, inverse = np.unique(found.hashes, return_index=True, return_inverse=True)
        place = np.fromiter(map(self.known.get, kinds.tolist(), repeat(-1)), np.int64, len(kinds))
        new = np.flatnonzero(place < 0)
        starts, ends = found.starts[at[new]].tolist(), found.ends[at[new]].tolist()
        raw = data.tobytes()
        ids, sizes = self._encode([raw[a:b].decode() for a, b in zip(starts, ends)])
        store = np.concatenate([self.ids, ids]) if len(ids) else self.ids
        stops = np.concatenate([self.ends, self.ends[-1] + np.cumsum(sizes)])
        place[new] = len(self.ends) - 1 + np.arange(len(new))
        room = max(0, CACHE - len(self.known))
        if len(new) and room:
            # Frequent words come early; what has no room is encoded again where it occurs.
            self.known.update(zip(kinds[new[:room]].tolist(), place[new[:room]].tolist()))
            self.ends = stops[: len(self.known) + 1]
            self.ids = store[: self.ends[-1]]
        begin, size = stops[:-1][place][inverse], np.diff(stops)[place][inverse]
        total = np.concatenate([[0], np.cumsum(size)])
        source = np.arange(total[-1]) + np.repeat(begin - total[:-1], size)
        return store[source], total[found.rows]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _tokenize(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = flat(batch["text"])
            for i, j in slices(offsets):
                ids, at = encoder(path)(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                kind = np.uint16 if not len(ids) or ids.max() < 1 << 16 else np.uint32
                rows = [np.append(ids[a:b], END).astype(kind).tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.record_batch(
                    {
                        "doc_id": batch["doc_id"].slice(i, j - i),
                        "source": batch["source"].slice(i, j - i),
                        "text_hash": batch["text_hash"].slice(i, j - i),
                        "n": pa.array(np.diff(at) + 1),
                        "ids": pa.array(rows, pa.binary()),
                    }
                )

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids of the pieces; neighbouring segments of one document in one sequence become one piece."""
        for batch in batches:
            rows: list[tuple] = []
            lists = zip(batch["doc_id"].to_pylist(), batch["source"].to_pylist(), batch["n"].to_pylist(), batch["ids"], batch["pieces"].to_pylist())
            for doc_id, source, n, blob, pieces in lists:
                raw = blob.as_buffer()
                ids = np.frombuffer(raw, np.uint16 if raw.size == 2 * n else np.uint32).astype("<u4")
                joined: list[list[int]] = []
                for p in sorted(pieces, key=lambda p: p["start"]):
                    last = joined[-1] if joined else None
                    if last and last[2] == p["sequence_id"] and last[3] + last[1] == p["offset"]:
                        last[1] += p["length"]
                    else:
                        joined.append([p["start"], p["length"], p["sequence_id"], p["offset"]])
                for start, length, sequence, offset in joined:
                    rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length]), n, sequence, offset, source))
            columns = list(zip(*rows)) if rows else [()] * 8
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
            kinds = [pa.int64()] * 7 + [pa.string()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    quantum: int = 512,
    mixture: Mapping[str, float] | None = None,
    bucket_rows: int = 1_000,
) -> DataFrame:
    """Pack all documents into sequences of ``window`` tokens that follow the target proportions.

    Every source is a queue of its documents in a hashed order, cut into segments of at most
    ``quantum`` tokens. In each round a queue earns ``window`` times its share and sends the segments
    that its balance covers; the rest of the balance, its deficit, stays for later rounds. A segment
    ending at token ``e`` of its queue therefore leaves in round ``ceil(e / (window * share))``, which
    needs no state: prefix sums give every segment its round and its place in the stream, and deficits
    carry over windows and partitions alike. The stream is cut at every ``window`` tokens, so only
    the last sequence has padding. ``mixture`` maps sources to weights (1 for any other; default: the
    sources' shares of all tokens, with which all queues end together); a queue that ends early leaves
    its share to the others.

    Returns one row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    source``. A null text is empty and has the end id alone; a null source is a queue of its own kind
    (the empty name); rows with equal or null ``doc_id`` are packed one by one.
    """
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source")]
    coded = docs.select(*columns, F.xxhash64("text").alias("text_hash"), "text").mapInArrow(_tokenize(tokenizer_path), TOKENS)
    coded = stored(coded.withColumn("key", F.monotonically_increasing_id()), "tokens")

    row = coded.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).first()
    total = row["n"] or 1
    buckets = max(1, math.ceil(row["rows"] / bucket_rows))
    spot = F.xxhash64("doc_id", "text_hash")  # the same place whatever the partitioning
    queue = coded.select("key", "source", "n", spot.alias("spot"), F.pmod(spot, F.lit(buckets)).alias("bucket"))
    queue = running_sum(queue, ["source"], "bucket", ["spot", "key"], "n", "at")

    if mixture is None:
        share = F.col("at_total") / F.lit(total)
    else:
        whole = float(sum(mixture.values())) or 1.0
        pairs = [x for s, w in mixture.items() for x in (F.lit(s), F.lit(w / whole))]
        given = F.create_map(*pairs)[F.col("source")] if pairs else F.lit(None).cast("double")
        share = F.coalesce(given, F.lit(1.0 / whole))
    starts = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(quantum).cast("long"))
    segments = queue.select("key", "source", "n", "at", share.alias("share"), F.explode(starts).alias("start"))
    segments = segments.withColumn("size", F.least(F.lit(quantum), F.col("n") - F.col("start")))
    ends = F.col("at") + F.col("start") + F.col("size")
    segments = segments.select("key", "source", "start", "size", ends.alias("end"), F.ceil(ends / (window * F.col("share"))).alias("round"))

    per_round = max(1.0, window / quantum)
    rounds = max(1, int(bucket_rows / (2 * per_round)))
    segments = segments.withColumn("bucket", F.floor(F.col("round") / rounds))
    placed = running_sum(segments, [], "bucket", ["round", "source", "end"], "size", "place")

    def piece(skip, size):
        where = F.col("place") + skip
        return F.struct(
            (F.col("start") + skip).alias("start"),
            size.cast("long").alias("length"),
            F.floor(where / window).cast("long").alias("sequence_id"),
            F.pmod(where, F.lit(window)).cast("long").alias("offset"),
        )

    zero = F.lit(0).cast("long")
    room = F.lit(window) - F.pmod("place", F.lit(window))
    cut = F.when(F.col("size") <= room, F.array(piece(zero, F.col("size")))).otherwise(
        F.array(piece(zero, room), piece(room, F.col("size") - room))
    )
    pieces = placed.select("key", F.explode(cut).alias("piece")).groupBy("key").agg(F.collect_list("piece").alias("pieces"))
    joined = coded.join(pieces, "key").select("doc_id", "source", "n", "ids", "pieces")
    return joined.mapInArrow(_cut(window), PIECES)
