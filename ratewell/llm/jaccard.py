"""Exact Jaccard self-join of shingle sets with set-relation skipping."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.llm.components import components
from ratewell.llm.kernels import distinct_by_row, flat, shingles, slices, span_hashes, words
from ratewell.llm.storage import stored, text_bytes

BUCKET_ROWS = 1 << 20
SKIP_ROWS = 64  # entries of an index list that are skipped together
MEETINGS = 4  # the walk asks for one of so many meetings that the prefixes allow to ask for
HEAVY = 1 << 20
HEAVY_LOCAL, HEAVY_COUNT, HEAVY_FLUSH = 2, 8, 1 << 22

MEMBERS = "doc_id bigint, text_hash bigint, n bigint, sid bigint"
COUNTS = "token bigint, n bigint"
ENTRIES = "bucket int, token binary, sid binary, n binary, pos binary, rare binary"
LISTS = "bucket int, token binary, sid binary, n binary, pos binary, rare binary, pairs binary"
PAIRS = "a bigint, b bigint, na bigint, nb bigint, shared bigint"
BASES = "a bigint, b bigint, lists bigint, need bigint"
COLUMNS = {"token": np.uint64, "sid": np.int64, "n": np.uint32, "pos": np.uint32, "rare": np.uint32}


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap of a linked pair whose sizes add up to ``n``."""
    return -(-percent * n // (100 + percent))


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """A set shares one of its first tokens, so many in the common order, with every set it links to."""
    return n - -(-percent * n // 100) + 1


def meetings(na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """In how many lists the walk asks two sets to meet: part of what their prefixes allow to ask.

    Of the tokens that a linked pair shares, the ``m``-th has ``least - m`` more behind it. So the pair meets
    ``m`` times among the first ``na - least + m`` tokens of the one and ``nb - least + m`` of the other,
    for every ``m`` whose tokens are all indexed. With a small ``m`` only rarer tokens count, which
    leaves out sets that share a passage; with a large one few pairs meet often enough by chance.
    """
    indexed = least_overlap(na + nb, percent) - np.maximum(-(-percent * na // 100), -(-percent * nb // 100)) + 1
    return np.maximum(1, indexed // MEETINGS)


def early(na: np.ndarray, nb: np.ndarray, p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    """Are the positions ``p`` and ``q`` of a meeting among the first tokens that :func:`meetings` is about?"""
    before = meetings(na, nb, percent) - least_overlap(na + nb, percent)
    return (p < na + before) & (q < nb + before)


def _sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every row in ascending order, offsets of the rows, and the sets' ids."""
    hashes, row = shingles(words(data, offsets, lower=True), size)
    values, at = distinct_by_row(hashes, row, len(offsets) - 1)
    return values, at, span_hashes(values, at[:-1], at[1:]).view(np.int64)


def _by_slice(batch: pa.RecordBatch, size: int):
    data, offsets = flat(batch["text"])
    for i, j in slices(offsets):
        yield i, j, *_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)


def _members(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, _, at, sid in _by_slice(batch, size):
                own = [batch[c].slice(i, j - i) for c in ("doc_id", "text_hash")]
                yield pa.record_batch([*own, pa.array(np.diff(at)), pa.array(sid)], ["doc_id", "text_hash", "n", "sid"])

    return run


def _frequent(size: int):
    """Tokens that many different sets near each other hold."""

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(parts), return_counts=True)
        often = counts >= HEAVY_LOCAL
        return pa.record_batch({"token": pa.array(tokens[often].view(np.int64)), "n": pa.array(counts[often])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, known, held = [], set(), 0
        for batch in batches:
            for _, _, values, at, sid in _by_slice(batch, size):
                for k, s in enumerate(sid.tolist()):
                    if s not in known:
                        known.add(s)
                        parts.append(values[at[k] : at[k + 1]])
                        held += len(parts[-1])
                if held >= HEAVY_FLUSH:
                    yield counted(parts)
                    parts, known, held = [], set(), 0
        if parts:
            yield counted(parts)

    return run


def _index(size: int, percent: int, bits: int, heavy: np.ndarray):
    """Index entries of every set: the tokens of its prefix, their positions, dealt by token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, values, at, sid in _by_slice(batch, size):
                n = np.diff(at)
                _, first = np.unique(sid, return_index=True)
                use = np.zeros(len(n), bool)
                use[first] = True
                use &= n > 0
                row = np.repeat(np.arange(len(n)), n)
                late = np.zeros(len(values), bool)
                if len(heavy):
                    spot = np.minimum(np.searchsorted(heavy, values), len(heavy) - 1)
                    late = heavy[spot] == values
                order = np.argsort(row * 2 + late, kind="stable")
                place = np.arange(len(values)) - at[:-1][row]
                keep = use[row] & (place < prefix_size(n, percent)[row])
                token, owner, place = values[order][keep], row[keep], place[keep]
                bucket = (token & np.uint64((1 << bits) - 1)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[by], np.arange((1 << bits) + 1))
                rare = n - np.bincount(row, late, len(n)).astype(np.int64)
                columns = {"token": token[by], "sid": sid[owner][by], "n": n[owner][by], "pos": place[by], "rare": rare[owner][by]}
                full = np.flatnonzero(np.diff(cuts))
                yield pa.record_batch(
                    {
                        "bucket": pa.array(full.astype(np.int32)),
                        **{
                            c: pa.array([v[cuts[k] : cuts[k + 1]].astype(COLUMNS[c]).tobytes() for k in full], pa.binary())
                            for c, v in columns.items()
                        },
                    }
                )

    return run


def _entries(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in table[c]]) for c, kind in COLUMNS.items()}


def _pairs(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
    """Distinct pairs in columns a, b, na, nb and the number of tokens they share."""
    if not len(a):
        return np.zeros((0, 5), np.int64)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    many = np.diff(np.append(new, len(a))) if counts is None else np.add.reduceat(counts[order], new)
    return np.stack([a[new], b[new], na[order][new].astype(np.int64), nb[order][new].astype(np.int64), many], 1)


def _lists(table: pa.Table) -> pa.Table:
    """Index lists of one bucket with two or more sets, and each list's pairs with its heads.

    A list has one head for every class of like sizes: the set with the smallest share of rare tokens.
    In a group of near copies that is the text that the others were made from, and each copy is near
    to it although two copies may be too far from each other.
    """
    e = _entries(table)
    order = np.lexsort((e["sid"], e["token"]))
    e = {c: v[order] for c, v in e.items()}
    new = np.append(True, (e["token"][1:] != e["token"][:-1]) | (e["sid"][1:] != e["sid"][:-1]))
    e = {c: v[new] for c, v in e.items()}
    _, at, counts = np.unique(e["token"], return_inverse=True, return_counts=True)
    many = counts[at] > 1
    e = {c: v[many] for c, v in e.items()}
    kind = np.floor(np.log(np.maximum(e["n"], 1)) / math.log(1.25)).astype(np.int64)
    order = np.lexsort((e["sid"], e["rare"] / np.maximum(e["n"], 1), kind, e["token"]))
    token, kind, sid, n = e["token"][order], kind[order], e["sid"][order], e["n"][order]
    number = np.cumsum(np.append(False, token[1:] != token[:-1])[: len(token)]) if len(token) else np.zeros(0, np.int64)
    place = number * 256 + kind
    heads, first = np.unique(place, return_index=True)
    left, right = [], []
    for step in (-1, 0, 1):
        at = np.minimum(np.searchsorted(heads, place + step), max(0, len(heads) - 1))
        member = np.flatnonzero(heads[at] == place + step) if len(heads) else at
        head = first[at[member]]
        other = sid[head] != sid[member]
        left.append(head[other])
        right.append(member[other])
    i, j = np.concatenate(left), np.concatenate(right)
    flip = sid[i] > sid[j]
    i, j = np.where(flip, j, i), np.where(flip, i, j)
    pairs = _pairs(sid[i], sid[j], n[i], n[j])
    return pa.table(
        {
            "bucket": table["bucket"][:1],
            **{c: pa.array([v.tobytes()], pa.binary()) for c, v in e.items()},
            "pairs": pa.array([pairs.tobytes()], pa.binary()),
        }
    )


def _unpack_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch["pairs"]:
            yield _pair_rows(np.frombuffer(blob.as_buffer(), np.int64).reshape(-1, 5))


def _pair_rows(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in pairs.T], ["a", "b", "na", "nb", "shared"])


def _unpack_sids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for bucket, blob in zip(batch["bucket"], batch["sid"]):
            sids = np.unique(np.frombuffer(blob.as_buffer(), np.int64))
            yield pa.record_batch({"bucket": pa.array(np.full(len(sids), bucket.as_py(), np.int32)), "sid": pa.array(sids)})


def _across(percent: int):
    """Pairs of bases whose sets meet in one bucket's lists and are in different components so far.

    Sets with one base, size and position in a list are one entry here, whatever their number. A pair
    of bases has one row: in how many lists it meets early enough, which is no less than for any two of
    its sets, and the least number of such meetings that two of them would need (:func:`meetings`).
    """

    def run(table: pa.Table, labels: pa.Table) -> pa.Table:
        e = _entries(table)
        label, base = e["sid"].copy(), e["sid"].copy()
        if labels.num_rows:
            sids = labels["sid"].to_numpy()
            order = np.argsort(sids)
            at = np.minimum(np.searchsorted(sids[order], e["sid"]), len(sids) - 1)
            hit = sids[order][at] == e["sid"]
            label[hit] = labels["root"].to_numpy()[order][at[hit]]
            base[hit] = labels["base"].to_numpy()[order][at[hit]]
        n, pos = e["n"].astype(np.int64), e["pos"].astype(np.int64)
        order = np.lexsort((base, pos, n, label, e["token"]))
        columns = [c[order] for c in (e["token"], label, n, pos, base)]
        new = np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0)) if len(order) else np.zeros(0, bool)
        token, label, n, pos, base = (c[new] for c in columns)
        bounds = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
        found, held = [np.zeros((0, 4), np.int64)], 0
        for a, b in zip(bounds, [*bounds[1:], len(token)]):
            if label[a] == label[b - 1]:
                continue  # one component: the list has nothing to add
            met = []
            for i, j in _meeting(label[a:b], n[a:b], pos[a:b], percent):
                i, j = i + a, j + a
                soon = early(n[i], n[j], pos[i], pos[j], percent)
                if soon.any():
                    met.append(_of_bases(base[i], base[j], n[i], n[j], percent)[soon])
            if met:
                once = _added(np.concatenate(met))
                once[:, 2] = 1  # one list
                found.append(once)
                held += len(once)
            if held > 1 << 20:
                found, held = [_added(np.concatenate(found))], 0
        rows = _added(np.concatenate(found))
        return pa.table([pa.array(np.ascontiguousarray(c)) for c in rows.T], ["a", "b", "lists", "need"])

    return run


def _of_bases(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    """Rows (base, base, 1, lists in which the two sets must meet)."""
    return np.stack([np.minimum(a, b), np.maximum(a, b), np.ones_like(na), meetings(na, nb, percent)], 1)


def _added(rows: np.ndarray) -> np.ndarray:
    """One row per pair of bases: lists added up, least need."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    first = np.flatnonzero(np.append(True, np.any(rows[1:, :2] != rows[:-1, :2], axis=1)))
    return np.column_stack([rows[first, :2], np.add.reduceat(rows[:, 2], first), np.minimum.reduceat(rows[:, 3], first)])


def _meeting(label: np.ndarray, n: np.ndarray, pos: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a list with different labels whose sizes and positions allow a link.

    Two sets that meet at positions ``p`` and ``q`` share at most ``1 + min(p, q)`` tokens up to here and
    ``min(n - p, m - q) - 1`` after it. The list is walked in blocks; a block is skipped as a whole
    where even its best entries stay below the least overlap, or where it repeats the other's label.
    """
    cuts = np.arange(0, len(n), SKIP_ROWS)
    behind = n - pos - 1
    low, high = np.minimum.reduceat(n, cuts), np.maximum.reduceat(n, cuts)
    most_pos, most_behind = np.maximum.reduceat(pos, cuts), np.maximum.reduceat(behind, cuts)
    ends = np.append(cuts[1:], len(n))
    first, last = label[cuts], label[ends - 1]
    for k in range(len(cuts)):
        reach = 1 + np.minimum(most_pos[k], most_pos[k:]) + np.minimum(most_behind[k], most_behind[k:])
        open_ = reach >= least_overlap(low[k] + low[k:], percent)
        open_ &= (100 * high[k:] >= percent * low[k]) & (100 * high[k] >= percent * low[k:])
        open_ &= ~((first[k] == last[k]) & (first[k:] == first[k]) & (last[k:] == first[k]))
        a = np.arange(cuts[k], ends[k])
        for other in np.flatnonzero(open_) + k:
            b = np.arange(cuts[other], ends[other])
            ok = label[a][:, None] != label[b][None, :]
            if other == k:
                ok &= a[:, None] < b[None, :]
            share = 1 + np.minimum(pos[a][:, None], pos[b][None, :]) + np.minimum(behind[a][:, None], behind[b][None, :])
            ok &= share >= least_overlap(n[a][:, None] + n[b][None, :], percent)
            i, j = np.nonzero(ok)
            if len(i):
                yield a[i], b[j]


def _two_sides(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shingle sets of both texts of every row."""
    sides = []
    for c in ("text_a", "text_b"):
        data, offsets = flat(batch[c])
        sides.append([s for i, j in slices(offsets) for s in _cut(_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size))])
    return zip(*sides)


def _held(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which tokens of ``x`` does ``y`` hold?"""
    at = np.minimum(np.searchsorted(y, x), max(0, len(y) - 1))
    return y[at] == x if len(y) else np.zeros(len(x), bool)


def _overlap(size: int):
    """Exact overlap of the shingle sets of two texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = [int(_held(*((x, y) if len(x) <= len(y) else (y, x))).sum()) for x, y in _two_sides(batch, size)]
            kept = [c for c in batch.schema.names if c not in ("text_a", "text_b")]
            yield pa.record_batch([*(batch[c] for c in kept), pa.array(shared, pa.int64())], [*kept, "overlap"])

    return run


def _difference(size: int):
    """Tokens of the first text's set that the second one's lacks, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = [x[~_held(x, y)].view(np.int64) for x, y in _two_sides(batch, size)]
            row = pa.array(np.repeat(np.arange(len(more)), [len(x) for x in more]))
            kept = [c for c in batch.schema.names if c not in ("text_a", "text_b")]
            yield pa.record_batch([*(batch[c].take(row) for c in kept), pa.array(np.concatenate(more or [np.zeros(0, np.int64)]))], [*kept, "token"])

    return run


def _cut(sets: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[np.ndarray]:
    values, at, _ = sets
    return [values[a:b] for a, b in zip(at[:-1], at[1:])]


class _Verifier:
    """Reads the texts of the sets that a stage asks for and compares them exactly."""

    def __init__(self, docs: DataFrame, sets: DataFrame, size: int) -> None:
        self.docs, self.sets, self.size = docs, sets, size

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b, ...) with ``overlap``."""
        return self._compared(pairs, _overlap(self.size), "overlap")

    def differences(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b, ...) with a row for each ``token`` of a that b lacks."""
        return self._compared(pairs, _difference(self.size), "token")

    def _compared(self, pairs: DataFrame, how, result: str) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
        keys = wanted.join(self.sets.select("sid", "doc_id", "text_hash"), "sid").withColumnRenamed("doc_id", "_id")
        same = self.docs["doc_id"].eqNullSafe(keys["_id"]) & (self.docs["text_hash"] == keys["text_hash"])
        texts = self.docs.join(keys.hint("shuffle_hash"), same).select("sid", "text").dropDuplicates(["sid"])
        texts = stored(texts, "texts")
        left = texts.select(F.col("sid").alias("b"), F.col("text").alias("text_b"))
        right = texts.select(F.col("sid").alias("a"), F.col("text").alias("text_a"))
        both = pairs.join(left, "b").join(right, "a").select(*pairs.columns, "text_a", "text_b")
        schema = ", ".join(f"{c} bigint" for c in (*pairs.columns, result))
        return stored(both.mapInArrow(how, schema), result)


def _linked(percent: int, overlap: Column | str = "overlap") -> Column:
    overlap = F.col(overlap) if isinstance(overlap, str) else overlap
    return overlap * 100 >= percent * (F.col("na") + F.col("nb") - overlap)


def _possible(percent: int) -> Column:
    """Can a pair that shares so many prefix tokens reach the least overlap? Exact upper bound."""
    rest = F.greatest(F.ceil(F.col("na") * percent / 100), F.ceil(F.col("nb") * percent / 100)) - 1
    return F.col("shared") + rest >= F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent))


def _edges(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``pairs`` with the components of both sides so far (``ra``, ``rb``), those in one left out."""
    for side in ("a", "b"):
        own = roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"r{side}", F.coalesce(f"r{side}", side))
    return pairs.where(F.col("ra") != F.col("rb"))


def _members_of(two: DataFrame, sets: DataFrame, bases: DataFrame, percent: int, verify: _Verifier) -> DataFrame:
    """Pairs of sets that may be linked, derived from the counted overlap of their bases.

    Let ``x`` have the base ``p`` and ``y`` the base ``q``. Their overlap is at most that of ``p`` and ``q``, plus
    the tokens new in ``x`` (not in ``p``) that ``q`` holds, plus those new in ``y`` that ``p`` holds, plus those
    new in both. The new tokens are few: a join by token finds the members that have any in the other
    base, and every other member has none. So of a large group of copies only those meet a text beside
    it that share a new token with it or are small enough to be linked without.
    """
    own = sets.select("sid", "n").join(bases.select("sid", "base", "n_base", F.col("overlap").alias("inside")), "sid", "left")
    own = own.withColumns({"base": F.coalesce("base", "sid"), "n_base": F.coalesce("n_base", "n"), "inside": F.coalesce("inside", "n")})
    own = own.withColumns({"extra": F.col("n") - F.col("inside"), "lost": F.col("n_base") - F.col("inside")})
    gain = (100 + percent) * F.col("extra") - percent * F.col("n")
    best = own.groupBy("base").agg(F.max(gain).alias("gain"), F.max("extra").alias("extra"), F.min("n").alias("low"))
    met = two.select("a", "b", F.col("overlap").alias("middle"))
    for side in ("a", "b"):
        met = met.join(best.select(F.col("base").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("gain", "extra", "low"))), side)
    met = stored(met.where(F.col("middle") * (100 + percent) + F.col("gain_a") + F.col("gain_b") >= 0), "near")

    ways = [met.select(F.col(x).alias("base"), F.col(y).alias("other"), F.col(f"extra_{x}").alias("extra")) for x, y in (("a", "b"), ("b", "a"))]
    ways = ways[0].unionByName(ways[1]).where(F.col("extra") > 0)
    asked = own.where(F.col("extra") > 0).join(ways.select("base").distinct(), "base")
    asked = asked.select(F.col("sid").alias("a"), F.col("base").alias("b"), F.lit(1).cast("long").alias("member"))
    apart = verify.differences(asked.unionByName(ways.select(F.col("other").alias("a"), F.col("base").alias("b"), F.lit(0).cast("long").alias("member"))))
    new = apart.where("member = 1").select(F.col("a").alias("sid"), F.col("b").alias("base"), "token")
    theirs = apart.where("member = 0").select(F.col("a").alias("other"), F.col("b").alias("base"), "token")
    hits = stored(new.join(theirs, ["base", "token"]).groupBy("sid", "other").agg(F.count(F.lit(1)).alias("hits")), "hits")
    common = new.select("token", "base").distinct().groupBy("token").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > 1).select("token")
    common = new.join(common, "token").groupBy("sid").agg(F.count(F.lit(1)).alias("common"))
    own = stored(own.drop("n_base", "inside", "extra").join(common, "sid", "left").withColumn("common", F.coalesce("common", F.lit(0))), "own")
    most_common = own.groupBy("base").agg(F.max("common").alias("common"))
    for side in ("a", "b"):
        met = met.join(most_common.select(F.col("base").alias(side), F.col("common").alias(f"top_{side}")), side)

    def reach(hit: Column | int, common: Column, n_a: str, n_b: str) -> Column:
        return (F.col("middle") + hit + common) * (100 + percent) >= percent * (F.col(n_a) + F.col(n_b))

    found = None
    for known in ((), ("a",), ("b",), ("a", "b")):  # the sides whose member holds new tokens of the other base
        pairs, hit = met, F.lit(0)
        # members with hits come first: they are few
        for side in sorted("ab", key=lambda c: c not in known):
            other = "b" if side == "a" else "a"
            mine = own.select(*(F.col(c).alias(f"{c}_{side}") for c in ("base", "sid", "n", "lost", "common")))
            on = F.col(side) == F.col(f"base_{side}")
            if side in known:
                of = hits.select(F.col("sid").alias(f"sid_{side}"), F.col("other").alias(f"of_{side}"), F.col("hits").alias(f"hits_{side}"))
                mine = mine.join(of, f"sid_{side}")
                on &= F.col(other) == F.col(f"of_{side}")
                hit = hit + F.col(f"hits_{side}")
            after = f"n_{other}" in pairs.columns
            if after or other not in known:  # the bound is whole but for the other member's size
                on &= reach(hit, F.least(f"common_{side}", F.col(f"common_{other}" if after else f"top_{other}")), f"n_{side}", f"n_{other}" if after else f"low_{other}")
            pairs = pairs.join(mine, on)
        pairs = pairs.withColumn("most", F.col("middle") + hit + F.least("common_a", "common_b"))
        pairs = pairs.select("sid_a", "sid_b", "n_a", "n_b", "most", (F.col("middle") - F.col("lost_a") - F.col("lost_b")).alias("least"))
        found = pairs if found is None else found.unionByName(pairs)

    flip = F.col("sid_a") > F.col("sid_b")

    def ordered(c: str, first: str, second: str) -> Column:
        return F.when(flip, F.col(f"{c}_{second}")).otherwise(F.col(f"{c}_{first}"))

    pairs = found.select(
        ordered("sid", "a", "b").alias("a"), ordered("sid", "b", "a").alias("b"), ordered("n", "a", "b").alias("na"), ordered("n", "b", "a").alias("nb"),
        "most", "least",
    )
    pairs = pairs.where(_linked(percent, F.least("most", "na", "nb")))
    sure = _linked(percent, "least") & (F.col("least") >= 0)
    return pairs.groupBy("a", "b", "na", "nb").agg(F.max(sure).alias("sure"))


def link_sets(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Near-duplicate classes of all documents by exact Jaccard similarity of their shingle sets.

    1. Equal sets become one, so exact copies cost one index entry.
    2. Every set indexes its prefix: rare tokens first, so that a linked pair shares one of them.
       The order only decides the cost; tokens that many sets hold are put last.
    3. Each index list pairs its sets with its first set. The verified pairs give components and,
       for each set, a base: a very similar set and the overlap with it.
    4. The lists are read again for pairs of bases whose sets meet across components, skipping blocks
       of entries whose sizes, positions or labels allow none. Lists inside one component, such as
       those of a large group of near copies, add nothing, and copies of one base count once.
    5. Overlaps of the bases are counted once. With the tokens in which sets differ from their bases
       they bound the overlap of every two sets that belong to them; only sets whose bound allows a
       link are paired at all. The undecided are verified, first one for each two components, then the rest.

    No pair is given up: each is excluded by a bound, known to be in one component, or counted.

    Returns ``doc_id, text_hash, n_shingles, component_id, root``, one row per document; a component is
    named by the smallest ``doc_id`` reachable by links and ``root`` tells components of one name apart. A text without words has no set and stands alone. Rows
    of one ``doc_id`` are linked by their texts only; a null id is null, but its text links others.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    members = stored(docs.mapInArrow(_members(size), MEMBERS), "members")
    some = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("one")
    sets = members.where(F.col("n") > 0).groupBy("sid").agg(F.first("n").alias("n"), some)
    sets = stored(sets.select("sid", "n", "one.doc_id", "one.text_hash"), "sets")
    verify = _Verifier(docs, sets, size)

    heavy = docs.select("text").mapInArrow(_frequent(size), COUNTS).groupBy("token").agg(F.sum("n").alias("n"))
    heavy = heavy.where(F.col("n") >= HEAVY_COUNT).orderBy(F.desc("n"), "token").limit(HEAVY).toPandas()["token"]
    late = np.sort(heavy.to_numpy(np.int64).view(np.uint64))
    _, total = text_bytes(docs)
    bits = max(4, math.ceil(math.log2(max(1, total / 32 / BUCKET_ROWS))))
    entries = docs.select("text").mapInArrow(_index(size, percent, bits, late), ENTRIES)
    lists = stored(entries.groupBy("bucket").applyInArrow(_lists, LISTS), "lists")

    near = lists.select("pairs").mapInArrow(_unpack_pairs, PAIRS).groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))
    # Tokens that two sets meet over another head are not counted here; such pairs are left to the walk.
    known = verify(near.where(_possible(percent)).drop("shared")).where(_linked(percent))
    roots = components(_edges(known))
    best = F.max_by(F.struct(F.col("a").alias("base"), F.col("na").alias("n_base"), "overlap"), F.struct("degree", "overlap", "a"))
    both = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("nb").alias("na"), F.col("na").alias("nb"), "overlap"))
    degree = known.select(F.explode(F.array("a", "b")).alias("a")).groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
    bases = stored(both.join(degree, "a").groupBy(F.col("b").alias("sid")).agg(best.alias("x")).select("sid", "x.*"), "bases")

    told = lists.select("bucket", "sid").mapInArrow(_unpack_sids, "bucket int, sid bigint")
    own = bases.select("sid", "base").join(roots.select(F.col("node").alias("sid"), "root"), "sid", "left")
    told = told.join(own.select("sid", F.coalesce("root", "sid").alias("root"), "base"), "sid").select("bucket", "sid", "root", "base")
    walked = lists.drop("pairs").groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(_across(percent), BASES)
    met = walked.groupBy("a", "b").agg(F.sum("lists").alias("lists"), F.min("need").alias("need"))
    met = stored(met.where(F.col("lists") >= F.col("need")).select("a", "b"), "open")
    links = _edges(known)
    if not met.isEmpty():
        size_of = sets.select("sid", "n")
        two = verify(met)
        for side in ("a", "b"):
            two = two.join(size_of.select(F.col("sid").alias(side), F.col("n").alias(f"n{side}")), side)
        two = stored(two, "two")
        links = links.unionByName(_edges(two.where(_linked(percent))))
        roots = components(links)
        bound = stored(_members_of(_apart(two, roots), sets, bases, percent, verify), "bounds")
        links = links.unionByName(_edges(bound.where("sure")))
        roots = components(links)
        unsure = _apart(bound.where(~F.col("sure")).drop("sure"), roots)
        one = unsure.groupBy("ra", "rb").agg(F.min(F.struct("a", "b", "na", "nb")).alias("x")).select("x.*")
        for step in (one, None):
            pairs = step if step is not None else _apart(bound.where(~F.col("sure")).drop("sure"), roots)
            pairs = stored(pairs.select("a", "b", "na", "nb"), "unsure")
            if pairs.isEmpty():
                break
            links = links.unionByName(_edges(verify(pairs).where(_linked(percent))))
            roots = components(links)

    named = sets.join(roots.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_set = named.join(names, "root").select("sid", "root", "component_id")
    full = members.where(F.col("n") > 0).join(of_set, "sid")
    empty = members.where(F.col("n") == 0).withColumns({"component_id": F.col("doc_id"), "root": F.lit(None).cast("long")})
    columns = ["doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", "root"]
    return full.select(*columns).unionByName(empty.select(*columns))


def keep_one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every class of :func:`link_sets`: smallest ``doc_id``, then smallest text hash.

    Rows without words are kept; every column is kept and none can clash.
    """
    links = link_sets(docs.select("doc_id", "text"), size, percent)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    one = links.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(order).alias("x")).select("x.doc_id", "x.text_hash")
    alone = links.where(F.col("root").isNull()).select("doc_id", "text_hash").distinct()
    kept = one.withColumn("single", F.lit(True)).unionByName(alone.withColumn("single", F.lit(False)))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64("text").alias("_hash"))
    same = rows["_id"].eqNullSafe(kept["doc_id"]) & (rows["_hash"] == kept["text_hash"])
    met = rows.join(kept.hint("shuffle_hash"), same).select("doc", "_id", "_hash", "single")
    first = met.where("single").groupBy("_id", "_hash").agg(F.first("doc").alias("doc")).select("doc")
    return first.unionByName(met.where(~F.col("single")).select("doc")).select("doc.*")
