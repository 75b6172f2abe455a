"""Forward passes: score (user, item) pairs from parameter tables.

Parameter tables have one row per id, so looking a row up is a join; Spark broadcasts a
table only when its measured size allows it and otherwise shuffles, with skewed keys split
at run time.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions.scalars import dot, formula_value
from ratewell.operators import streams
from ratewell.session import cut_lineage

PART = 32  # hidden units per stored piece of an autoencoder row
BLOCK_USERS = 8192  # users that meet one chunk of items in one task, on average, with all hidden units there
CHUNK_ITEMS = 8192
LEAST_USERS = 1024  # no smaller blocks for the sake of more tasks
USERS_AT_ONCE = 256  # users multiplied at once, taken as USER_CELLS cells each
USER_CELLS = 32
CELL_BYTES = 75  # a rating and its prediction on their way through one slice of the hidden units
OWN_BLOCKS = 12  # blocks of users that a task holds while the weights pass
BLOCK_CELLS = 1 << 20  # most asked cells in such a block, on average
SLICE_VALUES = 1 << 22  # weights of all items that pass together, if they are of several hidden units
UNIT_BYTES = 1 << 28  # most bytes of all items' weights of one hidden unit that a task takes whole
ROWS_AT_ONCE = 1 << 18  # rows that a task returns together


@dataclass(frozen=True)
class Dense:
    """Weights of ``2k -> h -> 1``; its size depends on the layer widths only, never on the data."""

    w1: Sequence[Sequence[float]]
    b1: Sequence[float]
    w2: Sequence[float]
    b2: float

    @staticmethod
    def from_formula(k: int, h: int, table: int = 4) -> Dense:
        def at(row: int, position: int, shift: int) -> float:
            return ((row * 31 + position * 17 + (table + shift) * 13) % 101 - 50) / 100.0

        return Dense(
            [[at(j, f, 0) for f in range(2 * k)] for j in range(h)],
            [at(j, 0, 1) for j in range(h)],
            [at(j, 0, 2) for j in range(h)],
            at(0, 0, 3),
        )


def formula_factors(ids: DataFrame, id_col: str, table: int, k: int) -> DataFrame:
    """``(id, factors, bias)`` with reproducible values; the bias uses position ``k``."""
    return ids.select(
        id_col,
        F.array(*[formula_value(id_col, f, table) for f in range(k)]).alias("factors"),
        formula_value(id_col, k, table).alias("bias"),
    )


def _with_rows(pairs: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str, k: int) -> DataFrame:
    """Every asked pair with both rows; an id that was not part of the fit has zeros."""
    zeros = F.array_repeat(F.lit(0.0), k)
    for rows, key, side in ((users, user, "_u"), (items, item, "_i")):
        rest = [c for c in rows.columns if c != key]
        pairs = pairs.join(rows.select(key, *[F.col(c).alias(f"{side}_{c}") for c in rest]), key, "left")
        pairs = pairs.withColumns({f"{side}_{c}": F.coalesce(f"{side}_{c}", zeros if c == "factors" else F.lit(0.0)) for c in rest})
    return pairs


def _bilinear(k: int) -> Column:
    return F.col("_u_bias") + F.col("_i_bias") + dot("_u_factors", "_i_factors", k)


def _perceptron(net: Dense) -> Column:
    """The relu layer over whole Arrow batches: several times faster than 2k*h unrolled terms."""
    w1, b1, w2, b2 = (np.asarray(part, dtype=float) for part in (net.w1, net.b1, net.w2, net.b2))
    k = w1.shape[1] // 2

    @F.arrow_udf("double")
    def layer(users: pa.Array, items: pa.Array) -> pa.Array:
        left, right = (rows.flatten().to_numpy().reshape(-1, k) for rows in (users, items))
        return pa.array(np.maximum(np.hstack([left, right]) @ w1.T + b1, 0.0) @ w2 + b2)

    return layer("_u_factors", "_i_factors")


def _finish(scored: DataFrame, pairs: DataFrame, value: Column) -> DataFrame:
    return scored.select(*pairs.columns, value.alias("prediction"))


def score_mf(
    pairs: DataFrame, users: DataFrame, items: DataFrame, k: int, user: str = "user_idx", item: str = "item_idx"
) -> DataFrame:
    """Both biases plus the factor product."""
    return _finish(_with_rows(pairs, users, items, user, item, k), pairs, _bilinear(k))


def score_mlp(
    pairs: DataFrame, users: DataFrame, items: DataFrame, net: Dense,
    user: str = "user_idx", item: str = "item_idx",
) -> DataFrame:
    """One hidden relu layer over both factor rows."""
    users, items, k = users.select(user, "factors"), items.select(item, "factors"), len(net.w1[0]) // 2
    return _finish(_with_rows(pairs, users, items, user, item, k), pairs, _perceptron(net))


def score_residual(
    pairs: DataFrame, users: DataFrame, items: DataFrame, net: Dense, k: int,
    user: str = "user_idx", item: str = "item_idx",
) -> DataFrame:
    """Sum of :func:`score_mf` and :func:`score_mlp` over shared factors."""
    value = _bilinear(k) + _perceptron(net)
    return _finish(_with_rows(pairs, users, items, user, item, k), pairs, value)


def formula_coder(ids: DataFrame, id_col: str, h: int, table: int = 8) -> DataFrame:
    """Reproducible autoencoder rows, see :func:`score_autorec`."""
    ident, part = F.col(id_col), F.col("part")
    last = F.lit((h - 1) // PART)
    units = F.sequence(part * PART, F.least(part * PART + PART, F.lit(h)) - 1)
    return ids.select(id_col, F.explode(F.sequence(F.lit(0), last)).alias("part")).select(
        id_col,
        "part",
        F.transform(units, lambda j: formula_value(ident, j, table)).alias("w_in"),
        F.transform(units, lambda j: formula_value(ident, j, table + 1)).alias("w_out"),
        formula_value(id_col, 0, table + 2).alias("b_out"),
    )


def formula_hidden_bias(h: int, table: int = 11) -> list[float]:
    return [((j * 31 + table * 13) % 101 - 50) / 100.0 for j in range(h)]


def _vectors(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _found(ids: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each id in the sorted ``near``, and whether it is there."""
    if not near.size:
        return np.zeros(ids.size, np.int64), np.zeros(ids.size, bool)
    place = np.minimum(np.searchsorted(near, ids), near.size - 1)
    return place, near[place] == ids


def _encode_block(key: tuple, ratings: pa.Table, items: pa.Table) -> pa.Table:
    """Sums of rating times input weights for one block of users, chunk of items and slice of hidden units."""
    if not ratings.num_rows or not items.num_rows:
        return pa.table({"id": pa.array([], pa.int64()), "vector": pa.array([], pa.list_(pa.float64()))})
    weights, ids = _vectors(items["vector"], len(items["vector"][0])), items["id"].to_numpy()
    order = np.argsort(ids)
    known, at_user = np.unique(ratings["user"].to_numpy(), return_inverse=True)
    place, hit = _found(ratings["item"].to_numpy(), ids[order])
    cells = np.flatnonzero(hit)
    cells = cells[np.argsort(at_user[cells], kind="stable")]
    at_user, at_item, x = at_user[cells], order[place[cells]], ratings["x"].to_numpy()[cells]
    # As in a dense product, a weight that is no number (that of a null id) reaches every user of the block.
    sums = np.tile(0.0 * weights.sum(axis=0), (known.size, 1))
    for start in range(0, cells.size, USERS_AT_ONCE * USER_CELLS):
        now = slice(start, start + USERS_AT_ONCE * USER_CELLS)
        first = np.flatnonzero(np.diff(at_user[now], prepend=-1))
        sums[at_user[now][first]] += np.add.reduceat(weights[at_item[now]] * x[now, None], first)
    return pa.table({"id": known, "vector": pa.ListArray.from_arrays(np.arange(known.size + 1, dtype=np.int32) * sums.shape[1], sums.ravel())})


def _decode_block(b_in: np.ndarray, width: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """What one slice of ``width`` hidden units gives to the asked cells of one block of users and chunk of items."""

    def run(key: tuple, asked: pa.Table, rows: pa.Table) -> pa.Table:
        users, items = asked["user"].to_numpy(), asked["item"].to_numpy()
        near_u, at_user = np.unique(users, return_inverse=True)
        near_i, at_item = np.unique(items, return_inverse=True)
        part = key[2].as_py()
        bias = b_in[part * width : (part + 1) * width]
        h = bias.size
        codes, weights = np.tile(bias, (near_u.size, 1)), np.zeros((near_i.size, h + 1))
        for kind, near, table in (("user", near_u, codes), ("item", near_i, weights)):
            mine = rows.filter(pc.equal(rows["kind"], kind))
            if mine.num_rows and near.size:
                place, hit = _found(mine["id"].to_numpy(), near)
                np.add.at(table, place[hit], _vectors(mine["vector"], table.shape[1])[hit])
        np.tanh(codes, out=codes)
        guess = np.empty(users.size)
        for start in range(0, users.size, USERS_AT_ONCE * USER_CELLS):
            now = slice(start, start + USERS_AT_ONCE * USER_CELLS)
            out = weights[at_item[now]]
            guess[now] = np.einsum("ij,ij->i", codes[at_user[now]], out[:, :h]) + out[:, h]
        return pa.table({"user": users, "item": items, "prediction": guess})

    return run


def _sliced(key: tuple, sums: pa.Table) -> pa.Table:
    return sums.append_column("slice", pa.array([key[2].as_py()] * sums.num_rows, pa.int32()))


def slices_of(cells: int, users: int, items: int, h: int) -> tuple[int, int]:
    """Number of slices of the hidden units, and units in each, that move the fewest bytes.

    A task holds the same number of values in any case, so with more slices it holds more users and
    items: weights and codes go to fewer tasks, while every cell goes to each slice.
    """

    def moved(parts: int) -> float:
        blocks, chunks = math.ceil(users / (BLOCK_USERS * parts)), math.ceil(items / (CHUNK_ITEMS * parts))
        return cells * parts * CELL_BYTES + 16.0 * h * (items * blocks + users * chunks)

    pieces = math.ceil(h / PART)
    width = PART * min((math.ceil(pieces / n) for n in range(1, pieces + 1)), key=lambda w: (moved(math.ceil(pieces / w)), -w))
    return math.ceil(h / width), width


def _pack_slice(table: pa.Table) -> pa.Table:
    """Weights of all items for one slice of hidden units, by ascending id."""
    known = pc.is_valid(table["id"]).to_numpy()
    ids, place = np.unique(table["id"].filter(known).to_numpy(), return_inverse=True)
    offset, lengths = table["offset"].to_numpy(), pc.list_value_length(table["w_in"]).to_numpy()
    width = int((offset + lengths).max())
    into, out, spread = np.zeros((ids.size, width)), np.zeros((ids.size, width)), np.zeros(width)
    for start in np.unique(offset):
        here = offset == start
        units = slice(start, start + int(lengths[here].max()))
        rows = table.filter(here)
        w_in, w_out = (_vectors(rows[c], units.stop - start) for c in ("w_in", "w_out"))
        spread[units] = 0.0 * w_in.sum(axis=0)
        into[place[here[known]], units], out[place[here[known]], units] = w_in[known[here]], w_out[known[here]]
    b_out = np.zeros(ids.size)
    b_out[place] = pc.fill_null(table["b_out"], 0.0).to_numpy()[known]
    head = np.array([table["slice"][0].as_py(), width])
    data = streams.to_bytes(head, ids.astype(np.int64), into.ravel(), out.ravel(), b_out, spread)
    return pa.table({"data": pa.array([data], pa.binary())})


def weight_slices(items: DataFrame, item: str, h: int, n_items: int) -> tuple[DataFrame, int]:
    """Weights by slices of the hidden units, each packed with those of all items, and units in a slice."""
    most = max(1, SLICE_VALUES // (2 * max(1, n_items)))
    width = min(math.ceil(h / PART), most // PART) * PART if most >= PART else 1 << (most.bit_length() - 1)
    ident, part = F.col(item).cast("long").alias("id"), F.col("part")
    if width >= PART:
        number, offset = F.floor(part * PART / F.lit(width)), F.pmod(part * PART, F.lit(width))
        rows = items.select(ident, number.cast("int").alias("slice"), offset.cast("int").alias("offset"), "w_in", "w_out", "b_out")
    else:
        cut = F.explode(F.sequence(F.lit(0), F.floor((F.size("w_in") - 1) / F.lit(width)).cast("int"))).alias("cut")
        first = F.col("cut") * width + 1
        rows = items.select(ident, "part", "w_in", "w_out", "b_out", cut).select(
            "id", (part * (PART // width) + F.col("cut")).cast("int").alias("slice"), F.lit(0).alias("offset"),
            F.slice("w_in", first, F.lit(width)).alias("w_in"), F.slice("w_out", first, F.lit(width)).alias("w_out"), "b_out",
        )
    placed = rows.repartitionById(math.ceil(h / width), F.col("slice"))
    return cut_lineage(placed.groupBy("slice").applyInArrow(_pack_slice, "data binary")), width


def _pack_users(asked: pa.Table, ratings: pa.Table) -> pa.Table:
    """Asked cells of one block of users, each once, and these users' ratings."""
    if not asked.num_rows:
        return pa.table({"data": pa.array([], pa.binary())})
    user, item = asked["user"].to_numpy(), asked["item"].to_numpy()
    order = np.lexsort((item, user))
    user, item = user[order], item[order]
    once = np.append(True, (np.diff(user) != 0) | (np.diff(item) != 0))
    users, at = np.unique(user[once], return_inverse=True)
    place, hit = _found(ratings["user"].to_numpy(), users)
    cells = np.flatnonzero(hit)
    cells = cells[np.argsort(place[cells], kind="stable")]
    x = ratings["x"].to_numpy()[cells].astype(float)
    data = streams.to_bytes(users, at.astype(np.int32), item[once], place[cells].astype(np.int32), ratings["item"].to_numpy()[cells].astype(np.int64), x)
    return pa.table({"data": pa.array([data], pa.binary())})


class _Cells:
    """Asked cells and ratings of a task's users, and the predictions so far."""

    def __init__(self, blocks: list[list[np.ndarray]], b_in: np.ndarray, width: int) -> None:
        begin = np.cumsum([0, *(b[0].size for b in blocks)])
        self.users = np.concatenate([b[0] for b in blocks])
        self.asked_by, self.rated_by = (np.concatenate([b[i] + start for b, start in zip(blocks, begin)]) for i in (1, 3))
        self.asked, self.rated, self.x = (np.concatenate([b[i] for b in blocks]) for i in (2, 4, 5))
        self.rates = np.bincount(self.rated_by, minlength=self.users.size) > 0
        self.b_in, self.width, self.ids = b_in, width, None
        self.guess = np.zeros(self.asked.size)

    def _meet_ids(self, ids: np.ndarray) -> None:
        """Where the cells' items lie among those of the weights."""
        self.ids = ids.copy()
        place, hit = _found(self.rated, ids)
        self.by, self.at, self.given = self.rated_by[hit], place[hit], self.x[hit]
        place, hit = _found(self.asked, ids)
        self.cells, self.strange = np.flatnonzero(hit), np.flatnonzero(~hit)
        self.wanted = place[hit]

    def meet(self, block: list[np.ndarray]) -> None:
        """Add what one slice of the hidden units gives."""
        (number, width), ids, into, out, b_out, spread = block
        if self.ids is None or not np.array_equal(ids, self.ids):
            self._meet_ids(ids)
        into, out = into.reshape(-1, width), out.reshape(-1, width)
        codes = np.tile(self.b_in[number * self.width : number * self.width + width], (self.users.size, 1))
        # As in a dense product, a weight that is no number (that of a null id) reaches every user with ratings.
        codes[self.rates] += spread
        step = USERS_AT_ONCE * USER_CELLS
        for start in range(0, self.by.size, step):
            now = slice(start, start + step)
            first = np.flatnonzero(np.diff(self.by[now], prepend=-1))
            codes[self.by[now][first]] += np.add.reduceat(into[self.at[now]] * self.given[now, None], first)
        np.tanh(codes, out=codes)
        for start in range(0, self.cells.size, step):
            now = slice(start, start + step)
            cells, items = self.cells[now], self.wanted[now]
            self.guess[cells] += np.einsum("ij,ij->i", codes[self.asked_by[cells]], out[items])
            if number == 0:
                self.guess[cells] += b_out[items]
        self.guess[self.strange] += 0.0 * codes[self.asked_by[self.strange]].sum(axis=1)


def _reconstructed(b_in: np.ndarray, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for own, block in streams.met(batches, lambda mine: _Cells(mine, b_in, width)):
            own.meet(block)
        if own is not None:
            found = pa.table({"user": own.users[own.asked_by], "item": own.asked, "prediction": own.guess})
            yield from found.to_batches(ROWS_AT_ONCE)

    return run


def _in_chunks(
    pairs: DataFrame, ratings: DataFrame, items: DataFrame, b_in: Sequence[float], user: str, item: str, rating: str, sizes: tuple[int, int, int]
) -> DataFrame:
    """``(_u, _i, prediction)`` of the asked cells.

    Users are dealt into blocks and items into chunks, and each block meets each chunk twice: a product of ratings and input weights
    gives sums whose total over the chunks is the code, and one of codes and output weights gives the
    asked cells. Both are cut in slices of the hidden units (:func:`slices_of`), each with blocks and chunks of its own. A
    group holds as many values as ``BLOCK_USERS`` whole codes and ``CHUNK_ITEMS`` whole weight vectors on average.
    """
    h, (n_cells, n_users, n_items) = len(b_in), sizes
    parts, width = slices_of(n_cells, n_users, n_items, h)
    blocks, chunks = max(1, math.ceil(n_users / (BLOCK_USERS * parts))), max(1, math.ceil(n_items / (CHUNK_ITEMS * parts)))
    cores = pairs.sparkSession.sparkContext.defaultParallelism
    blocks = max(blocks, min(math.ceil(n_users / LEAST_USERS), math.ceil(cores / (parts * chunks))))  # work for every core
    task = ["block", "chunk", "slice"]

    def block(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(blocks)).cast("int").alias("block")

    def chunk(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("long"), F.lit(1)), F.lit(chunks)).cast("int").alias("chunk")

    def everywhere(many: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(many - 1))).alias(name)

    whole = items.groupBy(item, F.floor(F.col("part") * PART / F.lit(width)).cast("int").alias("slice")).agg(
        F.array_sort(F.collect_list(F.struct("part", "w_in", "w_out"))).alias("parts"), F.max("b_out").alias("b_out")
    )
    b_out = F.when(F.col("slice") == 0, F.coalesce("b_out", F.lit(0.0))).otherwise(F.lit(0.0))  # counts once
    into, out = F.flatten(F.col("parts.w_in")), F.concat(F.flatten(F.col("parts.w_out")), F.array(b_out))
    ident = F.col(item).cast("long").alias("id")
    cells = ratings.where(F.col(user).isNotNull() & F.col(item).isNotNull()).select(
        F.col(user).cast("long").alias("user"), F.col(item).cast("long").alias("item"), F.col(rating).cast("double").alias("x"), block(user), chunk(item),
        everywhere(parts, "slice"),
    )
    inputs = whole.select(ident, into.alias("vector"), chunk(item), "slice", everywhere(blocks, "block"))
    weighted = cells.groupBy(*task).cogroup(inputs.groupBy(*task))
    sums = weighted.applyInArrow(lambda key, left, right: _sliced(key, _encode_block(key, left, right)), "id long, vector array<double>, slice int")
    outputs = whole.select(F.lit("item").alias("kind"), ident, out.alias("vector"), chunk(item), "slice", everywhere(blocks, "block"))
    codes = sums.select(F.lit("user").alias("kind"), "id", "vector", everywhere(chunks, "chunk"), "slice", block("id"))
    asked = pairs.where(F.col(user).isNotNull() & F.col(item).isNotNull()).select(
        F.col(user).cast("long").alias("user"), F.col(item).cast("long").alias("item")
    ).distinct().select("*", block("user"), chunk("item"), everywhere(parts, "slice"))
    scored = (
        asked.groupBy(*task)
        .cogroup(outputs.unionByName(codes).groupBy(*task))
        .applyInArrow(_decode_block(np.asarray(b_in, dtype=float), width), "user long, item long, prediction double")
    )
    return scored.groupBy(F.col("user").alias("_u"), F.col("item").alias("_i")).agg(F.sum("prediction").alias("prediction"))


def score_autorec(
    pairs: DataFrame,
    ratings: DataFrame,
    items: DataFrame,
    b_in: Sequence[float],
    user: str = "user_idx",
    item: str = "item_idx",
    rating: str = "rating",
) -> DataFrame:
    """Reconstruct the asked cells of each user's rating row; dropout is off when scoring.

    ``items`` holds the two weight vectors and output bias of each item, cut in pieces of
    ``PART`` hidden units: ``(item, part, w_in, w_out, b_out)``. Hidden units are independent up to the last sum, so
    the weights are stored by slices of the hidden units. A task holds the asked cells and ratings of some blocks of users,
    and the slices pass it one after the other (:mod:`ratewell.operators.streams`): a slice gives its part of the codes and, from these, of the
    predictions. Neither weights nor codes are shuffled to those who need them. With so many items that the weights of
    one unit don't fit a task, blocks of users meet chunks of items instead. A user without ratings is encoded from the bias alone; an item that was not part of
    the fit gets 0, the train mean on the centred scale, and so does a pair with a null id. Every row of
    ``pairs`` stays, with its other columns.
    """
    h = len(b_in)
    sizes = pairs.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(user).alias("u")).crossJoin(items.agg(F.approx_count_distinct(item).alias("i"))).first()
    if 16 * sizes["i"] > UNIT_BYTES:
        found = _in_chunks(pairs, ratings, items, b_in, user, item, rating, (sizes["n"], sizes["u"], sizes["i"]))
    else:
        cores = pairs.sparkSession.sparkContext.defaultParallelism
        blocks = max(1, math.ceil(sizes["u"] / BLOCK_USERS), math.ceil(sizes["n"] / BLOCK_CELLS), min(sizes["u"], 2 * cores))
        slices, width = weight_slices(items, item, h, sizes["i"])
        both = []
        for rows, value in ((pairs, []), (ratings, [F.col(rating).cast("double").alias("x")])):
            ids = [F.col(user).cast("long").alias("user"), F.col(item).cast("long").alias("item")]
            cells = rows.where(F.col(user).isNotNull() & F.col(item).isNotNull()).select(*ids, *value)
            block = F.pmod(F.xxhash64("user", F.lit(5)), F.lit(blocks)).cast("int")
            both.append(cells.withColumn("block", block).repartitionById(blocks, F.col("block")).groupBy("block"))
        own = cut_lineage(both[0].cogroup(both[1]).applyInArrow(_pack_users, "data binary"))
        tasks = max(math.ceil(blocks / OWN_BLOCKS), min(blocks, 2 * cores))
        scored = streams.past(slices, own, tasks).mapInArrow(_reconstructed(np.asarray(b_in, dtype=float), width), "user long, item long, prediction double")
        found = scored.select(F.col("user").alias("_u"), F.col("item").alias("_i"), "prediction")
    met = pairs.join(found, (pairs[user].cast("long") == found["_u"]) & (pairs[item].cast("long") == found["_i"]), "left")
    return met.select(*[pairs[c] for c in pairs.columns], F.coalesce("prediction", F.lit(0.0)).alias("prediction"))
