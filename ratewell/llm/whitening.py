"""Whitening of vectors with distributed block matrices.

Centred rows are indexed into the blocks of an MLlib ``BlockMatrix``. Its transpose times itself is the
scatter, a small matrix whose eigenvectors are found on the driver; a second block product
projects the rows. Rows of any number pass through tasks only: the driver sees sums, one small
matrix and block numbers.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ratewell.llm.storage import stored
from ratewell.session import shared_dir

SMALL, LARGE = 1 << 20, 1 << 26  # bytes of a block: the first, until there are MANY blocks, then up to the second
MANY = 20_000
_LIMIT = 1 << 62
_BLOCK = f"ids array<long>, deviations array<long>, matrix {MatrixUDT.sqlType().simpleString()}"
_OUT = "vec_id long, component int, deviation long, whitened double"


@dataclass(frozen=True)
class Fit:
    """Exact counts and sums of the fit list, and the components in falling order of variance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def weights(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def usable(vector: str = "embedding") -> Column:
    """True where the vector and all its entries are there and finite."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~odd, F.lit(False))


def as_longs(vector: str = "embedding") -> Column:
    """``floor(64 * c) + 1000000`` of every entry; ``64 * c`` is held within 2**62."""
    edge = float(_LIMIT)
    return F.transform(vector, lambda c: F.floor(F.least(F.greatest(c.cast("double") * 64, F.lit(-edge)), F.lit(edge))) + F.lit(1_000_000))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _exact(rows: np.ndarray, bound: float) -> np.ndarray:
    """The rows as machine integers if ``bound`` fits them, else as Python integers."""
    return rows if bound < _LIMIT else rows.astype(object)


def _largest(rows: np.ndarray) -> float:
    return float(np.abs(rows.astype(np.float64)).max(initial=0.0))


def _sums(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * width, 0
        for batch in batches:
            rows = _matrix(batch["x"], width)
            part = _exact(rows, _largest(rows) * max(1, len(rows))).sum(axis=0)
            total, n = [a + int(b) for a, b in zip(total, part)], n + len(rows)
        whole = pa.array([str(t) for t in total])
        yield pa.record_batch({"pos": pa.array(range(width), pa.int32()), "part": whole, "n": pa.array([n] * width, pa.int64())})

    return run


def _centred(rows: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``, exact."""
    bound = _largest(rows) * n + float(max(map(abs, sums.tolist()), default=0))
    return _exact(rows, bound) * n - (sums if bound >= _LIMIT else sums.astype(np.int64))


def _deviations(centred: np.ndarray) -> list[int | None]:
    """Sum of squares of each row; none where it passes the range of a long."""
    width = centred.shape[1]
    if centred.dtype != object and _largest(centred) ** 2 * width < _LIMIT:
        return (centred * centred).sum(axis=1).tolist()
    return [s if (s := sum(int(v) ** 2 for v in row)) < 1 << 63 else None for row in centred]


def _into_blocks(n: int, sums: list[int], height: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of ``height`` centred rows; the last one of a task is filled up with zeros, which add nothing."""
    width, exact = len(sums), np.array(sums, dtype=object)

    def block(ids: list, rows: np.ndarray) -> pa.RecordBatch:
        centred = _centred(rows, n, exact)
        values = np.zeros((height, width))
        values[: len(rows)] = (centred / n).astype(np.float64)
        matrix = {
            "type": 1, "numRows": height, "numCols": width, "colPtrs": None, "rowIndices": None,
            "values": values.ravel(), "isTransposed": True,
        }
        kind = pa.struct(
            [
                ("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
                ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_()),
            ]
        )
        longs = pa.list_(pa.int64())
        return pa.record_batch(
            {
                "ids": pa.array([ids], longs),
                "deviations": pa.array([_deviations(centred) if ids else []], longs),
                "matrix": pa.array([matrix], kind),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids = np.zeros((0, width), np.int64), []
        for batch in batches:
            held = np.vstack([held, _matrix(batch["x"], width)])
            ids += batch["vec_id"].to_pylist() if "vec_id" in batch.schema.names else []
            while len(held) >= height:
                yield block(ids[:height], held[:height])
                held, ids = held[height:], ids[height:]
        if len(held):
            yield block(ids, held)

    return run


def _blocks(rows: DataFrame, n: int, sums: list[int], height: int) -> DataFrame:
    """Stored blocks with a gapless number ``block``, their matrix as MLlib's own type."""
    cut = rows.mapInArrow(_into_blocks(n, sums, height), _BLOCK).withColumn("at", F.monotonically_increasing_id())
    path = f"{shared_dir(rows.sparkSession)}/blocks-{uuid.uuid4().hex}"
    cut.write.parquet(path)
    typed = StructType([f if f.name != "matrix" else StructField("matrix", MatrixUDT()) for f in cut.schema.fields])
    kept = rows.sparkSession.read.schema(typed).parquet(path)
    part = F.shiftright("at", 33)
    sizes = kept.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("many"))  # one row per task that wrote
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("many").over(before), F.lit(0)).alias("start"))
    number = F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)
    return kept.withColumn("part", part).join(starts, "part").select(number.alias("block"), "ids", "deviations", "matrix")


def _as_block_matrix(blocks: DataFrame, across: int, height: int, width: int, count: int) -> BlockMatrix:
    """The blocks laid out ``across`` in a row; one in a row is the matrix itself."""
    place = F.struct(F.floor(F.col("block") / across).cast("long").alias("i"), (F.col("block") % across).cast("long").alias("j"))
    tall = math.ceil(count / across) * height
    made = callMLlibFunc("createBlockMatrix", blocks.select(place.alias("place"), "matrix"), height, width, tall, across * width)
    return BlockMatrix(made, height, width)


def _scatter(blocks: DataFrame, height: int, width: int, count: int) -> np.ndarray:
    """Transpose times matrix, its long inner dimension dealt to many tasks whose small products are added up."""
    rows = _as_block_matrix(blocks, 1, height, width, count)
    splits = count if count <= 1024 else max(1024, count // 4)
    product = rows.transpose()._java_matrix_wrapper.call("multiply", rows._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, width, width).toLocalMatrix().toArray()


def _projected(blocks: DataFrame, weights: np.ndarray, height: int, count: int) -> DataFrame:
    """``block, matrix`` of all blocks times the weights.

    MLlib deals a product by squares of its result, which would give a tall matrix a few huge tasks. The
    blocks are therefore laid out as a square, and the weights stand on the diagonal of the right side.
    """
    width, k = weights.shape
    across = max(1, math.isqrt(count - 1) + 1)
    left = _as_block_matrix(blocks, across, height, width, count)
    small = DenseMatrix(width, k, weights.ravel(order="F").tolist())
    context = blocks.sparkSession.sparkContext
    right = BlockMatrix(context.parallelize([((j, j), small) for j in range(across)], 1), width, k, across * width, across * k)
    found = callMLlibFunc("getMatrixBlocks", left.multiply(right)._java_matrix_wrapper._java_model)
    number = F.col("_1._1").cast("long") * across + F.col("_1._2")
    return found.select(number.alias("block"), F.unwrap_udt("_2").alias("matrix"))


def _values(matrix: pa.StructScalar) -> np.ndarray:
    found = matrix.as_py()
    shape = (found["numRows"], found["numCols"])
    return np.reshape(found["values"], shape, order="C" if found["isTransposed"] else "F")


def _moments(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Products and sums of whitened rows, one value per pair of components and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            for matrix in batch["matrix"]:
                rows = _values(matrix)
                total[:k] += rows.T @ rows
                total[k] += rows.sum(axis=0)
        yield pa.record_batch({"pos": pa.array(range(total.size), pa.int32()), "part": total.ravel()})

    return run


def _identity_error(whitened: DataFrame, k: int, n: int) -> float:
    sums = whitened.select("matrix").mapInArrow(_moments(k), "pos int, part double").groupBy("pos").agg(F.sum("part").alias("s"))
    total = np.zeros((k + 1) * k)
    for row in sums.collect():  # (k + 1) * k numbers
        total[row["pos"]] = row["s"]
    products, mean = total[: k * k].reshape(k, k) / n, total[k * k :] / n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, deviations, matrix in zip(batch["ids"], batch["deviations"], batch["matrix"]):
            rows = _values(matrix)[: len(ids)]
            k = rows.shape[1]
            yield pa.record_batch(
                {
                    "vec_id": ids.values.take(np.repeat(np.arange(len(ids)), k)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(ids))),
                    "deviation": deviations.values.take(np.repeat(np.arange(len(ids)), k)),
                    "whitened": pa.array(rows.ravel()),
                }
            )


def whiten(vectors: DataFrame, keep: int = 16) -> tuple[DataFrame, Fit | None]:
    """Project ``vectors (vec_id, x ARRAY<BIGINT>)`` on their whitened principal components.

    The fit list is each distinct vector once; its size, sums and covariance (divisor n) give unit
    eigenvectors by falling eigenvalue. Every row, copies too, is centred and projected on the first
    ``keep`` of them and divided by the square root of the eigenvalue. Returns the rows
    ``(vec_id, component, deviation, whitened)`` and the fit.

    Vectors of another length than the most common one (ties: the longer) take no part, nor do null
    and empty ones. ``vec_id`` may be null or repeat; other columns are not read. Components
    without variance (eigenvalue within rounding error of 0) are left out, as nothing can
    scale them to 1, so equal vectors give no rows, and an empty table gives none. Components of equal
    variance are some basis of their plane. ``deviation``, the sum of squares of ``n * x - S``, is exact
    and null beyond the range of a long.
    """
    spark = vectors.sparkSession
    rows = stored(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "x").where(F.size("x") > 0), "vectors")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    nothing = spark.createDataFrame([], _OUT)
    if length is None:
        return nothing, None
    width = length["d"]
    rows = rows.where(F.size("x") == width)
    fit_list = stored(rows.select("x").distinct(), "fit")
    parts = fit_list.mapInArrow(_sums(width), "pos int, part string, n long")
    total = parts.groupBy("pos").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("pos").collect()
    n, sums = total[0]["n"], [int(row["s"]) for row in total]

    def height(many: int) -> int:
        return min(max(SMALL // (8 * width), many // MANY, 1), max(LARGE // (8 * width), 1))

    tall = height(n)
    listed = _blocks(fit_list, n, sums, tall)
    count = listed.count()
    covariance = _scatter(listed, tall, width, count) / n
    values, found = np.linalg.eigh((covariance + covariance.T) / 2)
    values, found = values[::-1], found[:, ::-1]
    trace = float(values.sum())
    k = int(((values > trace * width * 1e-14) & (values > 0))[:keep].sum())
    if not k:
        return nothing, Fit(n, sums, values[:0], found[:, :0], trace)
    fit = Fit(n, sums, values[:k], found[:, :k], trace)
    error = _identity_error(_projected(listed, fit.weights, tall, count), k, n)

    tall = height(length["count"])
    every = _blocks(rows, n, sums, tall)
    scored = _projected(every.select("block", "matrix"), fit.weights, tall, every.count())
    whole = scored.join(every.select("block", "ids", "deviations"), "block").select("ids", "deviations", "matrix")
    return whole.mapInArrow(_rows_out, _OUT), Fit(n, sums, fit.values, fit.vectors, trace, error)
