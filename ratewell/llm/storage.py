"""Tables and blocks shared by the operators."""

from __future__ import annotations

import math
import uuid

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewell.session import shared_dir


def stored(df: DataFrame, name: str = "part") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of the whole table."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return row["n"], row["b"] or 0


def in_blocks(docs: DataFrame, size: int, block_bytes: int) -> tuple[DataFrame, int]:
    """Add ``block``: ranges of ``doc_id`` in ascending order, about ``block_bytes`` of text each.

    Every row of a smaller block has a smaller ``doc_id`` than every row of a larger block, and
    rows of one ``doc_id`` share a block. Rows without ``doc_id`` are spread over blocks of their own.
    Only the range bounds, one number per block, pass through the driver.
    """
    n = max(1, math.ceil(size / block_bytes))
    cuts: list[float] = []
    if n > 1:
        parts = [k / n for k in range(1, n)]
        found = docs.select(F.percentile_approx("doc_id", parts, max(10_000, 20 * n)).alias("q")).first()["q"]
        cuts = sorted({float(x) for x in found or []})
    number = F.lit(0.0)
    if cuts:
        wide = docs.withColumn("_id", F.col("doc_id").cast("double"))
        docs = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="_id", outputCol="_block", handleInvalid="keep").transform(wide)
        number = F.col("_block")
    alone = F.lit(n) + F.pmod(F.xxhash64("text"), F.lit(n))
    block = F.when(F.col("doc_id").isNull(), alone).otherwise(number.cast("int")).cast("int")
    return docs.select(block.alias("block"), "doc_id", "text"), n


def running_sum(df: DataFrame, groups: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows before, in order of ``bucket`` and then ``order``.

    Buckets are small, so a window sorts one bucket at a time and only bucket sums meet; also adds
    ``<out>_total``, the sum over the whole group.
    """
    inside = Window.partitionBy(*groups, bucket).orderBy(*order)
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*groups, bucket).agg(F.sum(value).alias("_sum"))
    sums = sums.select(
        *groups,
        bucket,
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
        F.sum("_sum").over(Window.partitionBy(*groups)).alias(f"{out}_total"),
    )
    local = df.withColumn("_local", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value))
    return local.join(sums, [*groups, bucket]).withColumn(out, F.col("_before") + F.col("_local")).drop("_before", "_local")
