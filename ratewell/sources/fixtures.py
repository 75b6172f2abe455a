"""Rating tables derived from the order tables used by the checks and the benchmark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.operators.prepare import latest_rating


def ratings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (customer, supplier); the latest line decides the rating, in half steps."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    raw = lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("item_id"),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias("rating"),
        "o_orderdate",
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
    )
    return latest_rating(raw, ["o_orderdate", "l_orderkey", "l_linenumber", "l_extendedprice"])


def _wave(ident: str, f: int, t: int) -> Column:
    return (F.col(ident) * (31 + 6 * f) + 17 * f + 13 * t) % 101 - 50


def ratings_planted(ratings: DataFrame) -> DataFrame:
    """The pairs of ``ratings`` with a rating that follows user and item effects plus two factors.

    Integer arithmetic, so every engine gets the same half steps.
    """
    u, i = "user_id", "item_id"
    score = (
        30000
        + 100 * (_wave(u, 0, 0) + _wave(i, 0, 1))
        + 6 * (_wave(u, 1, 2) * _wave(i, 1, 3) + _wave(u, 2, 2) * _wave(i, 2, 3))
    )
    steps = F.floor(F.greatest(2 * score + 5000, F.lit(0)) / 10000) / 2
    return ratings.select(u, i, F.greatest(F.lit(0.5), F.least(F.lit(5.0), steps)).alias("rating"))
