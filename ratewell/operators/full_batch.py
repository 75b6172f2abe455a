"""Synchronous matrix factorization: one full-gradient momentum step per Spark job.

Deterministic up to summation order, in plain column code. Each rating contributes one row to
its user and one to its item; sums are combined before the shuffle, so a hot item costs one
partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.functions.scalars import dot
from ratewell.session import cut_lineage


def start(
    users: DataFrame, items: DataFrame, k: int, user: str = "user_idx", item: str = "item_idx"
) -> DataFrame:
    """State table ``(kind, idx, values, speed)`` at rest, from factor tables ``(id, factors, bias)``."""
    still = F.array_repeat(F.lit(0.0), k + 1)
    tables = [
        table.select(
            F.lit(kind).alias("kind"),
            F.col(id_col).cast("long").alias("idx"),
            F.concat("factors", F.array("bias")).alias("values"),
            still.alias("speed"),
        )
        for kind, table, id_col in (("user", users, user), ("item", items, item))
    ]
    return tables[0].unionByName(tables[1])


def step(
    ratings: DataFrame,
    state: DataFrame,
    k: int,
    lr: float = 1.0,
    momentum: float = 0.9,
    decay: float = 1e-5,
    eps: float = 1e-8,
    user: str = "user_idx",
    item: str = "item_idx",
    rating: str = "rating",
) -> DataFrame:
    """State after one descent step on the RMSE of all (centred) ``ratings``."""

    def rows(kind: str, id_col: str) -> DataFrame:
        return state.where(F.col("kind") == kind).select(F.col("idx").alias(id_col), F.col("values").alias(f"_{kind}"))

    joined = ratings.join(rows("user", user), user).join(rows("item", item), item)
    pred = dot("_user", "_item", k) + F.col("_user")[k] + F.col("_item")[k]
    gaps = joined.select(user, item, "_user", "_item", (pred - F.col(rating)).alias("_e"))
    sides = gaps.select(
        "_e",
        F.explode(
            F.array(
                F.struct(F.lit("user").alias("kind"), F.col(user).cast("long").alias("idx"), F.col("_item").alias("by")),
                F.struct(F.lit("item").alias("kind"), F.col(item).cast("long").alias("idx"), F.col("_user").alias("by")),
            )
        ).alias("_s"),
    )
    slopes = [F.sum(F.col("_e") * F.col("_s.by")[f]) for f in range(k)] + [F.sum("_e")]
    sums = cut_lineage(
        sides.groupBy(F.col("_s.kind").alias("kind"), F.col("_s.idx").alias("idx")).agg(
            F.array(*slopes).alias("_slope"),
            F.sum(F.col("_e") * F.col("_e")).alias("_sse"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    # d rmse / d prediction = gap / (n * rmse)
    n = F.sum("_n")
    scale = sums.where(F.col("kind") == "user").agg(n * F.sqrt(F.sum("_sse") / n + eps)).scalar()
    moved = state.join(sums.select("kind", "idx", "_slope"), ["kind", "idx"], "left").withColumn("_scale", scale)
    speed = F.array(
        *[
            F.lit(momentum) * F.col("speed")[f]
            + F.coalesce(F.col("_slope")[f] / F.col("_scale"), F.lit(0.0))
            + F.lit(decay) * F.col("values")[f]
            for f in range(k + 1)
        ]
    )
    return moved.select("kind", "idx", "values", speed.alias("speed")).select(
        "kind",
        "idx",
        F.zip_with("values", "speed", lambda v, s: v - F.lit(lr) * s).alias("values"),
        "speed",
    )


def fit(ratings: DataFrame, state: DataFrame, k: int, steps: int, **settings) -> DataFrame:
    """Repeat :func:`step`, storing the state each time so the plan does not grow."""
    for _ in range(steps):
        state = cut_lineage(step(ratings, state, k, **settings))
    return state
