"""Preparation of rating tables: dedupe, activity filters, splits, centring, adjacency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewell.functions.scalars import pair_hash, pair_key
from ratewell.operators.numbering import global_row_number
from ratewell.session import cut_lineage


def as_triples(df: DataFrame, user: str = "user_idx", item: str = "item_idx", rating: str = "rating") -> DataFrame:
    """Project and cast to ``(user_idx BIGINT, item_idx BIGINT, rating DOUBLE)``."""
    return df.select(
        F.col(user).cast("long").alias("user_idx"),
        F.col(item).cast("long").alias("item_idx"),
        F.col(rating).cast("double").alias("rating"),
    )


def latest_rating(
    df: DataFrame,
    order_cols: Sequence[str],
    keys: Sequence[str] = ("user_id", "item_id"),
    value: str = "rating",
) -> DataFrame:
    """One rating per pair: the one that is last in ``order_cols``; combined before the shuffle."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(*order_cols)).alias(value))


def activity(df: DataFrame, key: str) -> DataFrame:
    """Ratings per user or per item."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_ratings"))


def top_n(counts: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most active ids, ties to the lowest id: a heap of ``n`` per partition and one merge."""
    return counts.orderBy(F.desc("n_ratings"), F.asc(key)).limit(n)


def keep_top(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in ``top``."""
    return df.join(top.select(key), key, "left_semi")


def filter_active(df: DataFrame, max_users: int, max_items: int, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Keep the busiest users and items; both rankings come from the unfiltered table.

    The table is stored once: the two rankings and the filter scan that, not what it was made from.
    """
    df = cut_lineage(df)
    top_users = top_n(activity(df, user), user, max_users)
    top_items = top_n(activity(df, item), item, max_items)
    return keep_top(keep_top(df, top_items, item), top_users, user)


def split_bernoulli(
    df: DataFrame, train_percent: int = 80, seed: int = 42, user: str = "user_id", item: str = "item_id"
) -> DataFrame:
    """Label each row ``train`` or ``test`` by a seeded hash of its pair.

    A narrow projection: no shuffle, and the same label in every run and engine.
    """
    bucket = pair_hash(user, item, seed) % 100
    return df.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))


def split_random(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Spark's own random split; repeatable only for an unchanged input layout."""
    return df.randomSplit(list(weights), seed)


def split_exact(
    df: DataFrame, test: float = 0.2, seed: int = 42, user: str = "user_id", item: str = "item_id"
) -> DataFrame:
    """Label exactly ``ceil(test * n)`` rows ``test``: the first ones in seeded hash order.

    The hash is uniform, so a histogram over its first 16 bits (at most 65,536 rows)
    finds the bucket holding the last test row. Only that bucket, about ``n / 65536`` rows,
    is ranked; every other row is labelled by comparing its key with the cut.
    """
    ordered = df.withColumn("_key", pair_key(user, item, seed))
    key = F.struct("_key", user, item)
    bucket = F.substring("_key", 1, 4)
    sizes = ordered.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_bucket")
    whole = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edge = (
        sizes.select(
            "_bucket",
            "_n",
            F.sum("_n").over(running).alias("_upto"),
            F.ceil(F.sum("_n").over(whole) * F.lit(test)).alias("_want"),
        )
        .where((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_n") < F.col("_want")))
        .select("_bucket", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_rest"))
    )
    in_edge = ordered.select(bucket.alias("_bucket"), key.alias("_k")).join(F.broadcast(edge), "_bucket")
    ranked = in_edge.withColumn("_r", F.row_number().over(Window.partitionBy("_bucket").orderBy("_k")))
    cut = ranked.where(F.col("_r") == F.col("_rest")).select("_k").scalar()
    return ordered.withColumn("split", F.when(key <= cut, "test").otherwise("train")).drop("_key")


def part_of(df: DataFrame, split: str) -> DataFrame:
    return df.where(F.col("split") == split).drop("split")


def global_mean(train: DataFrame, rating: str = "rating") -> DataFrame:
    """Mean training rating, as a one-row DataFrame."""
    return train.agg(F.avg(rating).alias("global_mean"))


def center(df: DataFrame, mean: DataFrame, rating: str = "rating") -> DataFrame:
    """Subtract a one-row mean, read as a scalar subquery."""
    return df.withColumn(rating, F.col(rating) - mean.scalar())


def uncenter(df: DataFrame, mean: DataFrame, column: str = "prediction") -> DataFrame:
    return df.withColumn(column, F.col(column) + mean.scalar())


def extent(*frames: DataFrame, user: str = "user_idx", item: str = "item_idx") -> DataFrame:
    """``n_users`` and ``n_items``: highest index plus one over all given frames."""
    bounds = None
    for frame in frames:
        one = frame.agg(F.max(user).alias("u"), F.max(item).alias("i"))
        bounds = one if bounds is None else bounds.unionByName(one)
    return bounds.agg((F.max("u") + 1).alias("n_users"), (F.max("i") + 1).alias("n_items"))


def adjacency(df: DataFrame, key: str, other: str, span: int = 1024) -> DataFrame:
    """Sorted list of partners per ``key``, in pieces covering ``span`` consecutive partner ids.

    A popular item may be rated by a third of all users, so its list is never one array:
    piece ``chunk`` holds the partners in ``[chunk * span, (chunk + 1) * span)``.
    """
    return (
        df.select(key, F.floor(F.col(other) / F.lit(span)).cast("long").alias("chunk"), other)
        .groupBy(key, "chunk")
        .agg(F.sort_array(F.collect_set(other)).alias("partners"))
    )


def user_items(train: DataFrame, user: str = "user_idx", item: str = "item_idx", span: int = 1024) -> DataFrame:
    return adjacency(train, user, item, span)


def item_users(train: DataFrame, user: str = "user_idx", item: str = "item_idx", span: int = 1024) -> DataFrame:
    return adjacency(train, item, user, span)


def user_vectors(
    df: DataFrame, user: str = "user_idx", item: str = "item_idx", rating: str = "rating", span: int = 1024
) -> DataFrame:
    """Sparse rating rows: ``(user, chunk, cells ARRAY<STRUCT<item, rating>>)``, bounded like :func:`adjacency`."""
    return (
        df.select(user, F.floor(F.col(item) / F.lit(span)).cast("long").alias("chunk"), item, rating)
        .groupBy(user, "chunk")
        .agg(F.sort_array(F.collect_list(F.struct(F.col(item).alias("item"), F.col(rating).alias("rating")))).alias("cells"))
    )
