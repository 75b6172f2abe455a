"""Alternating least squares on prepared ratings."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.session import shared_dir


def fit_als(
    train: DataFrame,
    rank: int = 10,
    iters: int = 10,
    reg: float = 0.01,
    seed: int = 42,
    user: str = "user_idx",
    item: str = "item_idx",
    rating: str = "rating",
    blocks: int = 10,
) -> ALSModel:
    """Explicit-feedback ALS. The random start is drawn by block, so ``blocks`` is part of the model."""
    shared_dir(train.sparkSession)  # lets ALS cut its lineage every few iterations
    als = ALS(
        rank=rank,
        maxIter=iters,
        regParam=reg,
        seed=seed,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        coldStartStrategy="drop",
    )
    ints = train.select(F.col(user).cast("int").alias(user), F.col(item).cast("int").alias(item), F.col(rating))
    return als.fit(ints)


def predict_als(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``(user, item, prediction)`` for distinct pairs; pairs with an unseen side are absent."""
    user, item = model.getUserCol(), model.getItemCol()
    asked = pairs.select(F.col(user).cast("int").alias(user), F.col(item).cast("int").alias(item)).distinct()
    return model.transform(asked).select(user, item, F.col("prediction").cast("double").alias("prediction"))


def attach_predictions(
    df: DataFrame, predictions: DataFrame, user: str = "user_idx", item: str = "item_idx"
) -> DataFrame:
    """Ratings that have a prediction, with it, matched on both ids."""
    return df.join(predictions, [user, item])
