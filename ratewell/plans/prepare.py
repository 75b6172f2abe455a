"""From a raw rating file to prepared train and test tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.operators.numbering import dense_index
from ratewell.operators.prepare import filter_active, latest_rating, part_of, split_bernoulli, split_exact
from ratewell.sources.ratings import load_split, read_ratings_dat, save_split
from ratewell.session import cut_lineage


def normalise(raw: DataFrame) -> DataFrame:
    """Raw rows as ``(user_id, item_id, rating)``: user ids from 0, the newest rating of each pair."""
    renamed = raw.select(
        (F.col("userId") - 1).alias("user_id"), F.col("movieId").alias("item_id"), "rating", "timestamp"
    )
    return latest_rating(renamed, ["timestamp", "rating"])


def index_active(ratings: DataFrame, max_users: int, max_items: int) -> DataFrame:
    """Busiest users and items only, with dense ``user_idx`` and ``item_idx``."""
    kept = cut_lineage(filter_active(ratings, max_users, max_items))
    return dense_index(dense_index(kept, "user_id", "user_idx"), "item_id", "item_idx")


def prepare(
    spark: SparkSession,
    source: str | DataFrame,
    path: str | None = None,
    max_users: int = 6000,
    max_items: int = 2000,
    test: float = 0.2,
    seed: int = 42,
    exact: bool = True,
    load: bool = True,
    save: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Train and test tables with dense ids.

    ``load`` reuses a split stored at ``path`` when both parts exist; otherwise it is
    computed from ``source`` (a raw file path or a raw DataFrame) and, with ``save``,
    stored there and read back.
    """
    if load and path:
        try:
            return load_split(spark, path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    raw = read_ratings_dat(spark, source) if isinstance(source, str) else source
    indexed = cut_lineage(index_active(normalise(raw), max_users, max_items))  # the split reads it several times
    if exact:
        labelled = split_exact(indexed, test, seed)
    else:
        labelled = split_bernoulli(indexed, round(100 * (1 - test)), seed)
    train, held_out = part_of(labelled, "train"), part_of(labelled, "test")
    if save and path:
        save_split(train, held_out, path)
        return load_split(spark, path)
    labelled = cut_lineage(labelled)  # or both parts would rank the edge of the split again
    return part_of(labelled, "train"), part_of(labelled, "test")
