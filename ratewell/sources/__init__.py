from ratewell.sources.fixtures import ratings_planted, ratings_view
from ratewell.sources.ratings import (
    RAW_SCHEMA,
    load_interactions,
    load_split,
    read_ratings_csv,
    read_ratings_dat,
    save_interactions,
    save_split,
    write_metrics,
    write_ratings_csv,
    write_ratings_dat,
)

__all__ = [
    "RAW_SCHEMA",
    "load_interactions",
    "load_split",
    "ratings_planted",
    "ratings_view",
    "read_ratings_csv",
    "read_ratings_dat",
    "save_interactions",
    "save_split",
    "write_metrics",
    "write_ratings_csv",
    "write_ratings_dat",
]
