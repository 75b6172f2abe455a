"""Readers and writers for raw ratings, prepared splits, interactions and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field names, separator and encoding of the raw rating file.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)
RAW_SEPARATOR = "::"
RAW_ENCODING = "ISO-8859-1"


def read_ratings_dat(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Raw ``user::item::rating::timestamp`` lines without a header."""
    return spark.read.csv(path, sep=RAW_SEPARATOR, encoding=RAW_ENCODING, schema=schema, header=False)


def write_ratings_dat(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep=RAW_SEPARATOR, encoding=RAW_ENCODING, header=False)


def read_ratings_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Delimited ratings with a header. Give a schema to spare the extra pass that infers types."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def write_ratings_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def save_split(train: DataFrame, test: DataFrame, path: str) -> None:
    """Write both parts as Parquet under ``split=train`` and ``split=test``."""
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    both.write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Train and test; each read touches its own directory only. Both must exist."""
    return spark.read.parquet(f"{path}/split=train"), spark.read.parquet(f"{path}/split=test")


def save_interactions(
    df: DataFrame, path: str, user: str = "user_idx", item: str = "item_idx", partitions: int | None = None
) -> None:
    """Store interactions twice, clustered by user and by item.

    Each copy is range partitioned and sorted on both ids, so a lookup by either side reads
    few row groups and an id with very many rows spreads over several files.
    """
    for name, keys in (("by_user", [user, item]), ("by_item", [item, user])):
        placed = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
        placed.sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{path}/{name}")


def load_interactions(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/by_user"), spark.read.parquet(f"{path}/by_item")


def save_bucketed(df: DataFrame, path: str, table: str, key: str, order: str, buckets: int = 32) -> None:
    """Store interactions at ``path`` in ``buckets`` by ``key``, each sorted by ``key`` and ``order``.

    Tables with the same key and number of buckets join, and group by the key, without a shuffle.
    """
    placed = df.repartition(buckets, key)  # one file per bucket
    placed.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key, order).saveAsTable(table)


def load_bucketed(spark: SparkSession, path: str, table: str, key: str, order: str, buckets: int = 32) -> DataFrame:
    """The table of :func:`save_bucketed`; a session that doesn't know it yet learns it from its files."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`, `{order}`) "
            f"INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )
    return spark.table(table)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)
