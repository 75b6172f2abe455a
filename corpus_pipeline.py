"""Training-data pipeline over ``documents``: five stages, each written as Parquet and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.llm.contamination import drop_contaminated
from ratewell.llm.jaccard import keep_one_of_each
from ratewell.llm.langid import fit_profiles, keep_identified
from ratewell.llm.lines import dedup_lines
from ratewell.llm.packing import pack
from ratewell.llm.queries import tokenizer_path
from ratewell.session import shared_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the languages of the table; profiles come from all rows with a language."""
    return keep_identified(docs, fit_profiles(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop repeated lines; a document left without any word goes, its lines being elsewhere."""
    kept = dedup_lines(docs).select("doc.*").where(F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    return kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType)) if "n_chars" in kept.columns else kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences that follow the sources' shares."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pack", packed),
]

#: Language prediction and tokenizing have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` in order to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
