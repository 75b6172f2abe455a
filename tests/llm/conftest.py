"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""

import pytest
from pyspark.sql import Row
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        StructField("doc", IntegerType()),
        StructField("n", IntegerType()),
        StructField("row", IntegerType()),
        StructField("hash", IntegerType()),
        StructField("block", IntegerType()),
    ]
)

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore".split()


def long_text(n, step=1):
    return " ".join(WORDS[(i * step * 7 + i // 5) % len(WORDS)] + str(i % 97) for i in range(n))


PASSAGE = " ".join(f"shared{i}" for i in range(20))

TEXTS = [
    (0, None, None, None),
    (1, "", "en", "a"),
    (2, " \t\n ", "en", "a"),
    (3, "one two three", "en", "a"),
    (4, "one two three", "en", "b"),  # an exact copy
    (4, "one two three", "en", "b"),  # a repeated row
    (5, "ONE two\tthree", "en", "a"),
    (6, f"start {PASSAGE} end of six", "en", "a"),
    (7, f"other {PASSAGE} end of seven", "en", "a"),
    (8, long_text(3000), "en", "a"),
    (9, long_text(3000) + " and a bit more", "en", "c"),
    (10, long_text(2500, 3), "en", "c"),
    (None, f"no id {PASSAGE}", "en", None),
    (11, "Äöü naïve café 東京 Ωmega\nA Line That Repeats\n  a line that repeats \nshort\nshort", "de", "a"),
    (12, "x\nA LINE THAT REPEATS\nshort\nshort", "de", "a"),
    (13, "a line that repeats", "de", "a"),
    (13, "another text of the same id with words and more words", "de", "a"),
    (14, "12345 67890 !!", None, "a"),
    (15, "word", "de", "a"),
]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [Row(i, t, g, s, len(t or ""), k, k, k, k, k) for k, (i, t, g, s) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sample(spark):
    """A bounded table for brute force."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
