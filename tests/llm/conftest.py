import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

LINE = "A line of more than twenty signs."
WORDS = " ".join(f"w{i}" for i in range(60))
#: Nulls in every column, empty and long texts, ties, repeated rows and ids, odd white space.
ROWS = [
    (1, WORDS, "en", "a", 10), (2, WORDS, "en", "a", 10), (2, WORDS, "en", "a", 10),
    (3, WORDS + " more", "de", "b", 10), (4, None, None, None, None), (5, "", "", "", 0),
    (None, WORDS + " other end", "en", None, 3), (6, " \n\t \x0b", "en", "a", 4),
    (7, f"{LINE}\n {LINE.upper()}\t\nown line", "en", "a", 1), (8, f"\n{LINE}\n", "en", "b", 1),
    (9, LINE, None, "b", 1), (9, LINE, None, "b", 1), (10, "one two three", "fr", "c", 1),
    (11, "ONE two three", "fr", "c", 1), (12, "One Two Three", "fr", "c", 1),
    (13, "é́ \U0001f600 <|endoftext|> it's 'll 3.14 İx", "fr", "c", 1),
    (14, "".join(f"long{i} text\n" for i in range(40_000)), "en", "a", 1), (15, "a" * 5000, "en", "a", 1),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def sf_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
