import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words string, shard string, __row int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing column names."""
    long = " ".join(f"word{i * i % 99_991}" for i in range(60_000))
    rows = [
        (1, None, "en", "a"),
        (2, "", None, None),
        (3, "one two three", "en", "a"),
        (3, "one two three", "en", "a"),
        (4, "mail a.b@x.example.com or 10.0.0.1 " * 30, "en", None),
        (5, long, "en", "a"),
        (6, long + " end", "en", "a"),
        (7, " \n\t ", "de", "a"),
        (None, "no id here at all but some words", "de", "b"),
        (8, "straße ünï  two  spaces\n\nlines 😀 <|endoftext|> x", "de", "b"),
    ]
    return spark.createDataFrame([(*r, None, "clash", "clash", 7) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
