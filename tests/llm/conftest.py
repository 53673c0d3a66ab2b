import pytest
from pyspark.sql import types as T

from martforge.llm.scratch import settings
from martforge.session import tune


@pytest.fixture(scope="session")
def s(spark):
    tune(spark)
    settings(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return spark


@pytest.fixture(scope="session")
def docs(s):
    return s.read.parquet("/root/testdata/sf0.001/documents.parquet")


DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType()), T.StructField("_text", T.StringType()),
                    T.StructField("node", T.LongType())])

PASSAGE = " ".join(f"word{i}" for i in range(40))
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))


def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, a
    repeated id with another text, and extra columns with clashing names."""
    rows = [(1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \n\t ", "en", None, 3),
            (4, PASSAGE, "en", "a", 1), (5, "before " + PASSAGE + " after", "en", "b", 2),
            (5, "before " + PASSAGE + " after", "en", "b", 2), (6, PASSAGE, None, "a", 1),
            (None, PASSAGE + " tail", "en", None, 1), (None, None, None, None, None),
            (7, "one two", "en", "b", 7), (7, "another text", "en", "b", 7), (8, LONG, "en", "c", 9),
            (9, "the the " * 60, "en", "c", 9), (10, "É é ß Ω 漢字 \U0001f600 ok", "fr", "c", 9)]
    return [(a, b, c, d, e, "clash", 99) for a, b, c, d, e in rows]


@pytest.fixture(scope="session")
def odd(s):
    return s.createDataFrame(odd_rows(), DOC)


@pytest.fixture(scope="session")
def none(s):
    return s.createDataFrame([], DOC)
