import datetime as dt

import pytest
from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

#: Columns whose names clash with those that operators use inside.
SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("score", DoubleType()),
    StructField("digest", StringType()), StructField("fp", LongType()), StructField("_digest", StringType()),
    StructField("row", DateType()), StructField("ids", StringType()), StructField("spans", StringType()),
])


def odd_texts():
    """(doc_id, text) of the cases that every operator must take."""
    long = " ".join(f"word{k % 977} Thing{k % 13}," for k in range(60_000))
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, long), (6, "same text here twice"),
            (7, "same text here twice"), (8, "日本語 テキスト 𠮷 é é \x00 end"), (9, "don't we'll 's ''s I'VE"),
            (None, "no id"), (None, None), (10, "repeated row"), (10, "repeated row"), (10, "other text, same id")]


@pytest.fixture(scope="session")
def odd(spark):
    day = dt.date(2020, 1, 1)
    return spark.createDataFrame([(i, t, 0.5, "x", 7, "y", day, "z", None) for i, t in odd_texts()], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
