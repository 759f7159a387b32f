import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the house on a hill was old and its garden had many trees that no one had ever cut down since spring".split()


def prose(n, seed=0):
    return " ".join(WORDS[(i * i + seed * 7 + i) % len(WORDS)] + (str(i) if i % 5 == 0 else "") for i in range(n))


def awkward_rows():
    """Nulls in every column, empty and blank texts, a very long text, ties and repeated rows."""
    return [
        (1, prose(40), "en", "a", 1), (1, prose(40), "en", "a", 1), (2, prose(40, 3), "en", "a", 2), (3, prose(40, 3), "en", None, 2),
        (4, None, "en", "b", None), (5, "", "de", "b", 0), (6, " \n\t ", None, "b", 3), (7, "!!! 123 ???", "de", "b", 4),
        (None, prose(30, 9), None, None, None), (8, prose(60_000, 5), "de", "c", 9), (9, "x", "de", "c", 1), (10, "Straße ñandú 漢字 \U0001f600 été", "de", "c", 7),
        (11, "a  b   c \n\n d  e", "en", "a", 5), (12, None, None, None, None)]


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows, with extra columns named as operators name theirs."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(awkward_rows(), DOCS)
    for c in ("score", "n", "key", "__mix", "gid", "predicted"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df):
    return [tuple(r) for r in df.collect()]
