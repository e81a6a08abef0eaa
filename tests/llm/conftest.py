import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..conftest import SF_SMALL

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("lang", StringType()), StructField("source", StringType()),
                   StructField("n_words", LongType())])


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture(scope="session")
def odd_docs(spark):
    """NULLs, empty and repeated rows, a long text, and a column that clashes with results."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda my"
    rows = [(1, base, "en", "a", 7), (1, base, "en", "a", 7), (2, base.upper(), "en", None, None),
            (3, None, None, None, None), (4, "", "en", "a", 0), (None, "only words here", "de", "b", 1),
            (5, " \n\t ", "de", "b", 1), (6, "w " * 30000, "en", "b", 1), (7, "É é <|endoftext|> x", "fr", "b", 2)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
