import pytest

from llm_data import DOCUMENT, edge_rows


@pytest.fixture(scope="session")
def edge(spark):
    rows = edge_rows()
    # Extra columns with names that the operators use themselves.
    frame = spark.createDataFrame(rows, DOCUMENT)
    return frame.selectExpr(
        "*", "1 as node", "'s' as score", "2 as n_words", "3 as kept", "4 as part", "5 as hashes", "6 as spans", "7 as lang_pred"
    )


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
