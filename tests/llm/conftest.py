import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]
)


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from a list of texts (ids from 0) or of (doc_id, text)."""

    def make(rows, extra=()):
        rows = [row if isinstance(row, tuple) else (i, row) for i, row in enumerate(rows)]
        df = spark.createDataFrame([(i, text, "s") for i, text in rows], DOCS)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def real_texts(spark, sf_dir):
    """(doc_id, text) of the test documents."""
    return [tuple(x) for x in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
