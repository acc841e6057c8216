"""Small tables for the corpus operators."""

import pytest

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


@pytest.fixture
def make(spark):
    def rows(data, schema=DOCS):
        return spark.createDataFrame(data, schema)

    return rows


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
