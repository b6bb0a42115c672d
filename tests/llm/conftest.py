"""Small tables for the training-data operators."""

import pytest
from pyspark.sql import types as T

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def make_docs(spark):
    """Documents from (id, text) pairs, with other columns whose names the operators also use."""

    def make(rows, names=("doc_id", "text")):
        schema = T.StructType(
            [
                T.StructField(names[0], T.LongType()),
                T.StructField(names[1], T.StringType()),
                *(T.StructField(c, T.StringType()) for c in ("spans", "component_id", "n_words", "word")),
            ]
        )
        return spark.createDataFrame([(i, t, "x", "x", "x", "x") for i, t in rows], schema)

    return make
