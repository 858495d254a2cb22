"""Fixtures and the data folder for the tests of this directory."""

import os

import pytest
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StringType, StructField, StructType

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

DOCUMENT = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())]
)
#: Names that the operators use inside or return, as further columns of their input.
CLASHING = "row c key size u sid block shard component component_id kept n_words host path rule text2 g v h w p o lo hi score lang_pred taken n_tokens seq_id class_id possible canonical".split()


@pytest.fixture
def documents(spark):
    """Make a documents frame from (doc_id, text, lang, source), with clashing further columns."""

    def make(rows, clash=True):
        df = spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in rows], DOCUMENT)
        if clash:
            for name in CLASHING:
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture
def embeddings(spark):
    def make(rows, kind=FloatType):
        schema = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(kind())), StructField("score", DoubleType())])
        return spark.createDataFrame([(*r, 0.0) for r in rows], schema)

    return make
