import pytest
from pyspark.sql import types as T


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text, source), with an extra column whose name clashes with results."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType())])

    def make(rows):
        return spark.createDataFrame([(i, t, None, s, None if t is None else len(t), "x") for i, t, s in rows], schema)

    return make
