import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from brute import CLASHES, EDGES  # noqa: E402

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                    T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang, source]) rows; ``extra`` columns
    have names that the operators use inside."""
    def make(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOC).repartition(3)
        from pyspark.sql import functions as F
        for c in extra:
            df = df.withColumn(c, F.lit(7))
        return df
    return make


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGES, CLASHES)


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([], CLASHES)
