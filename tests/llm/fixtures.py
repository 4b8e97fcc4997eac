import os

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s0", len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture(scope="session")
def vocabulary():
    """The address of a public vocabulary file; tests that need one are left
    out where there is none."""
    folder = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")

    def path(name):
        p = os.path.join(folder, name)
        if not os.path.exists(p):
            pytest.skip(f"no {name}")
        return p

    return path
