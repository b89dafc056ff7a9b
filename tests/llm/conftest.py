import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def frame(spark):
    """texts -> documents; ids from 0, or (id, text) pairs."""
    from geoframe.session import ship_package
    ship_package(spark)

    def make(texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS).repartition(3)
    return make


@pytest.fixture(scope="session")
def documents():
    """(id, text) of the smallest table."""
    import duckdb
    return duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet' ORDER BY 1").fetchall()


@pytest.fixture(scope="session")
def byte_path():
    P = pytest.importorskip("public_tokenizers")
    return P.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def word_path():
    P = pytest.importorskip("public_tokenizers")
    return P.path("word_bpe_49k.json")
