import pytest

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use for their own columns
        T.StructField("spans", T.StringType()),
        T.StructField("fingerprint", T.LongType()),
        T.StructField("_text_key", T.StringType()),
        T.StructField("shard", T.StringType()),
        T.StructField("rejected", T.StringType()),
        T.StructField("items", T.StringType()),
    ]
)


def doc(i, text, lang="en"):
    return (i, text, lang, "src", None if text is None else len(text), "s", 7, "k", "x", "r", "i")


@pytest.fixture(scope="session")
def make(spark):
    """Documents with clashing extra columns from (id, text[, lang]) rows."""
    return lambda rows: spark.createDataFrame([doc(*r) for r in rows], DOCS)
