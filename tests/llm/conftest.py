import pytest
from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA).repartition(parts)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, a very long text, unusual white space."""
    long_text = " ".join(f"w{i % 997}x{i % 13}" for i in range(60_000))
    return [
        (1, "Alpha beta gamma delta epsilon\nzeta eta theta iota kappa lambda"), (2, None), (3, ""), (4, "   \n\t  "),
        (None, "Alpha beta gamma delta epsilon\nzeta eta theta iota kappa lambda"), (None, None),
        (5, "one two three\x0bfour\x0cfive\r\nsix seven eight \x1cnine"), (5, "one two three\x0bfour\x0cfive\r\nsix seven eight \x1cnine"),
        (6, long_text), (7, long_text + " end"), (8, "Été 中文 \U0001f600 straße İ"), (9, "the the the the the the the the the the the the"),
        (10, "alpha BETA gamma delta epsilon  \n  ZETA eta theta iota kappa lambda\n\n\nshort"), (11, "<|endoftext|> and <|endoftext|>"),
    ]
