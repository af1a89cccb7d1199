import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use for their own results.
    T.StructField("score", T.DoubleType()), T.StructField("out", T.StringType()), T.StructField("row", T.StringType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) with clashing extra columns."""

    def make(rows):
        full = [(i, t, "en" if t and len(t) % 2 else None, None if i is None else f"s{i % 3}", len(t) if t else None, 0.5, "x", None) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, odd white space."""
    long = " ".join(f"word{i % 997} the{i % 13}" for i in range(30_000))
    prose = " ".join(f"token{i}" for i in range(80))
    return [
        (5, None), (4, ""), (3, "   \t\n "), (2, "one"), (9, prose), (7, prose + " tail"), (7, prose + " tail"), (None, prose),
        (None, None), (11, long), (12, "head " + long), (13, "Ünïcödé ŁÓDŹ 日本語 и кириллица nbsp em"), (14, "double  spaces \n and\r\nlines "),
        (15, " leading"), (16, "▁mark ▁ here"), (17, "a<|endoftext|>b <|endoftext|> c"), (-3, "ONE"), (18, "\x1cfs\x1d \x85nel"), (19, "don't we'll I'm"),
    ]
