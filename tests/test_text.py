"""Word count and tokenizer literals (literal cases)."""

import pytest
from pyspark.sql import functions as F

from tessera.functions.text import clean_text, remove_quotes, simple_tokenize, tokenize
from tessera.operators import wordcount as wc
from tessera.sources.fixtures import STOPWORDS
from tessera.sources.text import document_lines, number_range, numbered_lines


def one(spark, value):
    return spark.createDataFrame([(value,)], "value string")


def test_word_count_literal(spark):
    words = spark.createDataFrame([(w,) for w in ["cat", "elephant", "rat", "rat", "cat"]], "word string")
    counts = {r.word: r["count"] for r in wc.word_count(words).collect()}
    assert counts == {"cat": 2, "elephant": 1, "rat": 2}
    mean = wc.mean_per_word(wc.word_count(words)).first()
    assert round(mean.mean_count, 2) == 1.67
    assert wc.unique_words(wc.word_count(words)).first().unique_words == 3


def test_pluralize_and_lengths(spark):
    words = spark.createDataFrame([("cat",), ("rat",)], "word string")
    assert sorted(r.plural for r in wc.pluralize(words).collect()) == ["cats", "rats"]
    assert sorted(r.length for r in wc.word_lengths(words).collect()) == [3, 3]


def test_clean_text(spark):
    out = one(spark, " The Elephant's 4 cats. ").select(clean_text("value").alias("v")).first().v
    assert out == "the elephants 4 cats"


def test_words_keep_empty_then_drop(spark):
    lines = spark.createDataFrame([("a  b",), ("",)], "line string")
    words = [r.word for r in wc.words(lines).collect()]
    assert sorted(words) == ["", "", "a", "b"]
    assert sorted(r.word for r in wc.drop_empty_words(wc.words(lines)).collect()) == ["a", "b"]


def test_top_words_ties_break_on_word(spark):
    words = spark.createDataFrame([(w,) for w in "b a c a b d".split()], "word string")
    top = [r.word for r in wc.top_words(wc.word_count(words), 2).collect()]
    assert top == ["a", "b"]


def test_simple_tokenize(spark):
    def toks(s):
        return one(spark, s).select(simple_tokenize("value").alias("t")).first().t

    assert toks("!!!!123A/456_B/789C.123A") == ["123a", "456_b", "789c", "123a"]
    assert toks(" ") == []
    assert toks("fox fox") == ["fox", "fox"]
    assert toks("A quick brown fox jumps over the lazy dog.")[:3] == ["a", "quick", "brown"]


def test_tokenize_stopwords(spark):
    def toks(s):
        return one(spark, s).select(tokenize("value", STOPWORDS).alias("t")).first().t

    assert toks("Why a the?") == []
    assert toks("Being at the_?") == ["the_"]


def test_remove_quotes(spark):
    assert one(spark, '"a"b""').select(remove_quotes("value").alias("v")).first().v == "ab"


def test_document_lines_and_numbering(spark):
    docs = spark.createDataFrame([(1, "x\ny\nz"), (2, "only")], "doc_id long, text string")
    lines = document_lines(docs).orderBy("doc_id", "line_no").collect()
    assert [(r.doc_id, r.line_no, r.line) for r in lines] == [(1, 0, "x"), (1, 1, "y"), (1, 2, "z"), (2, 0, "only")]
    idx = numbered_lines(spark.range(0, 1000, 1, 7), "id").collect()
    assert sorted(r.line_index for r in idx) == list(range(1000))
    assert all(r.line_index == r.id for r in idx)
    with pytest.raises(ValueError):
        numbered_lines(spark.range(3), [])


def test_range_sums(spark):
    r = number_range(spark, 100000)
    assert r.agg(F.sum("id")).first()[0] == 4999950000
    assert r.where(F.col("id") % 7 == 0).agg(F.sum("id")).first()[0] == 714264285


def test_read_text_lines_gzip_and_stopwords(spark, tmp_path):
    import gzip

    from tessera.sources.parsers import load_stopwords
    from tessera.sources.text import read_text_lines

    p = tmp_path / "words.txt.gz"
    with gzip.open(p, "wt") as f:
        f.write("the\na\n\nthe\n  why \n")
    df = read_text_lines(spark, str(p), partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 5
    assert sorted(r.token for r in load_stopwords(df).collect()) == ["a", "the", "why"]


def test_drop_stopwords_anti_join(spark):
    from tessera.operators.similarity import drop_stopwords
    from tessera.sources.fixtures import stopwords

    toks = spark.createDataFrame([(1, "the"), (1, "fox"), (2, "a"), (2, "fox")], "id long, token string")
    out = drop_stopwords(toks, stopwords(spark)).select("id", "token")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "fox"), (2, "fox")]


def test_from_values(spark):
    from tessera.sources.text import from_values

    df = from_values(spark, [(1, "a"), (2, "b")], "k int, v string")
    assert [tuple(r) for r in df.orderBy("k").collect()] == [(1, "a"), (2, "b")]


def test_numbered_lines_by_order_column(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",)], "w string").repartition(3)
    got = sorted((r.line_index, r.w) for r in numbered_lines(df, "w").collect())
    assert got == [(0, "a"), (1, "b"), (2, "c")]


def test_numbered_lines_with_ties_nulls_and_a_hot_value(spark):
    rows = [("same", i) for i in range(900)] + [(None, i) for i in range(5)] + [("zz", 1), ("zz", 1), ("aa", None)]
    df = spark.createDataFrame(rows, "w string, n int").repartition(5)
    got = sorted((r.line_index, r.w) for r in numbered_lines(df, "w", ranges=8).collect())
    assert [i for i, _ in got] == list(range(len(rows)))
    assert [w for _, w in got] == sorted((w for w, _ in rows), key=lambda w: (w is not None, w or ""))
    assert numbered_lines(df.limit(0), "w").collect() == []


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_numbered_lines_keeps_every_row(spark, tmp_path, coalesce):
    """Whole rows, written and read back, with partitions coalesced or not."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        numbered_lines(docs, "doc_id").write.parquet(str(tmp_path / "a"))
        spark.range(2_000_000).select((F.col("id") * 7919 % 2_000_000).alias("k")).write.parquet(str(tmp_path / "b"))
        numbered_lines(spark.read.parquet(str(tmp_path / "b")), "k").write.parquet(str(tmp_path / "c"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    small = spark.read.parquet(str(tmp_path / "a"))
    assert small.where("line_index = doc_id").count() == docs.count() == small.count()
    large = spark.read.parquet(str(tmp_path / "c"))
    assert large.where("line_index = k").count() == large.count() == 2_000_000
