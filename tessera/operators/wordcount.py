"""Word counting over a text corpus.

The pipeline is narrow up to the count: clean, split and filter run as one
code-generated stage; the count is a partial (map-side) aggregate, a shuffle
on the word, and a final aggregate. Top-k uses TakeOrderedAndProject, which
keeps k rows per task instead of sorting everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import append_suffix, clean_text, split_words


def words(lines: DataFrame, col: str = "line", clean: bool = True) -> DataFrame:
    """One ``word`` row per space-separated piece (empty pieces included)."""
    text = clean_text(col) if clean else F.col(col)
    # explode_outer + null test: no inferred size() filter re-running clean_text.
    return lines.select(F.explode_outer(split_words(text)).alias("word")).where(F.col("word").isNotNull())


def drop_empty_words(df: DataFrame, col: str = "word") -> DataFrame:
    return df.where(F.col(col) != "")


def corpus_words(lines: DataFrame, col: str = "line") -> DataFrame:
    """Cleaned, split, non-empty words of a line DataFrame."""
    return drop_empty_words(words(lines, col))


def word_count(df: DataFrame, col: str = "word") -> DataFrame:
    """(word, count) for every distinct word."""
    return df.groupBy(F.col(col).alias("word")).agg(F.count(F.lit(1)).alias("count"))


def unique_words(counts: DataFrame) -> DataFrame:
    """One row: the number of distinct words of a ``word_count`` result."""
    return counts.agg(F.count(F.lit(1)).alias("unique_words"))


def mean_per_word(counts: DataFrame) -> DataFrame:
    """One row: total words / distinct words (mean occurrences per word)."""
    return counts.agg(
        F.sum("count").alias("total_words"),
        F.count(F.lit(1)).alias("unique_words"),
        (F.sum("count") / F.count(F.lit(1))).alias("mean_count"),
    )


def top_words(counts: DataFrame, k: int = 15) -> DataFrame:
    """The k most common words; ties in count break on the word."""
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(k)


def largest_values(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """The k largest values of a column in natural descending order."""
    return df.select(col).orderBy(F.desc(col)).limit(k)


def pluralize(df: DataFrame, col: str = "word", suffix: str = "s") -> DataFrame:
    """(word, plural): the word with a suffix appended."""
    return df.select(F.col(col).alias("word"), append_suffix(col, suffix).alias("plural"))


def word_lengths(df: DataFrame, col: str = "word") -> DataFrame:
    """(word, length) in characters."""
    return df.select(F.col(col).alias("word"), F.length(col).alias("length"))


def word_count_pipeline(lines: DataFrame, col: str = "line", k: int | None = None) -> DataFrame:
    """clean -> split -> drop empty -> count (-> top k)."""
    counts = word_count(corpus_words(lines, col))
    return top_words(counts, k) if k else counts
